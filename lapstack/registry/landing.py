"""Landed files derived from the tables: CSV tables and JSON payload pages.

An order stands for a race: its lines are the race's results, laps, stops and qualifying
entries. Pages hold at most ``PAGE_ITEMS`` items, so no order is gathered whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapstack.operators.rounds import PAGE_ITEMS, nest_rounds
from lapstack.operators.scans import ordered_scan, row_number
from lapstack.plans.star import LINE_COLUMNS, StarTables
from lapstack.schemas import ROUND_ENDPOINTS
from lapstack.sources.documents import write_documents
from lapstack.sources.files import read_payload, select_years
from lapstack.sources.sinks import write_csv

RACE = ["season", "round", "raceName"]
_TOLD_BY = LINE_COLUMNS.index("l_extendedprice") + 1  # columns of a line that tell its lap


def _text(value: str | Column) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def race_lines(t: StarTables) -> DataFrame:
    """Order lines with the season, round and name of their order."""
    orders = t.raw("orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        "o_custkey",
        _text(F.year("o_orderdate")).alias("season"),
        _text(F.month("o_orderdate")).alias("round"),
        _text("o_orderkey").alias("raceName"),
    )
    return t.raw("lineitem").join(orders, "l_orderkey")


def line_order() -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in LINE_COLUMNS]


def _price_ms() -> Column:
    return F.round(F.col("l_extendedprice") * 100, 0).cast("bigint")


def _seconds(ms: Column) -> Column:
    """Whole milliseconds as ``S.mmm``."""
    return F.concat(_text(F.floor(ms / 1000)), F.lit("."), F.lpad(_text(ms % 1000), 3, "0"))


def _driver() -> Column:
    return F.struct(_text("o_custkey").alias("driverId"))


def _team() -> Column:
    return F.struct(_text("l_suppkey").alias("constructorId"))


def _result() -> dict[str, Column]:
    finished = F.col("l_linestatus") == "F"
    time = F.struct(_text(_price_ms()).alias("millis"), _seconds(_price_ms()).alias("time"))
    lap = F.struct(
        _text("l_linenumber").alias("rank"),
        _text(F.col("l_partkey")).alias("lap"),
        F.struct(_text("l_quantity").alias("time")).alias("Time"),
    )
    return {
        "number": _text("l_partkey"),
        "position": F.when(F.col("l_returnflag") != "R", _text("l_linenumber")),
        "positionText": F.coalesce(F.when(F.col("l_returnflag") != "R", _text("l_linenumber")), F.lit("R")),
        "points": _text("l_discount"),
        "Driver": _driver(),
        "Constructor": _team(),
        "grid": _text("l_linenumber"),
        "laps": _text(F.col("l_quantity").cast("int")),
        "status": F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")),
        # optional parts of a result are left out of the document
        "Time": F.when(finished, time),
        "FastestLap": F.when(F.col("l_linenumber") <= 3, lap),
    }


def _items(endpoint: str) -> dict[str, Column]:
    if endpoint in ("results", "sprint"):
        return _result()
    if endpoint == "qualifying":
        return {
            "number": _text("l_partkey"),
            "position": _text("l_linenumber"),
            "Driver": _driver(),
            "Constructor": _team(),
            "Q1": _text("l_quantity"),
            "Q2": F.when(F.col("l_linenumber") > 3, _text("l_tax")),
            "Q3": F.lit(None).cast("string"),
        }
    if endpoint == "pitstops":
        return {
            "driverId": _text("o_custkey"),
            "lap": _text("l_partkey"),
            "stop": _text("l_linenumber"),
            "time": F.date_format("l_shipdate", "HH:mm:ss"),
            "duration": _seconds(_price_ms()),
        }
    if endpoint == "laps":
        timing = F.struct(
            _text("o_custkey").alias("driverId"),
            _text("l_suppkey").alias("position"),
            _seconds(_price_ms()).alias("time"),
        )
        return {"number": _text("l_linenumber"), "Timings": F.array(timing)}
    who = {"Driver": _driver()} if endpoint == "driverstandings" else {"Constructor": _team()}
    return {
        "position": _text("l_linenumber"),
        "positionText": _text("l_linenumber"),
        "points": _text("l_discount"),
        "wins": _text(F.col("l_quantity").cast("int")),
        **who,
    }


def _write_payloads(endpoint: str):
    def write(t: StarTables, path: str) -> None:
        key = ROUND_ENDPOINTS[endpoint]
        fields = _items(endpoint)
        lines = race_lines(t)
        extra = ["sheet"] if endpoint == "laps" else []
        if extra:  # a lap's timings lie on several sheets
            lines = lines.withColumn("sheet", F.col("l_suppkey") % 3)
        rows = lines.select(*RACE, *extra, "o_custkey", *LINE_COLUMNS)
        # a race is an order: by its key too, the lines stay where the join brought them
        item = F.struct(*[c.alias(n) for n, c in fields.items()]).alias("item")
        pages = nest_rounds(rows, ["l_orderkey", *RACE, *extra], line_order(), [item])
        page = F.col("page") + (F.col("sheet") * F.lit(1_000_000_000_000) if extra else F.lit(0))
        entry = F.struct(*RACE, F.transform("items", lambda i: i["item"]).alias(key))
        table, entries = ("StandingsTable", "StandingsLists") if "standings" in endpoint else ("RaceTable", "Races")
        document = F.struct(
            _text(page * PAGE_ITEMS).alias("offset"), F.struct(F.array(entry).alias(entries)).alias(table)
        )
        docs = pages.select(F.col("season").cast("int").alias("year"), document.alias("MRData"))
        docs.write.option("compression", "gzip").partitionBy("year").json(path)

    return write


def payloads(t: StarTables, endpoint: str, start_year: int = 0) -> DataFrame:
    """Landed payload pages of an endpoint, read back from their year folders."""
    path = t.landed(f"{endpoint}_payloads", _write_payloads(endpoint))
    return select_years(read_payload(t.spark, f"{path}/year=*", endpoint, multi_line=False), start_year)


# texts that look like parts of a document
HOSTILE_RACE, HOSTILE_DRIVER = 'R"}],"Laps":[{', 'd}"{[\\,'


def lap_documents(t: StarTables) -> str:
    """A document of laps for each year; names of races and drivers hold brackets, quotes and backslashes."""

    def write(t: StarTables, path: str) -> None:
        timing = F.struct(
            F.concat(F.lit(HOSTILE_DRIVER), _text("o_custkey")).alias("driverId"),
            _text("l_suppkey").alias("position"),
            _seconds(_price_ms()).alias("time"),
        )
        item = F.struct(_text("l_linenumber").alias("number"), F.array(timing).alias("Timings"))
        # lines that are alike up to their price give the same lap: what comes after it need not move
        lines = ordered_scan(race_lines(t), ["l_orderkey"], line_order()[:_TOLD_BY], {"ordinal": row_number()})
        lines = lines.withColumn("raceName", F.concat(F.lit(HOSTILE_RACE), F.col("raceName")))
        lines = lines.withColumns({c: F.col(c).cast("int") for c in ("season", "round")})
        write_documents(lines, path, "laps", "season", RACE, "ordinal", item)

    return t.landed("lap_documents", write)


def csv_folder(t: StarTables, name: str, df: DataFrame) -> str:
    """A frame written as a CSV folder."""
    return t.landed(f"{name}_csv", lambda _, path: write_csv(df, path))
