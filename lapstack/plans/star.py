"""Race-shaped tables over a star schema of orders.

The same operators and marts that serve racing data run here on ``orders``, ``lineitem``,
``customer``, ``nation`` and ``region``: a month is a race, a customer a driver, an order
line a lap, a returned line a stop. Teams hold ten customers and shift by one each season;
circuits are regions.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapstack.operators.scans import ordered_scan, profile_groups, profile_sizes, row_number, running_sum
from lapstack.plans import marts
from lapstack.plans.models import MART_MODELS, Model
from lapstack.plans.silver import classify_status
from lapstack.session import scratch_path, stage, tune

RAW = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()

LINE_COLUMNS = (
    "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag "
    "l_linestatus l_shipdate"
).split()


def _null(kind: str = "string"):
    return F.lit(None).cast(kind)


def _race_id():
    return (F.col("season") * 100 + F.col("round")).cast("bigint")


def _lineage():
    return F.when(F.col("season") < 2000, F.lit("historical")).otherwise(F.lit("api"))


def _entry_id():
    return F.col("race_id") * F.lit(1_000_000_000_000) + F.col("driver_id")


def entries(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per customer and month that ordered, with grid and finish."""
    months = orders.join(customer.select(F.col("c_custkey").alias("o_custkey")), "o_custkey").groupBy(
        F.col("o_custkey").alias("driver_id"),
        F.year("o_orderdate").alias("season"),
        F.month("o_orderdate").alias("round"),
    )
    base = months.agg(
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("points"),
        F.min("o_orderkey").alias("first_order"),
        F.max("o_orderstatus").alias("last_status"),
        F.count(F.lit(1)).cast("int").alias("laps_completed"),
    ).withColumn("race_id", _race_id())
    # a month has no more customers than orders
    profile = profile_groups(base, ["race_id"], within=orders.select(F.date_trunc("month", "o_orderdate").alias("race_id")))
    gridded = ordered_scan(base, ["race_id"], [F.col("first_order").asc()], {"grid_position": row_number()}, profile)
    by_points = [F.col("points").desc(), F.col("driver_id").asc()]
    placed = ordered_scan(gridded, ["race_id"], by_points, {"_place": row_number()}, profile)
    stopped = (F.col("last_status") == "P") & (F.col("grid_position") % 2 == 0)
    return placed.select(
        "race_id",
        "driver_id",
        "season",
        "round",
        (F.col("round") % 5).cast("bigint").alias("circuit_id"),
        F.floor((F.col("driver_id") + F.col("season")) / 10).cast("bigint").alias("constructor_id"),
        F.when(F.col("last_status") == "F", 1).when(F.col("last_status") == "O", 2).otherwise(3).cast("bigint").alias(
            "status_id"
        ),
        F.col("grid_position").cast("int").alias("grid_position"),
        F.when(~stopped, F.col("_place")).cast("int").alias("finish_position"),
        "points",
        "laps_completed",
        "first_order",
        _lineage().alias("source"),
    )


def fact_results(entry: DataFrame) -> DataFrame:
    """Entries, plus a second and weaker result for every seventh customer (a shared drive)."""
    shared = entry.filter(F.col("driver_id") % 7 == 0).select(
        *[c for c in entry.columns if c not in ("points", "finish_position", "laps_completed")],
        (F.col("points") - 1).cast("decimal(18,2)").alias("points"),
        _null("int").alias("finish_position"),
        F.lit(0).alias("laps_completed"),
        F.lit(1).alias("_second"),
    )
    rows = entry.withColumn("_second", F.lit(0)).unionByName(shared)
    return rows.select(
        (_entry_id() * 2 + F.col("_second")).alias("result_id"),
        "race_id",
        "driver_id",
        "constructor_id",
        "status_id",
        "grid_position",
        "finish_position",
        "points",
        "laps_completed",
        F.col("round").alias("fastest_lap_number"),
        (F.col("driver_id") % 20 + 1).cast("int").alias("fastest_lap_rank"),
        F.concat(F.lit("1:"), F.lpad((F.col("driver_id") % 60).cast("string"), 2, "0"), F.lit(".000")).alias(
            "fastest_lap_time"
        ),
        "source",
    )


def fact_qualifying(entry: DataFrame) -> DataFrame:
    return entry.filter(F.col("driver_id") % 5 != 0).select(
        _entry_id().alias("qualify_id"),
        "race_id",
        "driver_id",
        "constructor_id",
        F.col("grid_position").alias("qualifying_position"),
        F.concat(F.lit("1:1"), (F.col("driver_id") % 10).cast("string"), F.lit(".5")).alias("q1_time"),
        _null().alias("q2_time"),
        _null().alias("q3_time"),
        "source",
    )


def fact_sprint_results(entry: DataFrame) -> DataFrame:
    return entry.filter(F.col("round").isin(4, 8, 12)).select(
        _entry_id().alias("sprint_result_id"),
        "race_id",
        "driver_id",
        "constructor_id",
        "status_id",
        "grid_position",
        "finish_position",
        (F.col("driver_id") % 9).cast("decimal(18,2)").alias("points"),
        "source",
    )


def lap_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order lines as laps: numbered within customer and month over all columns; ``stop_number`` counts the returned ones.

    The order comes first among the columns. A line's number so is its place in its order, after the lines of the
    customer's earlier orders of the month: those are told from one row per order, and lines move to their order only.
    """
    month = {"race_id": _race_id(), "driver_id": F.col("o_custkey")}
    dated = orders.select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round")
    ).withColumns(month)
    # an order that comes twice has each of its lines twice
    owned = ["l_orderkey", *month, "season"]
    returned = F.col("l_returnflag") == "R"
    sizes = lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_lines"), F.count_if(returned).alias("_returned"))
    owner = dated.join(sizes, "l_orderkey").groupBy(*owned, "_lines", "_returned").agg(F.count(F.lit(1)).alias("_copies"))
    counts = {"_n": F.col("_lines") * F.col("_copies"), "_s": F.col("_returned") * F.col("_copies")}
    owner = stage(owner.withColumns(counts).select(*owned, "_copies", *counts), "owners")
    upto = {"_upto": running_sum("_n"), "_stops_upto": running_sum("_s")}
    before = ordered_scan(owner, list(month), [F.col("l_orderkey").asc()], upto)
    before = before.withColumns({"_before": F.col("_upto") - F.col("_n"), "_stops_before": F.col("_stops_upto") - F.col("_s")})
    repeated = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("_copy")
    lines = lineitem.select(*LINE_COLUMNS).join(before.select(*owned, "_before", "_stops_before", repeated).drop("_copy"), "l_orderkey")
    order = [F.col(c).asc_nulls_last() for c in LINE_COLUMNS]
    places = {"_at": row_number(), "_stop_at": running_sum("_stop")}
    lines = lines.withColumn("_stop", F.coalesce(returned, F.lit(False)).cast("int"))
    numbered = ordered_scan(lines, ["l_orderkey", *month], order, places, profile_sizes(owner))
    return numbered.select(
        "race_id",
        "driver_id",
        (F.col("_before") + F.col("_at")).cast("int").alias("lap_number"),
        F.col("l_linenumber").alias("lap_position"),
        F.round(F.col("l_extendedprice") * 100, 0).cast("bigint").alias("lap_milliseconds"),
        F.when(returned, F.col("_stops_before") + F.col("_stop_at")).cast("int").alias("stop_number"),
        "l_returnflag",
        "l_linestatus",
        "l_linenumber",
        F.round(F.col("l_quantity") * 1000, 0).cast("bigint").alias("_quantity_ms"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("_ship_day"),
        _lineage().alias("source"),
    )


def fact_lap_times(lines: DataFrame) -> DataFrame:
    return lines.select(
        "race_id",
        "driver_id",
        "lap_number",
        "lap_position",
        F.col("lap_milliseconds").cast("string").alias("lap_time"),
        "lap_milliseconds",
        "source",
    )


def fact_pit_stops(lines: DataFrame) -> DataFrame:
    """Returned lines, which know their number among those of their customer and month."""
    unknown = (F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 7)
    return lines.filter(F.col("l_returnflag") == "R").select(
        "race_id",
        "driver_id",
        "stop_number",
        "lap_number",
        F.col("_ship_day").alias("stop_time"),
        F.col("_quantity_ms").cast("string").alias("stop_duration"),
        F.when(~unknown, F.col("_quantity_ms")).alias("stop_milliseconds"),
        "source",
    )


def dim_drivers(customer: DataFrame, nation: DataFrame) -> DataFrame:
    home = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("nationality"))
    return customer.join(home, "c_nationkey").select(
        F.col("c_custkey").alias("driver_id"),
        F.lower("c_name").alias("driver_ref"),
        (F.col("c_custkey") % 100).cast("int").alias("driver_number"),
        F.upper(F.substring("c_mktsegment", 1, 3)).alias("code"),
        F.col("c_mktsegment").alias("forename"),
        F.col("c_name").alias("surname"),
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") % 10000).cast("int")).alias("date_of_birth"),
        "nationality",
        F.when(F.col("c_custkey") % 2 == 0, "historical").otherwise("api").alias("source"),
    )


def dim_constructors(entry: DataFrame, nation: DataFrame) -> DataFrame:
    home = nation.select(F.col("n_nationkey").cast("bigint").alias("_home"), F.col("n_name").alias("nationality"))
    teams = entry.select("constructor_id").distinct().withColumn("_home", F.col("constructor_id") % 25)
    name = F.concat(F.lit("Team "), F.col("constructor_id").cast("string"))
    return teams.join(home, "_home").select(
        "constructor_id", F.lower(name).alias("constructor_ref"), name.alias("name"), "nationality",
        F.lit("historical").alias("source"),
    )


def dim_circuits(region: DataFrame) -> DataFrame:
    key = F.col("r_regionkey")
    return region.select(
        key.cast("bigint").alias("circuit_id"),
        F.lower("r_name").alias("circuit_ref"),
        F.concat(F.lit("Ring "), "r_name").alias("name"),
        F.concat(F.lit("Place "), key.cast("string")).alias("location"),
        F.col("r_name").alias("country"),
        (key * 1.5).alias("latitude"),
        (key * -2.5).alias("longitude"),
        (key * 100).cast("int").alias("altitude"),
    )


def dim_races(orders: DataFrame) -> DataFrame:
    months = orders.select(F.year("o_orderdate").alias("season"), F.month("o_orderdate").alias("round")).distinct()
    return months.select(
        _race_id().alias("race_id"),
        F.col("season").alias("year"),
        "round",
        (F.col("round") % 5).cast("bigint").alias("circuit_id"),
        F.concat(F.lit("Race "), _race_id().cast("string")).alias("name"),
        F.make_date("season", "round", F.lit(1)).alias("race_date"),
        _lineage().alias("source"),
    )


def dim_status(orders: DataFrame) -> DataFrame:
    """Status texts by order status; a lapped finish falls to the default category."""
    state = F.col("o_orderstatus")
    rows = orders.select("o_orderstatus").distinct().select(
        F.when(state == "F", 1).when(state == "O", 2).otherwise(3).cast("bigint").alias("status_id"),
        F.when(state == "F", "Finished").when(state == "O", "+1 Lap").otherwise("Engine fire").alias("status"),
    )
    return classify_status(rows)


def dim_seasons(orders: DataFrame) -> DataFrame:
    return orders.select(F.year("o_orderdate").alias("year")).distinct().withColumn("source", F.lit("historical"))


_VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "entries": (entries, ("orders", "customer")),
    "fact_results": (fact_results, ("entries",)),
    "fact_qualifying": (fact_qualifying, ("entries",)),
    "fact_sprint_results": (fact_sprint_results, ("entries",)),
    "lap_lines": (lap_lines, ("orders", "lineitem")),
    "fact_lap_times": (fact_lap_times, ("lap_lines",)),
    "fact_pit_stops": (fact_pit_stops, ("lap_lines",)),
    "dim_drivers": (dim_drivers, ("customer", "nation")),
    "dim_constructors": (dim_constructors, ("entries", "nation")),
    "dim_circuits": (dim_circuits, ("region",)),
    "dim_races": (dim_races, ("orders",)),
    "dim_status": (dim_status, ("orders",)),
    "dim_seasons": (dim_seasons, ("orders",)),
}

# told from each row of a stored model alone: read from that one, never stored once more
_ROW_WISE = {"fact_results", "fact_qualifying", "fact_sprint_results", "fact_lap_times", "fact_pit_stops"}

# places and counts here outgrow the racing widths, so the averages get wider types
_WIDE = {
    "driver_season_summary": partial(marts.driver_season_summary, average=(20, 2)),
    "circuit_stats": partial(marts.circuit_stats, count_average=(20, 2), ms_average=(20, 2)),
}

STAR_MODELS: dict[str, Model] = {
    **{name: Model("silver", build, inputs) for name, (build, inputs) in _VIEWS.items()},
    **{
        name: Model(m.layer, _WIDE.get(name, m.build), m.inputs, m.partition) for name, m in MART_MODELS.items()
    },
}

# per session and data: paths of stored models, and the frames already opened
_stores: dict[tuple, tuple[dict[str, str], dict[str, DataFrame]]] = {}


class StarTables:
    """Raw tables of a folder and the models over them, stored once per session and data where rows have to move for them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = tune(spark)
        self.sf_dir = sf_dir.rstrip("/")
        key = (spark.sparkContext.applicationId, self.sf_dir, self._fingerprint())
        self._store, self._frames = _stores.setdefault(key, ({}, {}))

    def _fingerprint(self) -> tuple:
        """Sizes and times of the files, so changed data is never served from older tables."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.sf_dir)
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(path)
        return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in files))

    def _read(self, path: str) -> DataFrame:
        if path not in self._frames:
            self._frames[path] = self.spark.read.parquet(path)
        return self._frames[path]

    def raw(self, name: str) -> DataFrame:
        return self._read(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name in RAW:
            return self.raw(name)
        if name in _ROW_WISE:
            if name not in self._frames:
                self._frames[name] = self._build(name)
            return self._frames[name]
        if name not in self._store:
            path = scratch_path(self.spark, name)
            # files of a partition come from every task: no shuffle only to have fewer of them
            writer, partition = self._build(name).write.option("compression", "zstd"), STAR_MODELS[name].partition
            (writer.partitionBy(partition) if partition else writer).parquet(path)
            self._store[name] = path
        return self._read(self._store[name])

    def landed(self, name: str, write: Callable[[StarTables, str], None]) -> str:
        """A folder of landed files derived from the tables, written once per session and data."""
        if name not in self._store:
            path = scratch_path(self.spark, name)
            write(self, path)
            self._store[name] = path
        return self._store[name]

    def _build(self, name: str) -> DataFrame:
        model = STAR_MODELS[name]
        return model.build(*[self[i] for i in model.inputs])

    def rebuilt(self, name: str) -> DataFrame:
        """The model as a plan over its inputs, not read back from its stored table."""
        return self._build(name)
