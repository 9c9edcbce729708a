"""Registered sources, round handling and sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from lapstack.operators import rounds
from lapstack.operators.rounds import PAGE_ITEMS
from lapstack.plans.models import MODELS, SILVER_MODELS, Model, build_models
from lapstack.plans.rebuild import BY_SEASON, build_changed
from lapstack.plans.star import RAW
from lapstack.plans.star_bronze import bronze_tables
from lapstack.registry import landing
from lapstack.registry.core import register
from lapstack.registry.sql import LINE_ORDER
from lapstack.registry.typed import TYPED
from lapstack.schemas import BRONZE_COLUMNS
from lapstack.session import scratch_path
from lapstack.sources import payloads as p
from lapstack.sources.documents import split_items
from lapstack.sources.files import completeness_report, inventory_report, landed_files, read_text_csv, select_years
from lapstack.sources.sinks import (
    bronze_layout,
    create_layers,
    export_bundle,
    load_table,
    table_counts,
    write_bronze,
    write_fixed,
    write_table,
)

_RACE_LINES = "FROM lineitem JOIN orders ON o_orderkey = l_orderkey"
_ORDINAL = f"row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_ORDER})"
_PRICE_MS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
_SECONDS = f"({_PRICE_MS} // 1000) || '.' || lpad(CAST({_PRICE_MS} % 1000 AS VARCHAR), 3, '0')"

# ---- scans ------------------------------------------------------------------------------


def _csv_scan(t):
    path = landing.csv_folder(t, "customer", t.raw("customer"))
    columns = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "c_absent"]
    return read_text_csv(t.spark, path, columns).withColumn("source", F.lit("historical"))


register(
    "src_1_text_csv",
    "c_custkey c_name:text c_nationkey c_acctbal:double c_mktsegment:text c_absent:text source:text",
    _csv_scan,
    "SELECT *, NULL AS c_absent, 'historical' AS source FROM customer",
)
register(
    "src_2_nested_json",
    "year season:text round:text race_name:text items",
    lambda t: landing.payloads(t, "results")
    .select("year", F.explode("MRData.RaceTable.Races").alias("e"))
    .groupBy("year", "e.season", "e.round", F.col("e.raceName").alias("race_name"))
    .agg(F.sum(F.size("e.Results")).alias("items")),
    "SELECT year(o_orderdate) AS year, year(o_orderdate) AS season, month(o_orderdate) AS round, "
    f"l_orderkey AS race_name, count(*) AS items {_RACE_LINES} GROUP BY ALL",
)


def _year_folders(t):
    """Orders in year folders; those in progress have no year and land in a folder without a number."""
    def write(_, path):
        year = F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate"))
        t.raw("orders").select("o_orderkey", "o_totalprice", year.alias("year")).write.partitionBy("year").json(path)

    path = t.landed("order_years", write)
    return select_years(t.spark.read.schema("o_orderkey bigint, o_totalprice double").json(f"{path}/year=*"), 1998)


register(
    "src_3_year_folders",
    "o_orderkey o_totalprice:double year",
    _year_folders,
    "SELECT o_orderkey, o_totalprice, year(o_orderdate) AS year FROM orders WHERE o_orderstatus <> 'P' "
    "AND year(o_orderdate) >= 1998",
)

_RESULT_COLUMNS = (
    "year season round driver_slug:text constructor_slug:text status_slug:text number:text grid:text position:text "
    "positionText:text laps:text points:double positionOrder:text time:text milliseconds:text fastestLap:text"
)
_RESULT_SQL = (
    "SELECT year(o_orderdate) AS year, year(o_orderdate) AS season, month(o_orderdate) AS round, "
    "o_custkey AS driver_slug, l_suppkey AS constructor_slug, "
    "CASE WHEN l_returnflag = 'N' THEN 'None' ELSE l_returnflag END AS status_slug, l_partkey AS number, "
    "l_linenumber AS grid, CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS position, "
    "CASE WHEN l_returnflag <> 'R' THEN CAST(l_linenumber AS VARCHAR) ELSE 'R' END AS positionText, "
    f"CAST(l_quantity AS INTEGER) AS laps, l_discount AS points, {_ORDINAL} AS positionOrder, "
    f"CASE WHEN l_linestatus = 'F' THEN {_SECONDS} END AS time, "
    f"CASE WHEN l_linestatus = 'F' THEN {_PRICE_MS} END AS milliseconds, "
    f"CASE WHEN l_linenumber <= 3 THEN l_partkey END AS fastestLap {_RACE_LINES}"
)
register("src_4_flatten_results", _RESULT_COLUMNS, lambda t: p.results(landing.payloads(t, "results")), _RESULT_SQL)


def _far_results(t):
    """The same pages, each 3,000,000,000 items further on."""
    far = (F.col("MRData.offset").cast("bigint") + F.lit(3_000_000_000)).cast("string")
    return p.results(landing.payloads(t, "results").withColumn("MRData", F.col("MRData").withField("offset", far)))


register(
    "src_4_large_offsets",
    "season round driver_slug:text constructor_slug:text number:text positionOrder",
    _far_results,
    "SELECT year(o_orderdate) AS season, month(o_orderdate) AS round, o_custkey AS driver_slug, l_suppkey AS "
    f"constructor_slug, l_partkey AS number, {_ORDINAL} + 3000000000 AS \"positionOrder\" {_RACE_LINES}",
)
register(
    "src_4_flatten_sprint",
    _RESULT_COLUMNS,
    lambda t: p.sprint_results(landing.payloads(t, "sprint", 1999)),
    f"SELECT * FROM ({_RESULT_SQL}) WHERE season >= 1999",
)
register(
    "src_5_flatten_laps",
    "season round driver_slug:text lap:text position:text time:text milliseconds:text",
    lambda t: p.lap_times(landing.payloads(t, "laps")),
    "SELECT year(o_orderdate) AS season, month(o_orderdate) AS round, o_custkey AS driver_slug, l_linenumber AS lap, "
    f"l_suppkey AS position, {_SECONDS} AS time, {_PRICE_MS} AS milliseconds {_RACE_LINES}",
)

def _split_laps(t):
    """The year documents of laps read in blocks of 256 KB, so that a document is split at every size of the tables."""
    path = landing.lap_documents(t)
    items = split_items(t.spark, f"{path}/*", "laps", start_year=0, split_bytes=256 << 10)
    return p.lap_times(items).withColumn("item", F.col("_item") + 1)


_HOSTILE = landing.HOSTILE_DRIVER
register(
    "src_5_split_document",
    "season round item driver_slug:text lap:text position:text time:text milliseconds:text",
    _split_laps,
    f"SELECT year(o_orderdate) AS season, month(o_orderdate) AS round, {_ORDINAL} AS item, "
    f"'{_HOSTILE}' || o_custkey AS driver_slug, l_linenumber AS lap, l_suppkey AS position, {_SECONDS} AS time, "
    f"{_PRICE_MS} AS milliseconds {_RACE_LINES}",
)
register(
    "src_12_year_documents",
    "year total",
    lambda t: select_years(
        t.spark.read.schema("MRData struct<total: string>").option("multiLine", True).json(f"{landing.lap_documents(t)}/*"), 0
    ).select("year", F.col("MRData.total").alias("total")),
    f"SELECT year(o_orderdate) AS year, count(*) AS total {_RACE_LINES} GROUP BY 1",
)
register(
    "src_6_flatten_qualifying",
    "season round driver_slug:text constructor_slug:text number:text position:text q1:double q2:double q3:text",
    lambda t: p.qualifying(landing.payloads(t, "qualifying")),
    "SELECT year(o_orderdate) AS season, month(o_orderdate) AS round, o_custkey AS driver_slug, "
    "l_suppkey AS constructor_slug, l_partkey AS number, l_linenumber AS position, l_quantity AS q1, "
    f"CASE WHEN l_linenumber > 3 THEN l_tax END AS q2, NULL AS q3 {_RACE_LINES}",
)
register(
    "src_6_flatten_stops",
    "season round driver_slug:text stop:text lap:text time:text duration:text milliseconds:text",
    lambda t: p.pit_stops(landing.payloads(t, "pitstops")),
    "SELECT year(o_orderdate) AS season, month(o_orderdate) AS round, o_custkey AS driver_slug, l_linenumber AS stop, "
    f"l_partkey AS lap, strftime(l_shipdate, '%H:%M:%S') AS time, {_SECONDS} AS duration, {_PRICE_MS} AS milliseconds "
    f"{_RACE_LINES}",
)
for _endpoint, _slug, _key in (
    ("driverstandings", "driver_slug", "o_custkey"),
    ("constructorstandings", "constructor_slug", "l_suppkey"),
):
    register(
        f"src_6_flatten_{_endpoint}",
        f"season round {_slug}:text points:double position:text positionText:text wins:text",
        lambda t, endpoint=_endpoint: p.standings(landing.payloads(t, endpoint), endpoint),
        f"SELECT year(o_orderdate) AS season, month(o_orderdate) AS round, {_key} AS {_slug}, l_discount AS points, "
        "l_linenumber AS position, l_linenumber AS positionText, CAST(l_quantity AS INTEGER) AS wins "
        f"{_RACE_LINES}",
    )
register(
    "src_7_optional_objects",
    "timed untimed with_lap without_lap unknown_status",
    lambda t: p.results(landing.payloads(t, "results")).agg(
        F.count("milliseconds").alias("timed"),
        F.count_if(F.col("time").isNull()).alias("untimed"),
        F.count("fastestLapTime").alias("with_lap"),
        F.count_if(F.col("rank").isNull()).alias("without_lap"),
        F.count_if(F.col("status_slug") == "None").alias("unknown_status"),
    ),
    "SELECT count(*) FILTER (l_linestatus = 'F') AS timed, count(*) FILTER (l_linestatus <> 'F') AS untimed, "
    "count(*) FILTER (l_linenumber <= 3) AS with_lap, count(*) FILTER (l_linenumber > 3) AS without_lap, "
    f"count(*) FILTER (l_returnflag = 'N') AS unknown_status {_RACE_LINES}",
)


def _lap_pages(t):
    return landing.payloads(t, "laps").select(
        F.col("MRData.offset").cast("bigint").alias("page"), F.explode("MRData.RaceTable.Races").alias("e")
    ).select("page", F.col("e.raceName").alias("race"), F.col("e.Laps").alias("laps"))


register(
    "src_8_merge_lap_pages",
    "race:text number ordinal driver:text position:text time:text",
    lambda t: rounds.merge_pages(_lap_pages(t), ["race"], "page", "laps", "number", "Timings").select(
        "race", "number", "ordinal", F.col("part.driverId").alias("driver"), "part.position", "part.time"
    ),
    "SELECT l_orderkey AS race, l_linenumber AS number, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    f"ORDER BY l_suppkey % 3, {LINE_ORDER}) AS ordinal, o_custkey AS driver, l_suppkey AS position, "
    f"{_SECONDS} AS time {_RACE_LINES}",
)


def _customer_pages(t):
    """Customers of a segment as pages of a flat list, with the total every page reports."""
    def write(_, path):
        customer = t.raw("customer").select("c_mktsegment", "c_custkey", "c_name")
        pages = rounds.nest_rounds(customer, ["c_mktsegment"], [F.col("c_custkey").asc()], ["c_custkey", "c_name"])
        totals = customer.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("total"))
        pages.join(totals, "c_mktsegment").withColumn("offset", F.col("page") * PAGE_ITEMS).write.json(path)

    schema = (
        "c_mktsegment string, `offset` bigint, total bigint, items array<struct<c_custkey: bigint, c_name: string>>"
    )
    return t.spark.read.schema(schema).json(t.landed("customer_pages", write))


register(
    "src_9_flat_pages",
    "c_mktsegment:text ordinal c_custkey c_name:text",
    lambda t: rounds.flat_pages(_customer_pages(t), ["c_mktsegment"], "offset", "items").select(
        "c_mktsegment", "ordinal", "item.c_custkey", "item.c_name"
    ),
    "SELECT c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) AS ordinal, c_custkey, "
    "c_name FROM customer",
)
register(
    "src_9_pages_complete",
    "c_mktsegment:text collected reported complete:flag",
    lambda t: rounds.pages_complete(_customer_pages(t), ["c_mktsegment"], "items", "total"),
    "SELECT c_mktsegment, count(*) AS collected, count(*) AS reported, true AS complete FROM customer GROUP BY 1",
)

def _dated(t):
    """Orders with their ISO date; every fiftieth has none."""
    date = F.when(F.col("o_orderkey") % 50 != 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.raw("orders").withColumn("date", date)


register(
    "src_10_due_rounds",
    "o_orderkey date:text",
    lambda t: rounds.due_rounds(_dated(t), "1998-06-30"),
    "SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS date FROM orders "
    "WHERE o_orderkey % 50 = 0 OR o_orderdate <= TIMESTAMP '1998-06-30 23:59:59'",
)
register(
    "src_10_due_sprint_rounds",
    "o_orderkey",
    lambda t: rounds.due_rounds(_dated(t), "1998-06-30", sprint=F.col("o_orderstatus") == "F"),
    "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' AND (o_orderkey % 50 = 0 OR "
    "o_orderdate <= TIMESTAMP '1998-06-30 23:59:59')",
)

# ---- rounds -----------------------------------------------------------------------------

_ROUND = ["season", "round"]


def _stored_items(t):
    return t["entries"].select(*_ROUND, "driver_id", "points")


def _fetched_items(t):
    """Even rounds again with one more point; every fourth round comes back empty."""
    fetched = _stored_items(t).filter((F.col("round") % 2 == 0) & (F.col("round") % 4 != 0))
    return fetched.withColumn("points", (F.col("points") + 1).cast("decimal(18,2)"))


register(
    "src_11_upsert_items",
    "season round driver_id points:double",
    lambda t: rounds.upsert_items(_stored_items(t), _fetched_items(t), _ROUND),
    "SELECT season, round, driver_id, CASE WHEN round % 2 = 0 AND round % 4 <> 0 THEN points + 1 ELSE points END AS "
    "points FROM entries",
    ["entries"],
)


def _round_headers(t):
    stored = t["entries"].filter("round <> 6").groupBy(*_ROUND).agg(F.count(F.lit(1)).alias("n_items"))
    stored = stored.withColumn("origin", F.lit("stored"))
    fetched = (
        t["entries"]
        .filter("round % 2 = 0")
        .groupBy(*_ROUND)
        .agg(F.when(F.col("round") % 4 == 0, 0).otherwise(F.count(F.lit(1))).alias("n_items"))
        .withColumn("origin", F.lit("fetched"))
    )
    return rounds.upsert_rounds(stored, fetched, _ROUND)


register(
    "src_11_upsert_rounds",
    "season round n_items origin:text",
    _round_headers,
    "SELECT season, round, count(*) AS n_items, CASE WHEN round % 2 = 0 AND round % 4 <> 0 THEN 'fetched' "
    "ELSE 'stored' END AS origin FROM entries GROUP BY season, round",
    ["entries"],
)


def _entry_pages(t):
    entry = t["entries"].select(*_ROUND, "grid_position", "driver_id")
    return rounds.nest_rounds(entry, _ROUND, [F.col("grid_position").asc()], ["driver_id"])


register(
    "src_12_nested_pages",
    "season round page n_items drivers:text",
    lambda t: _entry_pages(t).select(
        *_ROUND,
        "page",
        F.size("items").alias("n_items"),
        F.array_join(F.transform("items", lambda i: i["driver_id"].cast("string")), ",").alias("drivers"),
    ),
    f"SELECT season, round, (grid_position - 1) // {PAGE_ITEMS} AS page, count(*) AS n_items, "
    "string_agg(CAST(driver_id AS VARCHAR), ',' ORDER BY grid_position) AS drivers FROM entries GROUP BY 1, 2, 3",
    ["entries"],
)
register(
    "src_12_payload_totals",
    "season total",
    lambda t: rounds.payload_totals(_entry_pages(t), ["season"]),
    "SELECT season, count(*) AS total FROM entries GROUP BY season",
    ["entries"],
)
_EXPECTED = [*RAW, "constructor_results"]
register(
    "src_13_completeness",
    "check:text name:text found passed:flag",
    lambda t: completeness_report(
        t.spark.createDataFrame([(n,) for n in _EXPECTED], "name string"),
        {n: t.raw(n) for n in RAW},
        t.raw("orders").select(F.year("o_orderdate").alias("year")),
        2001,
    ),
    " UNION ALL ".join(
        f"SELECT 'table' AS \"check\", '{n}' AS name, count(*) AS found, count(*) > 0 AS passed FROM {n}" for n in RAW
    )
    + " UNION ALL SELECT 'table', 'constructor_results', 0, false UNION ALL "
    "SELECT 'last_year', 'year', max(year(o_orderdate)), max(year(o_orderdate)) >= 2001 FROM orders",
)



def _inventory(t):
    """Files of two endpoints in year folders; the last year of one is missing, the first of the other is empty."""

    def write(_, path):
        years = t.raw("orders").select(F.year("o_orderdate").alias("year"), F.to_json(F.struct("o_orderkey")).alias("line"))
        last, first = (years.agg(f("year")).first()[0] for f in (F.max, F.min))
        years.filter(F.col("year") != last).write.partitionBy("year").text(f"{path}/results")
        years.filter(F.col("year") != first).write.partitionBy("year").text(f"{path}/laps")
        empty = t.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/laps/year={first}/part-0.txt")
        empty.getFileSystem(t.spark._jsc.hadoopConfiguration()).create(empty).close()

    path = t.landed("inventory", write)
    endpoints = t.spark.createDataFrame([("results",), ("laps",)], "endpoint string")
    expected = t.raw("orders").select(F.year("o_orderdate").alias("year")).distinct().join(F.broadcast(endpoints), F.lit(True))
    report = inventory_report(expected.select("endpoint", "year"), landed_files(t.spark, path), r"/([a-z]+)/year=([0-9]+)/[^/]+$")
    return report.select("endpoint", "year", (F.col("files") > 0).alias("found"), "passed")


_YEARS = "(SELECT min(year(o_orderdate)) AS low, max(year(o_orderdate)) AS high FROM orders)"
register(
    "src_13_file_inventory",
    "endpoint:text year found:flag passed:flag",
    _inventory,
    f"""SELECT endpoint, y AS year, NOT (endpoint = 'results' AND y = high) AS found,
        NOT (endpoint = 'results' AND y = high OR endpoint = 'laps' AND y = low) AS passed
    FROM (SELECT DISTINCT year(o_orderdate) AS y FROM orders), (VALUES ('results'), ('laps')) e(endpoint), {_YEARS}""",
)

# ---- sinks ------------------------------------------------------------------------------


def _layers(t, *names):
    """Fresh databases for one run, kept under the shared folder."""
    root = scratch_path(t.spark, "warehouse")
    tag = root.rsplit("-", 1)[1][:12]
    made = [f"{n}_{tag}" for n in names]
    create_layers(t.spark, made, root)
    return made


def _bronze_files(t):
    """Orders written in a fixed layout: one column too many, one missing, NULLs as text."""
    path = scratch_path(t.spark, "bronze")
    rows = t.raw("orders").select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority"),
        F.lit("extra").alias("o_extra"),
        F.lit("api").alias("source"),
    )
    columns = ["o_orderkey", "o_missing", "o_orderpriority"]
    write_bronze(rows, path, columns, [F.col("o_orderkey").cast("bigint")])
    return t.spark.read.option("header", True).csv(path)


register(
    "snk_1_bronze_files",
    "o_orderkey o_missing:text o_orderpriority:text source:text",
    _bronze_files,
    "SELECT o_orderkey, 'NULL' AS o_missing, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE 'NULL' END AS "
    "o_orderpriority, 'api' AS source FROM orders",
)


def _fixed_files(t):
    """Orders written twice over different partitions; each file with its rows and whether both have the same bytes."""
    columns = ["o_orderkey", "o_custkey", "o_orderdate"]
    order = [F.col("o_orderkey").cast("bigint").asc()]
    rows = t.raw("orders").select(*columns, F.lit("historical").alias("source"))
    found = []
    for parts in (3, 7):
        path = scratch_path(t.spark, "fixed")
        write_fixed(rows.repartition(parts, "o_custkey"), path, columns, order, _FILE_ROWS)
        files = t.spark.read.format("binaryFile").load(path)
        found.append(files.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.sha2("content", 256).alias("digest"), "content"))
    one, two = found[0], found[1].select("file", F.col("digest").alias("other"))
    lines = F.size(F.split(F.col("content").cast("string"), "\n")) - 2  # the header, and nothing after the last line end
    return one.join(two, "file", "full_outer").select("file", lines.alias("lines"), F.col("digest").eqNullSafe(F.col("other")).alias("same"))


_FILE_ROWS = 4000
register(
    "snk_1_fixed_files",
    "file:text lines same:flag",
    _fixed_files,
    f"""SELECT 'part-' || lpad(CAST(k AS VARCHAR), 5, '0') || '.csv' AS file, count(*) AS lines, true AS same
    FROM (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // {_FILE_ROWS} AS k FROM orders) GROUP BY k""",
)


def _load_modes(t):
    """A table loaded twice, replaced, then appended to; loading it once more in mode ``fail`` is refused."""
    (bronze,) = _layers(t, "bronze")
    path = scratch_path(t.spark, "drivers")
    write_bronze(bronze_tables(t)["drivers"], path, BRONZE_COLUMNS["drivers"])
    for mode in ("replace", "replace", "append"):
        load_table(t.spark, path, f"{bronze}.drivers", BRONZE_COLUMNS["drivers"], mode)
    try:
        load_table(t.spark, path, f"{bronze}.drivers", BRONZE_COLUMNS["drivers"], "fail")
    except AnalysisException:
        pass  # expected; were it loaded, there would be three copies
    return t.spark.table(f"{bronze}.drivers").groupBy("driverId", "driverRef", "number").agg(
        F.count(F.lit(1)).alias("copies")
    )


register(
    "snk_2_load_modes",
    "driverId driverRef:text number:text copies",
    _load_modes,
    "SELECT driver_id AS driverId, driver_ref AS driverRef, CASE WHEN driver_id % 3 <> 0 THEN driver_number END AS "
    "number, 2 AS copies FROM drivers",
    ["drivers"],
)


def _wide_nulls(t):
    """Customers with texts that the wider convention takes as missing, loaded by both conventions."""
    (bronze,) = _layers(t, "bronze")
    path = scratch_path(t.spark, "customers")
    texts = F.array(*[F.lit(x) for x in _MISSING])
    comment = F.when(F.col("c_custkey") % 3 == 0, F.get(texts, (F.col("c_custkey") % len(_MISSING)).cast("int")))
    rows = t.raw("customer").select("c_custkey", F.coalesce(comment, F.col("c_mktsegment")).alias("c_comment"), F.lit("api").alias("source"))
    write_bronze(rows, path, ["c_custkey", "c_comment"])
    for wide in (False, True):
        load_table(t.spark, path, f"{bronze}.customers_{wide}", ["c_custkey", "c_comment"], wide_nulls=wide)
    plain, wide = (t.spark.table(f"{bronze}.customers_{w}") for w in (False, True))
    return plain.select("c_custkey", F.col("c_comment").alias("plain")).join(
        wide.select("c_custkey", F.col("c_comment").alias("wide")), "c_custkey"
    )


_MISSING = ["NA", "None", "nan", "#N/A N/A", "n/a", "NULL", "Nan", "none"]
register(
    "snk_2_wide_nulls",
    "c_custkey plain:text wide:text",
    _wide_nulls,
    "SELECT c_custkey, nullif(c, 'NULL') AS plain, CASE WHEN c NOT IN ('NA', 'None', 'nan', '#N/A N/A', 'n/a', 'NULL') "
    "THEN c END AS wide FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN "
    f"(CAST({_MISSING} AS VARCHAR[]))[c_custkey % {len(_MISSING)} + 1] ELSE c_mktsegment END AS c FROM customer)",
)


def _materialised(t):
    """Two models of different layers written as tables, the second read from the first."""
    bronze, prefix = _layers(t, "bronze", "layer")
    tag = prefix + "_"
    create_layers(t.spark, [f"{tag}silver", f"{tag}marts"], scratch_path(t.spark, "warehouse"))
    write_table(bronze_layout(bronze_tables(t)["races"], BRONZE_COLUMNS["races"]), f"{bronze}.races")
    models = {
        "dim_races": SILVER_MODELS["dim_races"],
        "race_days": Model(
            "marts", lambda r: r.select("race_id", F.col("year").alias("season"), "name", "race_date"), ("dim_races",), "season"
        ),
    }
    built = build_models(t.spark, ["race_days"], bronze, tag, models)
    return t.spark.table(built[-1])


register(
    "snk_4_materialised_models",
    "race_id season name:text race_date:text",
    _materialised,
    "SELECT race_id, year AS season, name, race_date FROM races",
    ["races"],
)


def _changed_seasons(t):
    """All models built over the bronze tables, then again after the results of one season got other points."""
    bronze, prefix = _layers(t, "bronze", "layer")
    tag = prefix + "_"
    create_layers(t.spark, [f"{tag}silver", f"{tag}marts"], scratch_path(t.spark, "warehouse"))
    tables = bronze_tables(t)
    for name in BRONZE_COLUMNS:
        write_table(tables[name], f"{bronze}.{name}")
    state = f"{tag}marts.build_inputs"
    first = build_changed(t.spark, MODELS, bronze, tag, state)
    season = F.floor(F.col("raceId").cast("bigint") / 100)
    points = F.when(season == _CHANGED_SEASON, F.lit("1.25")).otherwise(F.col("points"))
    write_table(tables["results"].withColumn("points", points), f"{bronze}.results")
    second = build_changed(t.spark, MODELS, bronze, tag, state)
    said = lambda w: w if isinstance(w, str) else ",".join(map(str, w))
    runs = [(n, said(first[n]), said(second[n])) for n in MODELS]
    frame = t.spark.createDataFrame(runs, "table_name string, first string, second string")
    return frame.join(table_counts({n: t.spark.table(f"{tag}{m.layer}.{n}") for n, m in MODELS.items()}), "table_name")


_CHANGED_SEASON = 1995
_MART_VIEWS = {
    "race_results_detail": "hub",
    "championship_standings": "standings",
    "driver_season_summary": "driver_seasons",
    "constructor_season_summary": "team_seasons",
    "driver_career": "driver_careers",
    "constructor_career": "team_careers",
    "circuit_stats": "circuit_records",
    "qualifying_vs_race": "quali_race",
    "lap_time_analysis": "lap_analysis",
    "pit_stop_analysis": "pit_analysis",
}
_REWRITTEN = {n: str(_CHANGED_SEASON) for n in BY_SEASON} | dict.fromkeys(
    ("fact_results", "driver_career", "constructor_career", "circuit_stats"), "all"
)
register(
    "snk_4_changed_seasons",
    "table_name:text first:text second:text row_count",
    _changed_seasons,
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, 'all' AS first, '{_REWRITTEN.get(n, '')}' AS second, count(*) AS row_count "
        f"FROM {_MART_VIEWS[n] if n in _MART_VIEWS else '(' + TYPED[n][0] + ')'}"
        for n in MODELS
    ),
    sorted({*_MART_VIEWS.values(), *(v for _, views in TYPED.values() for v in views)}),
)


def _bundle(t):
    """All bronze tables bundled; the qualifying entries read back."""
    root = scratch_path(t.spark, "bundle")
    export_bundle(bronze_tables(t), root)
    read = read_text_csv(t.spark, f"{root}/qualifying", [*BRONZE_COLUMNS["qualifying"], "source"])
    return read.select("qualifyId", "raceId", "driverId", "position", "q1", "q3", "source")


register(
    "snk_5_csv_bundle",
    "qualifyId raceId driverId position q1:text q3:text source:text",
    _bundle,
    "SELECT qualify_id AS qualifyId, race_id AS raceId, driver_id AS driverId, "
    "(qualifying_position - 1) % 20 + 1 AS position, q1_time AS q1, q3_time AS q3, source FROM quali",
    ["quali"],
)
