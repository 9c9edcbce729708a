"""Registered data checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lapstack.operators.bitmaps import Link
from lapstack.operators.groups import union_all
from lapstack.plans import quality
from lapstack.plans.silver import silver_table
from lapstack.plans.star import RAW
from lapstack.plans.star_bronze import bronze_tables
from lapstack.registry.core import register
from lapstack.registry.sources import _layers
from lapstack.registry.typed import TYPED
from lapstack.schemas import (
    BRONZE_FOREIGN_KEYS,
    ID_COLUMNS,
    NOT_NULL_COLUMNS,
    RELATIONSHIPS,
    SILVER_FIELDS,
    UNIQUE_COLUMNS,
)
from lapstack.session import scratch_path
from lapstack.sources.sinks import table_counts

REPORT = "check:text table_name:text column_name:text violations passed:flag"


def _line(check: str, table: str, column: str, count: str) -> str:
    """One report row from a scalar sub-query."""
    return (
        f"SELECT '{check}' AS \"check\", '{table}' AS table_name, '{column}' AS column_name, "
        f"v AS violations, v = 0 AS passed FROM ({count}) counted(v)"
    )


def _null_lines(table: str, view: str, columns: list[str]) -> str:
    """Report rows for the NULLs of all columns of a view, from one pass over it."""
    counts = ", ".join(f"count(*) FILTER ({c} IS NULL) AS {c}" for c in columns)
    return (
        f"SELECT 'not_null' AS \"check\", '{table}' AS table_name, column_name, v AS violations, v = 0 AS passed FROM "
        f"(UNPIVOT (SELECT {counts} FROM {view}) ON COLUMNS(*) INTO NAME column_name VALUE v)"
    )


def _lines(*parts: str) -> str:
    return " UNION ALL ".join(parts)


def _exists(t):
    """All supplied tables as tables of a database over the files, and one that is not there."""
    (bronze,) = _layers(t, "bronze")
    for name in RAW:
        t.spark.sql(f"CREATE TABLE {bronze}.{name} USING parquet LOCATION '{t.sf_dir}/{name}.parquet'")
    names = [*RAW, "constructor_results"]
    report = quality.tables_exist(t.spark, [f"{bronze}.{n}" for n in names])
    # counted against the tables themselves, so the check reads what it found
    rows = table_counts({n: t.spark.table(f"{bronze}.{n}") for n in RAW}).withColumnRenamed("row_count", "rows_found")
    named = report.withColumn("table_name", F.element_at(F.split("table_name", "[.]"), -1))
    return named.join(rows, "table_name", "left")


register(
    "dq_1_table_exists",
    REPORT + " rows_found",
    _exists,
    " UNION ALL ".join(
        f"SELECT 'table_exists' AS \"check\", '{n}' AS table_name, '' AS column_name, 0 AS violations, true AS passed, "
        f"count(*) AS rows_found FROM {n}"
        for n in RAW
    )
    + " UNION ALL SELECT 'table_exists', 'constructor_results', '', 1, false, NULL",
)
_MINIMUM = {"customer": 1, "lineitem": 50_000, "supplier": 1_000_000_000}
register(
    "dq_2_row_count",
    REPORT,
    lambda t: union_all([quality.row_count(t.raw(n), n, least) for n, least in _MINIMUM.items()]),
    _lines(*[_line("row_count", n, "", f"SELECT greatest({m} - count(*), 0) FROM {n}") for n, m in _MINIMUM.items()]),
)
_KEYS = [
    ("region", "r_regionkey"),
    ("nation", "n_nationkey"),
    ("customer", "c_custkey"),
    ("supplier", "s_suppkey"),
    ("part", "p_partkey"),
    ("orders", "o_orderkey"),
    ("orders", "o_custkey"),
    ("lineitem", "l_orderkey"),
    ("events", "event_id"),
    ("labels", "doc_id"),
    ("conversations", "conv_id"),
]


def _repeated(table: str, column: str) -> str:
    return f"SELECT count(*) FROM (SELECT {column} FROM {table} GROUP BY {column} HAVING count(*) > 1)"


register(
    "dq_3_primary_keys",
    REPORT,
    lambda t: union_all([quality.primary_key(t.raw(n), n, k) for n, k in _KEYS]),
    _lines(
        *[
            _line(
                "primary_key", n, k, f"SELECT (SELECT count(*) FROM {n} WHERE {k} IS NULL) + ({_repeated(n, k)})"
            )
            for n, k in _KEYS
        ]
    ),
)
# parents with rows taken out, so that orphans exist
_LINKS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey", "o_orderstatus <> 'P'"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey", "s_acctbal > 0"),
    ("lineitem", "l_partkey", "part", "p_partkey", "true"),
    ("orders", "o_custkey", "customer", "c_custkey", "c_nationkey <> 3"),
    ("customer", "c_nationkey", "nation", "n_nationkey", "n_regionkey <> 2"),
    ("nation", "n_regionkey", "region", "r_regionkey", "true"),
    ("labels", "doc_id", "documents", "doc_id", "lang = 'en'"),
]


def _orphans(table: str, column: str, parent: str, key: str, kept: str = "true") -> str:
    return (
        f"SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {key} FROM {parent} WHERE {kept} AND {key} IS NOT NULL)"
    )


def _keys_by_bitmap(t):
    """The same links, all keys from one pass over each child."""
    parents = {(p, kept): t.raw(p).filter(kept) for _, _, p, _, kept in _LINKS}
    links = [Link(n, c, parents[p, kept], k) for n, c, p, k, kept in _LINKS]
    return quality.foreign_keys({n: t.raw(n) for n, *_ in _LINKS}, links)


register(
    "dq_4_foreign_key_bitmaps",
    REPORT,
    _keys_by_bitmap,
    _lines(*[_line("foreign_key", n, c, _orphans(n, c, p, k, kept)) for n, c, p, k, kept in _LINKS]),
)
register(
    "dq_4_foreign_keys",
    REPORT,
    lambda t: union_all(
        [quality.foreign_key(t.raw(n), n, c, t.raw(p).filter(kept), k) for n, c, p, k, kept in _LINKS]
    ),
    _lines(*[_line("foreign_key", n, c, _orphans(n, c, p, k, kept)) for n, c, p, k, kept in _LINKS]),
)


def _tagged(t):
    state = F.col("o_orderstatus")
    source = F.when(state == "F", "historical").when(state == "O", "api").when(F.col("o_orderkey") % 3 == 0, "manual")
    return t.raw("orders").withColumn("source", source)


_SOURCE_SQL = (
    "(SELECT CASE o_orderstatus WHEN 'F' THEN 'historical' WHEN 'O' THEN 'api' ELSE "
    "CASE WHEN o_orderkey % 3 = 0 THEN 'manual' END END AS source FROM orders)"
)
register(
    "dq_5_accepted_source",
    REPORT,
    lambda t: union_all(
        [
            quality.accepted_source(_tagged(t), "orders", null_allowed=True),
            quality.accepted_source(_tagged(t), "orders_strict", null_allowed=False),
        ]
    ),
    _lines(
        _line("accepted_source", "orders", "source", f"SELECT count(*) FILTER (source = 'manual') FROM {_SOURCE_SQL}"),
        _line(
            "accepted_source",
            "orders_strict",
            "source",
            f"SELECT count(*) FILTER (source IS NULL OR source = 'manual') FROM {_SOURCE_SQL}",
        ),
    ),
)
register(
    "dq_5_source_counts",
    "source:text row_count",
    lambda t: quality.source_counts(_tagged(t)),
    f"SELECT source, count(*) AS row_count FROM {_SOURCE_SQL} GROUP BY source",
)

# declared rules over every typed table and mart of the star schema
_VIEW_OF = {
    "dim_drivers": "drivers",
    "dim_constructors": "teams",
    "dim_circuits": "circuits",
    "dim_races": "races",
    "dim_status": "status",
    "fact_results": "results",
    "fact_qualifying": "quali",
    "fact_sprint_results": "sprints",
    "fact_lap_times": "laps",
    "fact_pit_stops": "pits",
    "race_results_detail": "hub",
    "driver_season_summary": "driver_seasons",
    "constructor_season_summary": "team_seasons",
    "championship_standings": "standings",
    "lap_time_analysis": "lap_analysis",
    "pit_stop_analysis": "pit_analysis",
    "qualifying_vs_race": "quali_race",
    "driver_career": "driver_careers",
    "constructor_career": "team_careers",
    "circuit_stats": "circuit_records",
}
# tables that the star schema lacks, as typed from the bronze ones
_TYPED_ONLY = ("dim_seasons", "fact_driver_standings", "fact_constructor_standings")
_VIEW_OF |= {n: f"({TYPED[n][0]})" for n in _TYPED_ONLY}
_CHECKED_VIEWS = sorted({v for n, v in _VIEW_OF.items() if n not in _TYPED_ONLY} | {v for n in _TYPED_ONLY for v in TYPED[n][1]})


def _checked(t, names):
    return {
        n: silver_table(n, bronze_tables(t)[SILVER_FIELDS[n][0]]) if n in _TYPED_ONLY else t[n] for n in names
    }


_NOT_NULL = {t: c for t, c in NOT_NULL_COLUMNS.items() if t in _VIEW_OF}
_UNIQUE = {t: c for t, c in UNIQUE_COLUMNS.items() if t in _VIEW_OF}
_RELATED = [r for r in RELATIONSHIPS if r[0] in _VIEW_OF and r[2] in _VIEW_OF]
register(
    "dq_6_not_null",
    REPORT,
    lambda t: quality.declared_rules(_checked(t, _NOT_NULL), {}, _NOT_NULL, []),
    _lines(*[_null_lines(n, _VIEW_OF[n], columns) for n, columns in _NOT_NULL.items()]),
    _CHECKED_VIEWS,
)
register(
    "dq_6_unique",
    REPORT,
    lambda t: quality.declared_rules(_checked(t, _UNIQUE), _UNIQUE, {}, []),
    _lines(*[_line("unique", n, c, _repeated(_VIEW_OF[n], c)) for n, columns in _UNIQUE.items() for c in columns]),
    _CHECKED_VIEWS,
)
register(
    "dq_6_relationships",
    REPORT,
    lambda t: quality.declared_rules(_checked(t, {x for r in _RELATED for x in (r[0], r[2])}), {}, {}, _RELATED),
    _lines(*[_line("relationship", n, c, _orphans(_VIEW_OF[n], c, _VIEW_OF[p], c)) for n, c, p in _RELATED]),
    _CHECKED_VIEWS,
)


def _while_writing(t):
    """All 23 typed tables and marts written anew, every rule told from the writes and one count of keys for a table."""
    root = scratch_path(t.spark, "checked")

    def write(name, rows):
        rows.write.option("compression", "zstd").parquet(f"{root}/{name}")
        return t.spark.read.schema(rows.schema).parquet(f"{root}/{name}")

    return quality.written_and_checked(_checked(t, _VIEW_OF), write, _UNIQUE, _NOT_NULL, _RELATED, _SOURCED)


_SOURCED = sorted(n for n in _VIEW_OF if n.startswith("fact_"))
register(
    "dq_6_while_writing",
    REPORT,
    _while_writing,
    _lines(
        *[_line("row_count", n, "", f"SELECT (count(*) = 0)::INT FROM {v}") for n, v in _VIEW_OF.items()],
        *[_null_lines(n, _VIEW_OF[n], columns) for n, columns in _NOT_NULL.items()],
        *[_line("unique", n, c, _repeated(_VIEW_OF[n], c)) for n, columns in _UNIQUE.items() for c in columns],
        *[_line("relationship", n, c, _orphans(_VIEW_OF[n], c, _VIEW_OF[p], c)) for n, c, p in _RELATED],
        *[_line("accepted_source", n, "source", f"SELECT count(*) FILTER (source NOT IN ('historical', 'api')) FROM {_VIEW_OF[n]}") for n in _SOURCED],
    ),
    _CHECKED_VIEWS,
)
_BROKEN = "total_podiums < 100 OR races_hosted < seasons_hosted OR first_season > last_season OR unique_drivers > 50"
register(
    "dq_7_invariants",
    "circuit_id total_wins total_podiums races_hosted seasons_hosted",
    lambda t: quality.violating(t["circuit_stats"], quality.circuit_invariants()).unionByName(
        quality.violating(t["circuit_stats"], ~F.expr(_BROKEN))
    ),
    "SELECT circuit_id, total_wins, total_podiums, races_hosted, seasons_hosted FROM circuit_records WHERE "
    "total_wins < 0 OR total_podiums < total_wins OR races_hosted < seasons_hosted OR first_season > last_season OR "
    "latest_season < last_season UNION ALL SELECT circuit_id, total_wins, total_podiums, races_hosted, seasons_hosted "
    f"FROM circuit_records WHERE {_BROKEN}",
    ["circuit_records"],
)
register(
    "dq_8_hub_orphans",
    "race_driver_key:text",
    lambda t: quality.hub_orphans(
        t["race_results_detail"],
        t["dim_drivers"].filter("driver_id % 11 <> 0"),
        t["dim_constructors"].filter("constructor_id % 13 <> 0"),
        t["dim_circuits"].filter("circuit_id <> 2"),
        t["dim_races"].filter("round <> 9"),
    ),
    "SELECT race_driver_key FROM hub WHERE driver_id % 11 = 0 OR constructor_id % 13 = 0 OR circuit_id = 2 OR round = 9",
    ["hub"],
)

_SILVER_OF = {bronze: name for name, (bronze, _) in SILVER_FIELDS.items()}
_TYPED_COLUMN = {
    b: {f.source: f.out for f in fields} for b, fields in ((bronze, fs) for bronze, fs in SILVER_FIELDS.values())
}
_BRONZE_SQL = "WITH " + ", ".join(f"b_{b} AS ({TYPED[n][0]})" for b, n in _SILVER_OF.items()) + " "


def _bad_source(table: str) -> str:
    return f"SELECT count(*) FROM b_{table} WHERE source IS NOT NULL AND source NOT IN ('historical', 'api')"


_REPORT_SQL = _lines(
    *[_line("row_count", b, "", f"SELECT greatest(0 - count(*), 0) FROM b_{b}") for b in _SILVER_OF],
    *[_line("primary_key", b, k, _repeated(f"b_{b}", _TYPED_COLUMN[b][k])) for b, k in ID_COLUMNS.items()],
    *[
        _line("foreign_key", b, c, _orphans(f"b_{b}", _TYPED_COLUMN[b][c], f"b_{p}", _TYPED_COLUMN[p][ID_COLUMNS[p]]))
        for b, c, p in BRONZE_FOREIGN_KEYS
    ],
    *[_line("accepted_source", b, "source", _bad_source(b)) for b in _SILVER_OF],
)
_VIEWS = sorted({v for _, views in TYPED.values() for v in views})
register("dq_9_report", REPORT, lambda t: quality.bronze_report(bronze_tables(t)), _BRONZE_SQL + _REPORT_SQL, _VIEWS)
register(
    "dq_9_passed",
    "passed:flag",
    lambda t: quality.report_passed(quality.bronze_report(bronze_tables(t))),
    f'{_BRONZE_SQL} SELECT bool_and(passed) AS passed FROM ({_REPORT_SQL}) WHERE "check" <> \'accepted_source\'',
    _VIEWS,
)
