"""Time the headline queries: ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores.

Prints one JSON line. ``value`` is the sum over the queries; ``build`` holds the seconds to
write each stored model (silver and marts) once. A query is timed from planning (including
its size checks) to the last row, over stored inputs, after one untimed run of the JVM.
"""

from __future__ import annotations

import json
import os
import sys
import time

from lapstack.plans.star import STAR_MODELS, StarTables
from lapstack.registry import landing, load
from lapstack.session import local_session

HEADLINE_GROUPS = ("mart_", "win_", "agg_", "join_", "sort_", "key_", "src_4_flatten_results", "src_5", "src_8", "src_11")
# whole builds, whose parts are measured
NOT_TIMED = ("key_8_bronze_build",)
HEADLINE_ONE_OFF = ("dq_3", "dq_4", "dq_6_unique", "dq_8", "srv_2_season_results", "srv_9_top_teams", "srv_14", "str_1")


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main(argv: list[str]) -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    prefixes = tuple(argv) or HEADLINE_GROUPS + HEADLINE_ONE_OFF
    spark = local_session(cpus, cpus)
    spark.range(1000).selectExpr("id % 10 AS k").groupBy("k").count().collect()

    tables = StarTables(spark, sf_dir)
    build = {name: timed(lambda name=name: tables[name]) for name in STAR_MODELS}
    for endpoint in ("results", "laps"):
        build[f"landed_{endpoint}"] = timed(lambda endpoint=endpoint: landing.payloads(tables, endpoint))
    queries = {}
    for name, query in load().items():
        if name.startswith(prefixes) and (argv or name not in NOT_TIMED):
            queries[name] = timed(lambda query=query: drain(query.run(spark, sf_dir)))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "build": build,
                "build_total": round(sum(build.values()), 3),
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
