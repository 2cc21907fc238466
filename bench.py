"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the folder of tables, ``BENCH_CPUS`` the local cores.
The stored tiers are built first and timed as queries of their own
(``build_*``); the views and slices after that read the stored star. Each
query writes all its rows to the ``noop`` sink, once cold and then once warm; the total is of the
cold runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from clinicmart.session import build_session  # noqa: E402
from registry import marts  # noqa: E402
from registry.queries import all_queries  # noqa: E402

HEADLINE = (
    "extract_tickets", "silver_tickets_repeated", "silver_campaigns", "dedup_first",
    "dense_key_ranges", "fact_visits", "campaign_fact", "star_wide", "kpis_general",
    "saturation_daily", "noshow_specialty", "monthly_series", "kpi_row", "kpi_row_chosen", "kpi_row_summary", "drill_center_summary",
    "drill_specialty", "drill_center", "saturation_center", "detail_header", "detail_rows",
    "profile_nulls", "check_unique", "check_orphans", "check_star",
)
BUILDS = {
    "build_tickets": marts.build_tickets,
    "build_star": marts.build_star,
    "build_summary": marts.build_summary,
    "build_campaigns": marts.build_campaigns,
    "build_campaign_types": marts.build_campaign_types,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.showConsoleProgress": "false",
        },
    )
    # One small job, so that the first figure does not include the start of Spark.
    spark.read.parquet(f"{sf_dir}/region.parquet").count()

    seconds: dict[str, float] = {}
    warm: dict[str, float] = {}

    def timed(name: str, work, into: dict[str, float] = seconds) -> None:
        start = time.perf_counter()
        work()
        into[name] = round(time.perf_counter() - start, 3)

    for name, build in BUILDS.items():
        timed(name, lambda build=build: marts.once(build, spark, sf_dir))
    queries = all_queries()
    for into in (seconds, warm):
        for name in HEADLINE:
            timed(
                name,
                lambda name=name: queries[name](spark, sf_dir)
                .write.format("noop").mode("overwrite").save(),
                into,
            )
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "warm": warm,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
