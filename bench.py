"""Benchmark: the star-schema build from JSON, the dashboards on the stored tables, and the
same results computed straight from the given tables.

Prints one JSON line. Every query is run once to warm up and then ``BENCH_RUNS``
times (3 by default); the median is reported. Results are forced with the noop
sink, so every row and column is computed. The two build steps run once.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from starmart.catalog.queries import QUERIES, scratch
from starmart.plans import dashboards as dash
from starmart.plans.star_schema import build_star_schema
from starmart.session import build_session
from starmart.sources import json_lines, samples
from starmart.sources.star_tables import read_star_schema

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

DIRECT = [
    "avg_stars_monthly", "daily_fact", "dashboard_payload", "engagement_fact", "kpis_one_business", "monthly_fact",
    "top_categories", "top_states", "top_subcategories",
]


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def force(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def median_of(make) -> float:
    force(make())
    return statistics.median(seconds(lambda: force(make())) for _ in range(RUNS))


def main() -> None:
    spark = build_session(
        "starmart-bench", f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": "16g",
            "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    out = scratch(spark)
    timings: dict[str, float] = {}

    # Not timed: the given tables as the JSON exports the build starts from.
    paths = {}
    for name, frame in samples.sources(spark, SF_DIR).items():
        paths[name] = f"{out}/json/{name}"
        frame.drop("score").repartition(int(CPUS)).write.json(paths[name])

    staged = {}
    timings["build.stage_json"] = seconds(
        lambda: staged.update(json_lines.stage_sources(spark, paths, f"{out}/staged")))
    timings["build.star_schema"] = seconds(lambda: build_star_schema(spark, staged, f"{out}/star"))

    tables = read_star_schema(spark, f"{out}/star")
    dashboards = {
        "manager": dash.manager_dashboard(
            tables["operations/Fact_Operational_Performance"], tables["operations/Dim_Date"],
            tables["marketing/DimUser"]),
        "marketing": dash.marketing_dashboard(
            tables["marketing/FactCustomerEngagement"], tables["marketing/DimDate"],
            tables["marketing/DimBusiness"], tables["marketing/DimUser"]),
        "investor": dash.investor_dashboard(
            tables["manager/Fact_Business_Performance"], tables["manager/Dim_Business"]),
    }
    for dashboard, result_sets in dashboards.items():
        for name, frame in result_sets.items():
            timings[f"{dashboard}.{name}"] = median_of(lambda: frame)
    for name in DIRECT:
        timings[f"direct.{name}"] = median_of(lambda: QUERIES[name](spark, SF_DIR))

    timings = {name: round(value, 3) for name, value in timings.items()}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
