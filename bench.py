"""Time the pipeline and the headline queries; prints one JSON line.

    BENCH_SF_DIR   folder of given tables   (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores              (default 8)

The layers are built once, as a production run does, and timed one by one. The
reports then read the stored mart; the `direct_` entries compute the same
reports from the bronze tables in a single pass without any stored layer.
"""

from __future__ import annotations

import json
import os
import sys
import time

from hailmeter.catalog import landing
from hailmeter.catalog.queries import QUERIES, Scene
from hailmeter.functions import rules
from hailmeter.operators import conform
from hailmeter.operators.demand import mart_weather_demand
from hailmeter.operators.enrich import fact_trips
from hailmeter.plans import expectations, pipeline, quality, reports, segments
from hailmeter.session import build_session, work_dir
from hailmeter.sources.tables import overwrite_table

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = build_session(
        "bench",
        f"local[{CPUS}]",
        {
            "spark.sql.shuffle.partitions": CPUS,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name, work):
        started = time.perf_counter()
        result = work()
        seconds[name] = round(time.perf_counter() - started, 3)
        print(f"{name:32} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
        return result

    def drain(df):
        df.write.format("noop").mode("overwrite").save()

    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors

    # Inputs: the fixture tables, and the same tables laid out as landed files.
    source = timed("input_bronze_tables", lambda: landing.stored_bronze(spark, SF_DIR))
    landed = timed("input_landed_files", lambda: landing.land_all(spark, source))
    inputs = {"input_bronze_tables", "input_landed_files"}

    # One full run over landed files, and the layers one by one.
    timed(
        "pipeline_end_to_end",
        lambda: pipeline.run_pipeline(spark, landed, work_dir(spark, "bench"))[2].collect(),
    )
    base = work_dir(spark, "bench-layers")
    silver = timed(
        "silver_trips",
        lambda: overwrite_table(
            conform.stage_trips(source.yellow, source.green), f"{base}/stg_trips"
        ),
    )
    zones = conform.dim_zones(conform.stage_zones(source.zones))
    hours = conform.stage_weather(source.weather)
    weather = conform.dim_weather(hours)
    fact = timed(
        "gold_fact",
        lambda: overwrite_table(
            fact_trips(silver, zones, weather, years=rules.VALID_YEARS),
            f"{base}/fct_trips",
            partition_by=("pickup_year", "pickup_month"),
        ),
    )
    mart = timed(
        "gold_mart", lambda: overwrite_table(mart_weather_demand(fact), f"{base}/mart")
    )

    for name, build in {
        "monthly_volume": lambda: reports.monthly_volume(mart),
        "hourly_demand_weekpart": lambda: reports.hourly_demand_weekpart(mart, weather),
        "avg_trip_cost": lambda: reports.avg_trip_cost(mart),
        "adverse_demand_change": lambda: reports.adverse_demand_change(mart, weather),
        "weather_type_demand_change": lambda: reports.weather_type_demand_change(mart, weather),
        "adverse_revenue_delta": lambda: reports.adverse_revenue_delta(mart, weather),
        "borough_share_shift": lambda: reports.borough_share_shift(mart),
        "revenue_per_active_minute": lambda: reports.revenue_per_active_minute(mart),
        "trips_per_hour": lambda: reports.trips_per_hour(mart, weather),
        "storm_severity": lambda: reports.storm_severity(hours),
        "dq_reason_topk": lambda: quality.dq_reason_topk(silver),
        "dq_rule_counts": lambda: quality.dq_rule_counts(silver),
        "dq_exploratory_counts": lambda: quality.dq_exploratory_counts(silver),
        "duplicate_trips": lambda: quality.duplicate_trips(silver),
        "total_mismatch": lambda: quality.total_mismatch(fact),
        "tip_audit": lambda: quality.tip_audit(fact),
        "pickup_flows": lambda: reports.pickup_flows(fact),
        "zone_features": lambda: segments.zone_features(fact),
    }.items():
        timed(name, lambda: build().collect())

    tables = {
        "zone_lookup": source.zones,
        "stg_trips": silver,
        "stg_zones": conform.stage_zones(source.zones),
        "stg_weather": hours,
        "fct_trips": fact,
        "mart_weather_demand": mart,
        "dim_zones": zones,
        "dim_weather": weather,
    }
    timed("expectations_suite", lambda: expectations.run_expectations(tables).collect())
    timed(
        "kmeans_all_k",
        lambda: segments.davies_bouldin_by_k(
            segments.fit_segments(segments.zone_features(fact))
        ).collect(),
    )
    for name in (
        "stg_trips", "fact_trips", "fact_trips_salted", "mart_weather_demand",
        "adverse_demand_change", "adverse_revenue_delta", "avg_trip_cost",
    ):
        timed(f"direct_{name}", lambda: drain(QUERIES[name](Scene(spark, SF_DIR))))

    trips = silver.count()
    print(
        json.dumps(
            {
                "metric": "hailmeter total seconds (layers, reports, checks, clustering)",
                "value": round(sum(v for k, v in seconds.items() if k not in inputs), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": SF_DIR.rstrip("/").rpartition("sf")[2],
                "cpus": int(CPUS),
                "trips": trips,
                "pipeline_trips_per_sec": round(trips / seconds["pipeline_end_to_end"]),
            }
        )
    )


if __name__ == "__main__":
    main()
