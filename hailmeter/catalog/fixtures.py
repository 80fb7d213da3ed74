"""Trips, zones and weather derived from the given tables.

The texts are plain SQL that Spark and DuckDB both run, but for WALL_CLOCK(n),
which stands for the zone-less timestamp n seconds after 1970 (1735689600 is
2025-01-01). Money and distances are multiples of 1/64, so sums of doubles are
exact in any order.

* trips come from `lineitem`, one trip per line, some of them twice;
* zones from `supplier` with its nation and region, one zone per supplier;
* hourly weather from `orders`, each order being one station reading that is
  grouped into one of 7,248 hours (January to May of two years).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailmeter import schemas
from hailmeter.functions import sky

CATCH_ALL_IDS = (22, 23)

TRIPS = """
SELECT CASE WHEN (l_orderkey + l_partkey) % 10 = 0 THEN 'green' ELSE 'yellow' END AS feed,
  1 + l_partkey % 2 AS vendor,
  1735689600 + 86400 * ((l_orderkey * 7 + l_partkey) % 151
      + CASE WHEN l_linenumber % 2 = 0 THEN 365 ELSE 0 END
      + CASE WHEN l_orderkey % 997 = 0 THEN 730 ELSE 0 END
      + CASE WHEN l_orderkey % 991 = 0 THEN 160 ELSE 0 END)
    + (l_orderkey * 613 + l_partkey * 97 + l_suppkey * 31) % 86400 AS pickup,
  CAST(CASE WHEN l_partkey % 501 = 0 THEN -90
    WHEN l_partkey % 87 = 0 THEN 20
    WHEN l_partkey % 203 = 0 THEN 16000
    ELSE l_quantity * 60 + l_suppkey % 60 END AS INT) AS seconds,
  CASE WHEN l_partkey % 4 = 0 THEN NULL ELSE CAST(l_linenumber % 7 AS DOUBLE) END AS passengers,
  CAST(CASE WHEN l_partkey % 1999 = 0 THEN 150
    WHEN l_partkey % 577 = 0 THEN -1
    WHEN l_partkey % 37 = 0 THEN 0
    WHEN l_partkey % 61 = 0 THEN NULL
    ELSE l_quantity / 4 END AS DOUBLE) AS distance,
  CASE WHEN l_orderkey % 26 = 25 THEN -1 ELSE l_suppkey END AS from_zone,
  CAST(FLOOR(l_partkey / 20) AS BIGINT) AS to_zone,
  CAST((l_linenumber + l_orderkey) % 7 AS BIGINT) AS payment,
  CASE WHEN l_orderkey % 33 = 0 THEN -1 WHEN l_orderkey % 71 = 0 THEN NULL ELSE 1 END
    * CAST(CAST(FLOOR(l_extendedprice) AS BIGINT) % 6000 AS DOUBLE) / 64 AS fare,
  CAST(l_partkey % 3 AS DOUBLE) AS extra,
  CAST(0.5 AS DOUBLE) AS mta_tax,
  CASE WHEN l_partkey % 59 = 0 THEN NULL
    WHEN (l_linenumber + l_orderkey) % 7 = 1 THEN CAST(l_partkey % 40 AS DOUBLE) / 8
    ELSE CAST(0 AS DOUBLE) END AS tip,
  CASE WHEN l_suppkey % 12 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls,
  CAST(1 AS DOUBLE) AS improvement,
  CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE CAST(2.5 AS DOUBLE) END AS congestion,
  CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE CAST(0.75 AS DOUBLE) END AS cbd,
  CASE WHEN l_suppkey % 9 = 0 THEN CAST(1.75 AS DOUBLE) ELSE NULL END AS airport,
  CASE WHEN l_orderkey % 47 = 0 THEN CAST(l_partkey % 13 AS DOUBLE) / 4
    ELSE CAST(0 AS DOUBLE) END AS off_by,
  l_orderkey % 89 = 0 AS waived
FROM (SELECT * FROM lineitem
  UNION ALL SELECT * FROM lineitem WHERE l_orderkey % 83 = 0) AS lines
"""

# {p} is the feed's prefix, {own} its own columns, {feed} its name. The
# congestion fee is missing from the total of payment type 0.
FEED = """
SELECT vendor AS VendorID,
  WALL_CLOCK(pickup) AS {p}_pickup_datetime,
  WALL_CLOCK(pickup + seconds) AS {p}_dropoff_datetime,
  passengers AS passenger_count, distance AS trip_distance,
  CAST(1 AS DOUBLE) AS RatecodeID, 'N' AS store_and_fwd_flag,
  from_zone AS PULocationID, to_zone AS DOLocationID, payment AS payment_type,
  fare AS fare_amount, extra, mta_tax, tip AS tip_amount, tolls AS tolls_amount,
  improvement AS improvement_surcharge,
  CASE WHEN waived THEN CAST(0 AS DOUBLE)
    ELSE COALESCE(fare, 0) + extra + mta_tax + COALESCE(tip, 0) + tolls + improvement
      + CASE WHEN payment = 0 THEN CAST(0 AS DOUBLE) ELSE COALESCE(congestion, 0) END
      + COALESCE(cbd, 0) + {airport} + off_by END AS total_amount,
  congestion AS congestion_surcharge, cbd AS cbd_congestion_fee, {own}
FROM fx_trips WHERE feed = '{feed}'
"""

YELLOW = FEED.format(
    p="tpep", feed="yellow", airport="COALESCE(airport, 0)", own="airport AS Airport_fee"
)
GREEN = FEED.format(
    p="lpep",
    feed="green",
    airport="CAST(0 AS DOUBLE)",
    own="CAST(NULL AS DOUBLE) AS ehail_fee, CAST(1 AS BIGINT) AS trip_type",
)

ZONES = """
SELECT CAST(s_suppkey AS INT) AS LocationID,
  CASE s_suppkey % 25 WHEN 22 THEN 'Unknown' WHEN 23 THEN 'N/A' WHEN 24 THEN 'EWR' ELSE
    CASE r_name WHEN 'AFRICA' THEN 'Bronx' WHEN 'AMERICA' THEN 'Brooklyn'
      WHEN 'ASIA' THEN 'Manhattan' WHEN 'EUROPE' THEN 'Queens' ELSE 'Staten Island' END
  END AS Borough,
  s_name AS Zone,
  CASE WHEN r_name = 'ASIA' THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""

# A storm of 11 hours (first year) or 27 hours (second year) every 30 days.
WEATHER = """
SELECT WALL_CLOCK(1735689600 + 3600 * h + CASE WHEN h >= 3624 THEN 214 * 86400 ELSE 0 END)
    AS datetime_local,
  20 + AVG(CAST(o_custkey % 64 AS DOUBLE)) AS temperature_f,
  16 + AVG(CAST(o_custkey % 64 AS DOUBLE)) AS apparent_temperature_f,
  MAX(CASE WHEN s IN (3, 4, 7, 8, 23) THEN CAST(h % 7 + 1 AS DOUBLE) / 16
    ELSE CAST(0 AS DOUBLE) END) AS precipitation_inch,
  MAX(CASE WHEN s IN (3, 4, 23) THEN CAST(h % 7 + 1 AS DOUBLE) / 16
    ELSE CAST(0 AS DOUBLE) END) AS rain_inch,
  MAX(CASE WHEN s IN (7, 8, 25) THEN CAST(h % 5 + 1 AS DOUBLE) / 8
    ELSE CAST(0 AS DOUBLE) END) AS snowfall_inch,
  CAST(MAX(h % 3) AS DOUBLE) / 8 AS snow_depth_inch,
  MAX(CAST(CASE s WHEN 3 THEN 63 WHEN 4 THEN 61 WHEN 7 THEN 73 WHEN 8 THEN 75 WHEN 11 THEN 53
    WHEN 13 THEN 45 WHEN 17 THEN 2 WHEN 19 THEN 3 WHEN 23 THEN 80 WHEN 25 THEN 86
    WHEN 27 THEN 95 WHEN 28 THEN 10 ELSE 0 END AS INT)) AS weather_code,
  CAST(MAX(h % 31) AS DOUBLE) AS wind_speed_mph,
  CAST(MAX(h % 31) AS DOUBLE) + MAX(CAST(o_custkey % 8 AS DOUBLE)) AS wind_gusts_mph,
  CAST(MIN(o_custkey % 100) AS INT) AS relative_humidity_pct,
  CAST(MAX(o_orderkey % 1000) AS DOUBLE) * 32 AS visibility_ft
FROM (SELECT h, o_orderkey, o_custkey,
    CASE WHEN h % 720 >= 300 AND h % 720 < CASE WHEN h < 3624 THEN 311 ELSE 327 END THEN 7
      ELSE h % 29 END AS s
  FROM (SELECT o_orderkey % 7248 AS h, o_orderkey, o_custkey FROM orders) AS readings) AS marked
GROUP BY h
"""


@dataclass(frozen=True)
class Bronze:
    yellow: DataFrame
    green: DataFrame
    zones: DataFrame
    weather: DataFrame


def given(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wall_clock(text: str, call: str) -> str:
    """Spell WALL_CLOCK(...) for one engine; arguments nest no such call."""
    out, rest = "", text
    while "WALL_CLOCK(" in rest:
        before, _, rest = rest.partition("WALL_CLOCK(")
        depth = 1
        for end, char in enumerate(rest):
            depth += (char == "(") - (char == ")")
            if depth == 0:
                break
        out += before + call.format(rest[:end])
        rest = rest[end + 1 :]
    return out + rest


SPARK_CLOCK = "CAST(TIMESTAMP_SECONDS({}) AS TIMESTAMP_NTZ)"
DUCKDB_CLOCK = "MAKE_TIMESTAMP(CAST({} AS BIGINT) * 1000000)"


def _run(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    text = wall_clock(text, SPARK_CLOCK)
    for name in frames:
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(
            f"JOIN {name}", f"JOIN {{{name}}}"
        )
    return spark.sql(text, **frames)


def bronze(spark: SparkSession, sf_dir: str) -> Bronze:
    """The four bronze tables over one folder of given tables."""
    trips = _run(spark, TRIPS, lineitem=given(spark, sf_dir, "lineitem"))
    weather = _run(spark, WEATHER, orders=given(spark, sf_dir, "orders"))
    return Bronze(
        yellow=_run(spark, YELLOW, fx_trips=trips),
        green=_run(spark, GREEN, fx_trips=trips),
        zones=_run(
            spark,
            ZONES,
            supplier=given(spark, sf_dir, "supplier"),
            nation=given(spark, sf_dir, "nation"),
            region=given(spark, sf_dir, "region"),
        ),
        weather=weather.withColumn(
            "weather_description", sky.description(F.col("weather_code"))
        ).select(*schemas.HOURLY_WEATHER.fieldNames()),
    )
