"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Wall-clock semantics: trips and weather carry local times without a zone, and
# casts between the two timestamp types must not move them.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_local_base: str | None = None


def build_session(
    app: str = "hailmeter",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Start (or get) a session; `master` is left to spark-submit when None."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_clock(spark: SparkSession) -> None:
    """Make a session that somebody else built follow the wall-clock rule."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder the cluster names.

    Local runs without `spark.checkpoint.dir` get a scratch folder; a cluster
    without it is an error, because executors could not see a local path.
    """
    global _local_base
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if _local_base is None:
            _local_base = tempfile.mkdtemp(prefix="hailmeter-")
        base = _local_base
    return f"{base.rstrip('/')}/hailmeter/{label}-{uuid.uuid4().hex[:12]}"


#: Shuffle files go when their query ends, not when the driver happens to collect its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write once, read back: cuts lineage and survives executor loss.

    Nothing needs the shuffle files behind the table once it is written: they go with the write.
    """
    spark = df.sparkSession
    path = work_dir(spark, label)
    before = spark.conf.get(CLEAN_SHUFFLES, None)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEAN_SHUFFLES)
        else:
            spark.conf.set(CLEAN_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
