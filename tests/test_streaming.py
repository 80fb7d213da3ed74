"""Exactly-once loading and continuous hourly demand."""

from hailmeter import schemas
from hailmeter.operators import conform
from hailmeter.streaming import hourly, incremental


def _green(hour, n=1, day=5):
    stamp = f"2025-03-{day:02} {hour:02}"
    return [dict(pickup=f"{stamp}:0{i}:00", dropoff=f"{stamp}:30:00") for i in range(n)]


def test_files_load_once(spark, make_feed, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))

    def load():
        stream = incremental.read_landing(spark, landing, schemas.GREEN_FILE)
        return incremental.incremental_load(stream, table, checkpoint).count()

    make_feed("green", *_green(8, 3)).write.parquet(landing)
    assert (load(), load()) == (3, 3)
    make_feed("green", *_green(9, 2)).write.mode("append").parquet(landing)
    assert (load(), load()) == (5, 5)


def test_stream_silver_equals_batch_silver(spark, make_feed, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("yellow", "green", "table", "checkpoint")}
    make_feed("yellow", {}, dict(fare_amount=-1.0)).write.parquet(paths["yellow"])
    make_feed("green", {}).write.parquet(paths["green"])
    streamed = incremental.stream_stage_trips(
        incremental.read_landing(spark, paths["yellow"], schemas.YELLOW_FILE),
        incremental.read_landing(spark, paths["green"], schemas.GREEN_FILE),
        paths["table"],
        paths["checkpoint"],
    )
    batch = conform.stage_trips(
        spark.read.parquet(paths["yellow"]), spark.read.parquet(paths["green"])
    )
    assert sorted(map(str, streamed.collect())) == sorted(map(str, batch.collect()))


def test_hours_grow_as_files_land(spark, make_feed, make_weather, tmp_path):
    landing, table, checkpoint = (str(tmp_path / n) for n in ("landing", "table", "checkpoint"))
    weather = conform.stage_weather(
        make_weather(("2025-03-05 08:00:00", 61, 0.0, 0.0), ("2025-03-05 09:00:00", 0, 0.0, 0.0))
    )

    def run():
        stream = conform.conform_green(
            incremental.read_landing(spark, landing, schemas.GREEN_FILE)
        )
        rows = hourly.stream_hourly_demand(stream, weather, table, checkpoint).collect()
        return sorted((r.hour_start.hour, r.trip_count, r.weather_category) for r in rows)

    make_feed("green", *_green(8, 3)).write.parquet(landing)
    assert run() == [(8, 3, "Rain")]
    make_feed("green", *_green(8, 2), *_green(9, 1)).write.mode("append").parquet(landing)
    assert run() == [(8, 5, "Rain"), (9, 1, "Clear")]
    assert run() == [(8, 5, "Rain"), (9, 1, "Clear")]


def _month(month, n):
    return [
        dict(pickup=f"2025-{month:02}-{d:02} 0{d % 9}:00:00", dropoff=f"2025-{month:02}-{d:02} 10:00:00")
        for d in range(1, n + 1)
    ]


def test_old_hours_leave_the_state_and_stay_in_the_table(spark, make_feed, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("yellow", "green", "table", "checkpoint")}
    for month in range(1, 6):
        for feed in ("yellow", "green"):
            rows = make_feed(feed, *_month(month, 25))
            rows.coalesce(1).write.parquet(f"{paths[feed]}/landed={month}")
    streams = (
        incremental.read_landing(spark, f"{paths['yellow']}/landed=*", schemas.YELLOW_FILE, 1),
        incremental.read_landing(spark, f"{paths['green']}/landed=*", schemas.GREEN_FILE, 1),
    )
    counts = hourly.hourly_counts(hourly.timed_trips(*streams, "5 days"))
    state = hourly.run_backlog(counts, paths["table"], paths["checkpoint"])
    # 125 groups in all; a batch holds its month, the one before and what was open of the
    # one before that, and at the end only the last days of the last month are open
    assert max(state) <= 60 and state[-1] <= 10, state
    found = hourly.hourly_table(spark, paths["table"], counts)
    assert found.count() == 5 * 25 and found.agg({"trip_count": "sum"}).first()[0] == 250
    # nothing new: a rerun changes nothing
    hourly.run_backlog(counts, paths["table"], paths["checkpoint"])
    assert hourly.hourly_table(spark, paths["table"], counts).count() == 125


def test_a_batch_that_is_tried_again_changes_nothing(spark, make_feed, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("green", "table", "checkpoint")}
    make_feed("green", *_green(8, 3)).write.parquet(paths["green"])

    def run():
        stream = conform.conform_green(
            incremental.read_landing(spark, paths["green"], schemas.GREEN_FILE)
        )
        counts = hourly.hourly_counts(stream)
        hourly.run_backlog(counts, paths["table"], paths["checkpoint"])
        return [r.trip_count for r in hourly.hourly_table(spark, paths["table"], counts).collect()]

    assert run() == [3]
    make_feed("green", *_green(8, 2)).write.mode("append").parquet(paths["green"])
    assert run() == [5]
    # the log of finished batches is lost: the last one runs again
    commits = sorted((tmp_path / "checkpoint" / "commits").iterdir(), key=lambda f: f.name.strip("."))
    last = max(int(f.name) for f in commits if f.name.isdigit())
    for f in commits:
        if f.name in (str(last), f".{last}.crc"):
            f.unlink()
    assert run() == [5]
