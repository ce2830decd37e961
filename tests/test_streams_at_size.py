"""Streams of many keys: state by buckets of keys, arrivals in parts of several files."""

import os

from pyspark.sql import functions as F

from gridloom.sources.derived import job_events
from gridloom.streaming import jobs

SF = "/root/testdata/sf0.001"


def test_a_bucket_keeps_its_keys_apart(spark, tmp_path, monkeypatch):
    """Two buckets for all workers, one of them null, strings and longs as keys; parts of several files lose no late row."""
    monkeypatch.setattr(jobs, "BUCKETS", 2)
    table = spark.read.parquet(f"{SF}/events.parquet").withColumn("user_id", F.when(F.col("user_id") % 5 > 0, F.col("user_id")))
    path, files = jobs.deal(table, str(tmp_path / "arrivals"), files=3, piece=100)
    assert files == 3 and all(len([f for f in os.listdir(tmp_path / "arrivals" / part) if f.endswith(".parquet")]) == 3 for part in ("0000", "0001", "0002"))
    drained = jobs.drain(jobs.worker_sessions(job_events(jobs.read_events(spark, path, files))), "update", ["worker"])
    state = spark.read.parquet(f"{SF}/events.parquet").count()
    got = {(r["worker"], r["start_us"]): (r["n"], r["failed"]) for r in jobs.outcomes(drained, "start_us").collect()}
    assert sum(n for n, _ in got.values()) == state
    want: dict = {}
    rows = sorted(((r["worker"], r["us"], r["state"] == "failed") for r in job_events(table).select("worker", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"), "state").collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    last = None
    for worker, us, failed in rows:
        if last is None or last[0] != worker or us >= last[1] + 7_200_000_000:
            start = us
        n, bad = want.get((worker, start), (0, 0))
        want[worker, start] = (n + 1, bad + failed)
        last = (worker, us)
    assert got == want and any(w is None for w, _ in got)


def test_parts_hold_as_many_rows_whatever_their_times(spark, tmp_path):
    """All but a few events in one day of a year: parts of equal width would be one large file; empty tables and equal times too."""
    times = [f"2024-01-01 {k % 24:02}:00:00" for k in range(400)] + ["2024-12-31 00:00:00"]
    events = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "event_id long, t string").select("event_id", F.to_timestamp("t").alias("ts"))
    path, files = jobs.deal(events, str(tmp_path / "a"), piece=20)
    sizes = [spark.read.parquet(f"{tmp_path}/a/{k:04d}").count() for k in range(4)]
    assert sum(sizes) == 401 and min(sizes) > 80 and files == min(sizes) // 20
    assert spark.read.parquet(jobs.deal(events.limit(0), str(tmp_path / "b"), piece=20)[0]).count() == 0
    same = events.withColumns({"ts": F.timestamp_seconds(F.lit(0)), "event_id": F.lit(1).cast("long")})
    path, files = jobs.deal(same, str(tmp_path / "c"), piece=20)
    assert spark.read.parquet(path).count() == 401 and files == len(spark.read.parquet(path).inputFiles())
