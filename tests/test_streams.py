"""Streams over shuffled files, several to a batch, against the batch answer; what the watermark has passed is settled and leaves the state."""

import os

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from gridloom.plans import registry
from gridloom.sources.derived import job_events
from gridloom.streaming import jobs

SF = "/root/testdata/sf0.001"
STREAMS = {
    "r2_stalls": lambda e, late: jobs.outcomes(jobs.drain(jobs.stalls(e, late=late), "update", ["worker"]), "from_us"),
    "r4_lease_state": lambda e, late: jobs.outcomes(jobs.drain(jobs.leases(e, late=late), "update", ["tile", "stage"]), "event_id"),
    "r5_current_state": lambda e, late: jobs.drain(jobs.current_state(e), "update", ["tile", "stage"]),
    "r8_worker_sessions": lambda e, late: jobs.outcomes(jobs.drain(jobs.worker_sessions(e, late=late), "update", ["worker"]), "start_us"),
}


@pytest.fixture(scope="module")
def shuffled(tmp_path_factory):
    """The events in eight files whose rows and order have nothing to do with time."""
    path = tmp_path_factory.mktemp("shuffled")
    events = pd.read_parquet(f"{SF}/events.parquet").sample(frac=1, random_state=3)
    for k in range(8):
        events.iloc[k::8].astype({"ts": "datetime64[us]"}).to_parquet(path / f"{k}.parquet", index=False)
        os.utime(path / f"{k}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    return str(path)


def want(name: str) -> list:
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    found = con.execute(registry.ORACLE_SQL[name]).df()
    columns = sorted(found.columns)
    return columns, sorted(map(str, found[columns].itertuples(index=False, name=None)))


@pytest.mark.parametrize("name, files", [("r8_worker_sessions", 1), *((name, files) for name in STREAMS for files in (2, 8))])
def test_shuffled_files_give_the_batch_answer(spark, shuffled, name, files):
    got = STREAMS[name](job_events(jobs.read_events(spark, shuffled, files)), "60 days")
    columns, rows = want(name)
    assert sorted(map(str, got.select(*columns).toPandas().itertuples(index=False, name=None))) == rows


def test_rows_behind_the_watermark_are_settled_and_evicted(spark, tmp_path):
    table = spark.read.parquet(f"{SF}/events.parquet")
    path = jobs.deal_files(table, str(tmp_path / "arrivals"), files=4)
    drained = jobs.drain(jobs.leases(job_events(jobs.read_events(spark, path)), late="6 hours"), "update", ["tile", "stage"])
    rows = drained.where("event_id IS NOT NULL").collect()
    settled = sum(r["settled"] for r in rows)
    assert len(rows) == 600 and settled > 0.9 * len(rows)  # only the last hours may still wait
    assert len({r["event_id"] for r in rows}) == len(rows)


def test_layers_apply_in_order_whatever_their_arrival(spark, tmp_path):
    rows = [("a", 1, 10, 5, None, 0, 1), ("a", 1, 10, 6, None, 9, 2), ("a", 2, 20, 7, 6, 0, 3), ("a", 3, 30, 8, 6, 0, 4), ("b", 1, 10, 1, 3, 0, 5)]
    for k, order in enumerate((rows, rows[::-1])):
        folder = tmp_path / str(k)
        for i, r in enumerate(order):
            spark.createDataFrame([r], "cell string, t long, layer long, state long, expect long, priority long, seq long").coalesce(1).write.parquet(f"{folder}/{i:02}")
        stream = spark.readStream.schema("cell string, t long, layer long, state long, expect long, priority long, seq long").option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")
        edits = stream.withColumns({"ts": F.timestamp_seconds("t"), "layer_end": F.timestamp_seconds("layer")})
        got = jobs.outcomes(jobs.drain(jobs.apply_edit_stream(edits, ["cell"], late="1 day"), "update", ["cell"]), "applied")
        assert sorted(map(tuple, got.collect()), key=str) == [("a", 7, 2, 1), ("b", None, 0, 1)]
