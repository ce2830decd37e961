"""Streaming jobs, drained and compared with the batch answer."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.plans.registry import query
from gridloom.sources.derived import job_events
from gridloom.streaming import jobs


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole table, dealt into parts that arrive out of order by up to six hours, one part a batch."""
    table = spark.read.parquet(f"{sf_dir}/events.parquet")
    path, files = jobs.deal(table, jobs.scratch(spark, "arrivals"), piece=jobs.PIECE)
    return job_events(jobs.read_events(spark, path, files))


@query("WITH w AS (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM f_job_events WHERE state='complete') SELECT epoch_us(s)::BIGINT AS start_us, count(*)::BIGINT AS n FROM w GROUP BY 1", "f_job_events")
def r1_publication_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jobs.drain(jobs.publication_rate(_events(spark, sf_dir)), "update", ["start"])
    return out.select(F.unix_micros("start").alias("start_us"), "n")


@query("WITH w AS (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS s FROM f_job_events WHERE state='complete') SELECT epoch_us(s)::BIGINT AS start_us, count(*)::BIGINT AS n, (count(*)>5) AS over FROM w GROUP BY 1", "f_job_events")
def r3_commit_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = jobs.drain(jobs.commit_budget(_events(spark, sf_dir), 5), "update", ["start"])
    return out.select(F.unix_micros("start").alias("start_us"), "n", "over")


@query("SELECT tile, stage, state FROM (SELECT *, row_number() OVER (PARTITION BY tile, stage ORDER BY ts DESC, event_id DESC) AS k FROM f_job_events) WHERE k=1", "f_job_events")
def r5_current_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.drain(jobs.current_state(_events(spark, sf_dir)), "update", ["tile", "stage"])


@query("WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new FROM f_job_events WINDOW w AS (PARTITION BY worker ORDER BY ts, event_id)), s AS (SELECT *, sum(new) OVER (PARTITION BY worker ORDER BY ts, event_id) AS sid FROM g) SELECT worker, epoch_us(min(ts))::BIGINT AS start_us, count(*)::BIGINT AS n, sum((state='failed')::INT)::BIGINT AS failed FROM s GROUP BY worker, sid", "f_job_events")
def r8_worker_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.outcomes(jobs.drain(jobs.worker_sessions(_events(spark, sf_dir)), "update", ["worker"]), "start_us")


@query(
    """WITH e AS (SELECT tile, stage, event_id, worker, state = 'running' AS running, epoch_us(ts) AS us, row_number() OVER (PARTITION BY tile, stage ORDER BY ts, event_id) AS k FROM f_job_events WHERE state IN ('running', 'complete')),
r(tile, stage, k, event_id, owner, expires, outcome) AS (
  SELECT tile, stage, k, event_id, CASE WHEN running THEN worker END, CASE WHEN running THEN us + 3600000000 ELSE 0 END, CASE WHEN running THEN 'claimed' ELSE 'rejected' END FROM e WHERE k = 1
  UNION ALL SELECT tile, stage, k, event_id, CASE WHEN takes THEN worker WHEN ends THEN NULL ELSE owner END, CASE WHEN takes THEN us + 3600000000 WHEN ends THEN 0 ELSE expires END,
    CASE WHEN takes AND held THEN 'renewed' WHEN takes THEN 'claimed' WHEN ends THEN 'completed' ELSE 'rejected' END
  FROM (SELECT *, running AND (NOT held OR owner = worker) AS takes, NOT running AND held AND owner = worker AS ends
        FROM (SELECT e.*, r.owner, r.expires, r.owner IS NOT NULL AND e.us < r.expires AS held FROM r JOIN e ON e.tile = r.tile AND e.stage = r.stage AND e.k = r.k + 1)))
SELECT tile, stage, event_id, outcome FROM r""",
    "f_job_events",
)
def r4_lease_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stateful fencing in event time."""
    return jobs.outcomes(jobs.drain(jobs.leases(_events(spark, sf_dir)), "update", ["tile", "stage"]), "event_id")


@query("WITH c AS (SELECT worker, epoch_us(ts) AS us, lag(epoch_us(ts)) OVER (PARTITION BY worker ORDER BY ts) AS prev FROM f_job_events WHERE state='complete') SELECT worker, prev::BIGINT AS from_us, us::BIGINT AS to_us FROM c WHERE us-prev>7200000000", "f_job_events")
def r2_stalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.outcomes(jobs.drain(jobs.stalls(_events(spark, sf_dir)), "update", ["worker"]), "from_us")


@query("SELECT DISTINCT tile, stage FROM f_job_events WHERE state='complete'", "f_job_events")
def r7_publish_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _events(spark, sf_dir).where("state = 'complete'").select("tile", "stage")
    return jobs.publish_once(done, ["tile", "stage"], jobs.scratch(spark, "published"))


@query(
    """WITH e AS (SELECT tile, stage, epoch_us(ts) // 21600000000 AS layer, worker % 4 AS new, CASE WHEN worker % 4 > 0 THEN worker % 4 - 1 WHEN event_id % 2 = 1 THEN 3 END AS expect, worker, event_id FROM f_job_events),
w AS (SELECT *, row_number() OVER (PARTITION BY tile, stage ORDER BY layer) AS k FROM (SELECT *, row_number() OVER (PARTITION BY tile, stage, layer ORDER BY worker DESC, event_id) AS j FROM e) WHERE j = 1),
r(tile, stage, k, state, applied, rejected) AS (
  SELECT DISTINCT tile, stage, 0::BIGINT, NULL::BIGINT, 0::BIGINT, 0::BIGINT FROM w
  UNION ALL SELECT w.tile, w.stage, w.k, CASE WHEN w.expect IS NOT DISTINCT FROM r.state THEN new ELSE r.state END, applied + CASE WHEN w.expect IS NOT DISTINCT FROM r.state THEN 1 ELSE 0 END, rejected + CASE WHEN w.expect IS DISTINCT FROM r.state THEN 1 ELSE 0 END
  FROM r JOIN w ON w.tile = r.tile AND w.stage = r.stage AND w.k = r.k + 1)
SELECT tile, stage, state, applied, rejected FROM r JOIN (SELECT tile, stage, max(k) AS k FROM w GROUP BY 1, 2) USING (tile, stage, k)""",
    "f_job_events",
)
def r6_edit_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edit layers of six hours: state 0 wants an empty cell, or 3 for odd events, and state s wants s - 1; the highest worker of a layer speaks for a cell."""
    state = F.col("worker") % 4
    expect = F.when(state > 0, state - 1).when(F.col("event_id") % 2 == 1, F.lit(3).cast("long"))
    end = F.timestamp_micros((F.floor(F.unix_micros("ts") / 21_600_000_000) + 1) * 21_600_000_000)
    edits = _events(spark, sf_dir).select("ts", "tile", "stage", end.alias("layer_end"), state.alias("state"), expect.alias("expect"), F.col("worker").alias("priority"), F.col("event_id").alias("seq"))
    return jobs.outcomes(jobs.drain(jobs.apply_edit_stream(edits, ["tile", "stage"]), "update", ["tile", "stage"]), "applied")


@query()
def f12_page_address(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page, centre and page-local place of every position, with the error of the way back in millimetres; a table per page is F12 and A14."""
    from gridloom.functions import atlas
    from gridloom.sources.derived import f_places

    p = f_places(spark, sf_dir).select("pid", (F.col("x_dm") / 57 - 180).alias("lon"), (F.col("z_dm") / 120 - 85).alias("lat"))
    band, column = atlas.page(F.col("lon"), F.col("lat"))
    p = p.withColumns({"band": band, "column": column}).withColumn("page", atlas.page_id(F.col("band"), F.col("column")))
    lon, lat = atlas.page_centre(F.col("band"), F.col("column"))
    p = p.withColumns({"clon": lon, "clat": lat})
    x, z = atlas.page_local(F.col("lon"), F.col("lat"), F.col("clon"), F.col("clat"))
    p = p.withColumns({"x": x, "z": z})
    blon, blat = atlas.page_geographic(F.col("x"), F.col("z"), F.col("clon"), F.col("clat"))
    p = p.withColumns({"blon": blon, "blat": blat})
    error = F.sqrt(F.pow((F.col("blat") - F.col("lat")) * 111_000_000, 2) + F.pow((F.pmod(F.col("blon") - F.col("lon") + 180, F.lit(360.0)) - 180) * 111_000_000 * F.cos(F.radians("lat")), 2))
    return p.select("pid", "page", F.round("x", 3).alias("x"), F.round("z", 3).alias("z"), F.round(error, 3).alias("error_mm"))
