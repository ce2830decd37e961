"""Job journal, publication feed and dispatch."""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import keys
from gridloom.operators import ranges
from gridloom.plans.registry import query
from gridloom.sources import derived as d

STATES = ["pending", "running", "complete", "failed"]
LAST = "SELECT tile, stage, state, ts FROM (SELECT *, row_number() OVER (PARTITION BY tile, stage ORDER BY ts DESC, event_id DESC) AS k FROM f_job_events) WHERE k=1"


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The current state of each tile and stage."""
    best = d.f_job_events(spark, sf_dir).groupBy("tile", "stage").agg(F.max(F.struct("ts", "event_id", "state")).alias("m"))
    return best.select("tile", "stage", "m.state", "m.ts")


@query(f"SELECT stage, state, count(*)::BIGINT AS n FROM ({LAST}) GROUP BY 1,2", "f_job_events")
def a12_stage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).groupBy("stage", "state").agg(F.count("*").alias("n"))


PIVOT = ", ".join(f"coalesce(max(CASE WHEN stage={k} THEN state END),'pending') AS s{k}" for k in range(4))


@query(f"SELECT tile, {PIVOT} FROM ({LAST}) GROUP BY 1", "f_job_events")
def a12_tile_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = latest(spark, sf_dir).groupBy("tile").pivot("stage", [0, 1, 2, 3]).agg(F.first("state"))
    return p.select("tile", *[F.coalesce(F.col(str(k)), F.lit("pending")).alias(f"s{k}") for k in range(4)])


@query(f"WITH p AS (SELECT tile, {PIVOT} FROM ({LAST}) GROUP BY 1) SELECT tile, CASE WHEN 'failed' IN (s0,s1,s2,s3) THEN 'failed' WHEN 'running' IN (s0,s1,s2,s3) THEN 'running' WHEN s3='complete' THEN 'verified' WHEN s2='complete' THEN 'styled' WHEN s1='complete' THEN 'generated' WHEN s0='complete' THEN 'sourced' ELSE 'queued' END AS state FROM p", "f_job_events")
def p18_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = [F.col(f"s{k}") for k in range(4)]
    done = lambda k: s[k] == "complete"
    state = F.when(F.lit("failed").isin(s), "failed").when(F.lit("running").isin(s), "running").when(done(3), "verified").when(done(2), "styled").when(done(1), "generated").when(done(0), "sourced").otherwise("queued")
    return a12_tile_pivot(spark, sf_dir).select("tile", state.alias("state"))


@query("WITH n AS (SELECT max(ts) AS now FROM f_job_events), c AS (SELECT * FROM f_job_events WHERE state='complete') SELECT sum((ts>=now-INTERVAL 1 HOUR)::INT)::BIGINT AS last_hour, sum((ts>=now-INTERVAL 24 HOUR)::INT)::BIGINT AS last_day, count(*)::BIGINT AS total, arg_max(tile, (ts, event_id)) AS last_tile FROM c, n", "f_job_events")
def a22_publication_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = d.f_job_events(spark, sf_dir)
    now = e.agg(F.max("ts").alias("now"))  # one row
    c = e.where("state = 'complete'").join(F.broadcast(now), F.lit(True))
    return c.agg(F.count_if(F.expr("ts >= now - INTERVAL 1 HOUR")).alias("last_hour"), F.count_if(F.expr("ts >= now - INTERVAL 24 HOURS")).alias("last_day"), F.count("*").alias("total"), F.max_by("tile", F.struct("ts", "event_id")).alias("last_tile"))


@query(f"SELECT sum((stage=1)::INT)::BIGINT AS plan, sum((stage=3 AND state='complete')::INT)::BIGINT AS detailed, (sum((stage=1)::INT)-sum((stage=3 AND state='complete')::INT))::BIGINT AS remaining FROM ({LAST})", "f_job_events")
def a23_plan_remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).agg(F.count_if(F.col("stage") == 1).alias("plan"), F.count_if((F.col("stage") == 3) & (F.col("state") == "complete")).alias("detailed")).withColumn("remaining", F.col("plan") - F.col("detailed"))


@query("SELECT stage, count(*)::BIGINT AS n, round(quantile_cont(centiseconds,0.5),6)::DOUBLE AS median, round(quantile_cont(centiseconds,0.9),6)::DOUBLE AS p90 FROM f_job_events GROUP BY 1", "f_job_events")
def a33_phase_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.f_job_events(spark, sf_dir).groupBy("stage").agg(F.count("*").alias("n"), F.round(F.expr("percentile(centiseconds, 0.5)"), 6).alias("median"), F.round(F.expr("percentile(centiseconds, 0.9)"), 6).alias("p90"))


@query("WITH g AS (SELECT worker, date_diff('microsecond', lag(ts) OVER (PARTITION BY worker ORDER BY ts, event_id), ts) AS gap FROM f_job_events) SELECT worker, count(gap)::BIGINT AS laps, max(gap)::BIGINT AS longest_us FROM g GROUP BY 1", "f_job_events")
def a33_worker_laps(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("worker").orderBy("ts", "event_id")
    gap = F.unix_micros(F.col("ts").cast("timestamp")) - F.lag(F.unix_micros(F.col("ts").cast("timestamp"))).over(w)
    return d.f_job_events(spark, sf_dir).select("worker", gap.alias("gap")).groupBy("worker").agg(F.count("gap").alias("laps"), F.max("gap").alias("longest_us"))


@query(f"WITH s AS (SELECT tile, stage, state, CASE WHEN stage%2=0 THEN stage END AS route FROM ({LAST}) WHERE state='pending') SELECT tile, stage, row_number() OVER (PARTITION BY stage ORDER BY route NULLS LAST, tile)::INT AS position FROM s", "f_job_events")
def w18_dispatch_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions per lane (stage): route rank with nulls last, then tile."""
    s = latest(spark, sf_dir).where("state = 'pending'").withColumn("route", F.when(F.col("stage") % 2 == 0, F.col("stage")))
    return s.select("tile", "stage", F.row_number().over(Window.partitionBy("stage").orderBy(F.asc_nulls_last("route"), "tile")).alias("position"))


@query("WITH p AS (SELECT tx, tz, seq, seq%7 AS county, CASE WHEN seq%3=0 THEN seq%11 END AS grp FROM f_tiles), g AS (SELECT *, min(seq) OVER (PARTITION BY grp) AS first FROM p) SELECT tx, tz, row_number() OVER (PARTITION BY county ORDER BY (grp IS NULL), CASE WHEN grp IS NULL THEN 0 ELSE first END, seq, tx, tz)::INT AS position, county FROM g", "f_tiles")
def w19_locality_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Within a county: tiles of shared sources together, by their group's first position; the rest afterwards."""
    p = d.f_tiles(spark, sf_dir).withColumn("county", F.col("seq") % 7).withColumn("grp", F.when(F.col("seq") % 3 == 0, F.col("seq") % 11))
    g = p.withColumn("first", F.min("seq").over(Window.partitionBy("grp")))
    order = Window.partitionBy("county").orderBy(F.col("grp").isNull(), F.when(F.col("grp").isNull(), 0).otherwise(F.col("first")), "seq", "tx", "tz")
    return g.select("tx", "tz", F.row_number().over(order).alias("position"), "county")


@query(f"WITH s AS ({LAST}), c AS (SELECT tile, stage, CASE WHEN state='failed' THEN 'pending' WHEN state='running' AND stage=2 THEN 'complete' ELSE state END AS new, state FROM s) SELECT tile, stage, new AS state, (new<>state) AS changed FROM c", "f_job_events")
def u5_journal_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requeue failures, retire running tiles of one stage with evidence; changed rows are marked."""
    new = F.when(F.col("state") == "failed", "pending").when((F.col("state") == "running") & (F.col("stage") == 2), "complete").otherwise(F.col("state"))
    return latest(spark, sf_dir).select("tile", "stage", new.alias("state"), (new != F.col("state")).alias("changed"))


@query("SELECT tx, tz, seq, ((2*tx+1)*(2*tx+1)+(2*tz+1)*(2*tz+1))::BIGINT AS dist2 FROM f_tiles ORDER BY dist2, tx, tz LIMIT 100", "f_tiles")
def t1_nearest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k report: the 100 tiles nearest to the centre."""
    return d.f_tiles(spark, sf_dir).select("tx", "tz", "seq", F.expr("(2 * tx + 1) * (2 * tx + 1) + (2 * tz + 1) * (2 * tz + 1)").alias("dist2")).orderBy("dist2", "tx", "tz").limit(100)


@query("WITH r AS (SELECT x_cm//51200 AS x, z_cm//51200 AS z, count(*) AS n FROM f_points GROUP BY 1,2), s AS (SELECT *, ntile(4) OVER (ORDER BY n, x, z) AS stratum FROM r), k AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY sha256(concat(x,'_',z))) AS k FROM s) SELECT stratum::INT AS stratum, x, z, n::BIGINT AS n FROM k WHERE k<=2", "f_points")
def t2_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two regions per density quarter, in the order of a hash."""
    r = d.f_points(spark, sf_dir).groupBy(F.floor(F.col("x_cm") / 51200).alias("x"), F.floor(F.col("z_cm") / 51200).alias("z")).agg(F.count("*").alias("n"))
    s = r.withColumn("stratum", F.ntile(4).over(Window.orderBy("n", "x", "z")))  # a row per region
    return ranges.first_by(s, ["stratum"], [F.sha2(keys.tile_id(F.col("x"), F.col("z")), 256)], 2).select("stratum", "x", "z", "n")


@query("SELECT tx, tz FROM f_tiles ORDER BY (seq%5=0) DESC, sha256(concat(tx,'_',tz,'/7')), tx, tz LIMIT 40", "f_tiles")
def t3_seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling operator: 40 tiles, preferred ones first, then by a seeded hash."""
    order = [F.desc(F.col("seq") % 5 == 0), F.sha2(F.concat(keys.tile_id(F.col("tx"), F.col("tz")), F.lit("/7")), 256), "tx", "tz"]
    return d.f_tiles(spark, sf_dir).orderBy(*order).limit(40).select("tx", "tz")


@query("WITH s AS (SELECT pid, name, kind, CASE WHEN lower(name)='customer#000000012' THEN 0 WHEN starts_with(lower(name),'customer#00000001') THEN 1 WHEN contains(lower(name),'12') THEN 3 END AS score FROM f_places) SELECT pid, name, score::INT AS score FROM s WHERE score IS NOT NULL ORDER BY score, kind, length(name), pid LIMIT 6", "f_places")
def t5_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top-k report: exact, prefix, then anywhere."""
    n = F.lower("name")
    score = F.when(n == "customer#000000012", 0).when(n.startswith("customer#00000001"), 1).when(F.contains(n, F.lit("12")), 3)
    return d.f_places(spark, sf_dir).withColumn("score", score).where("score IS NOT NULL").orderBy("score", "kind", F.length("name"), "pid").limit(6).select("pid", "name", "score")


@query("SELECT cls::INT AS cls, arg_min(src, (abs(y_dm-1825), z_cm, x_cm, src, seq)) AS src, min(abs(y_dm-1825))::BIGINT AS off FROM f_points GROUP BY 1", "f_points")
def t7_composite_argmin(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.struct(F.abs(F.col("y_dm") - 1825), "z_cm", "x_cm", "src", "seq")
    return d.f_points(spark, sf_dir).groupBy("cls").agg(F.min_by("src", key).alias("src"), F.min(F.abs(F.col("y_dm") - 1825)).alias("off"))


@query("WITH r AS (SELECT *, row_number() OVER (PARTITION BY kind, x_dm//1000, z_dm//1000 ORDER BY name, pid) AS k FROM f_places) SELECT pid, name, kind FROM r WHERE k=1", "f_places")
def w17_rank_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = d.f_places(spark, sf_dir).withColumn("bx", F.floor(F.col("x_dm") / 1000)).withColumn("bz", F.floor(F.col("z_dm") / 1000))
    return ranges.first_by(p, ["kind", "bx", "bz"], [F.col("name"), F.col("pid")]).select("pid", "name", "kind")


@query("WITH k AS (SELECT stage, count(*) AS n, sum((state='complete')::INT) AS c FROM f_job_events GROUP BY 1) SELECT stage, c::BIGINT AS complete, n::BIGINT AS n, round(c*1.0/n + 1.96*1.96/(2.0*n), 9)::DOUBLE AS centre_term, round((c*1.0/n + 3.8416/(2.0*n) - 1.96*sqrt(c*1.0/n*(1-c*1.0/n)/n + 3.8416/(4.0*n*n)))/(1+3.8416/n), 9)::DOUBLE AS low, round((c*1.0/n + 3.8416/(2.0*n) + 1.96*sqrt(c*1.0/n*(1-c*1.0/n)/n + 3.8416/(4.0*n*n)))/(1+3.8416/n), 9)::DOUBLE AS high FROM k", "f_job_events")
def a21_wilson_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = d.f_job_events(spark, sf_dir).groupBy("stage").agg(F.count_if(F.col("state") == "complete").alias("complete"), F.count("*").alias("n"))
    n, p, z2 = F.col("n").cast("double"), F.col("complete") / F.col("n"), 1.96 * 1.96
    half = 1.96 * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))
    return k.select("stage", "complete", "n", F.round(p + z2 / (2 * n), 9).alias("centre_term"), F.round((p + z2 / (2 * n) - half) / (1 + z2 / n), 9).alias("low"), F.round((p + z2 / (2 * n) + half) / (1 + z2 / n), 9).alias("high"))


@query("SELECT pid, name FROM f_places WHERE x_dm BETWEEN 2000 AND 18000 AND z_dm BETWEEN 2000 AND 18000 AND contains(name,'1') ORDER BY name, pid LIMIT 25 OFFSET 25", "f_places")
def p25_cell_browse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of a filtered list."""
    p = d.f_places(spark, sf_dir).where("x_dm BETWEEN 2000 AND 18000 AND z_dm BETWEEN 2000 AND 18000 AND contains(name, '1')")
    return p.orderBy("name", "pid").offset(25).limit(25).select("pid", "name")
