"""Merges, verification, set operations and content digests."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import merges, rasters
from gridloom.plans.registry import query
from gridloom.sources import derived as d

BLOCKS = "SELECT x_cm//800 AS x, z_cm//800 AS z, y_dm//10 AS y, max(cls) AS state FROM f_points WHERE strip<4 GROUP BY 1,2,3"
EDITS = "SELECT x, z, y, state, expect, src, seq FROM (SELECT x_cm//800 AS x, z_cm//800 AS z, y_dm//10 AS y, CASE WHEN src%3=0 THEN 20 ELSE 21 END AS state, CASE WHEN src%2=0 THEN cls END AS expect, src, seq, row_number() OVER (PARTITION BY x_cm//800, z_cm//800, y_dm//10 ORDER BY src%3 DESC, src, seq) AS k FROM f_points WHERE strip>=4) WHERE k=1"


def _cell(points: DataFrame) -> DataFrame:
    return points.withColumns({"x": F.floor(F.col("x_cm") / 800), "z": F.floor(F.col("z_cm") / 800), "y": F.floor(F.col("y_dm") / 10)})


def blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cell(d.f_points(spark, sf_dir)).where("strip < 4").groupBy("x", "z", "y").agg(F.max("cls").alias("state"))


def edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _cell(d.f_points(spark, sf_dir)).where("strip >= 4").select("x", "z", "y", F.when(F.col("src") % 3 == 0, 20).otherwise(21).alias("state"), F.when(F.col("src") % 2 == 0, F.col("cls")).alias("expect"), (F.col("src") % 3).alias("priority"), F.struct("src", "seq").alias("order"))
    return rasters.resolve(e, ["x", "z", "y"], "priority", "order").select("x", "z", "y", "state", "expect", F.col("order.src").alias("src"), F.col("order.seq").alias("seq"))


@query(
    f"""WITH b AS ({BLOCKS}), e AS ({EDITS})
SELECT e.x::BIGINT AS x, e.z::BIGINT AS z, e.y::BIGINT AS y, e.state::INT AS state, CASE WHEN b.state IS NOT DISTINCT FROM e.state THEN 'unchanged' WHEN b.state IS NOT DISTINCT FROM e.expect THEN 'applied' ELSE 'precondition_failed' END AS outcome FROM e LEFT JOIN b ON e.x=b.x AND e.z=b.z AND e.y=b.y""",
    "f_points",
)
def j24_precondition_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, judged = merges.apply_edits(blocks(spark, sf_dir), edits(spark, sf_dir), ["x", "z", "y"])
    return judged.select("x", "z", "y", "state", "outcome")


@query(
    f"""WITH b AS ({BLOCKS}), e AS ({EDITS}), o AS (SELECT e.src%4 AS kind, CASE WHEN b.state IS NOT DISTINCT FROM e.state THEN 'unchanged' WHEN b.state IS NOT DISTINCT FROM e.expect THEN 'applied' ELSE 'precondition_failed' END AS outcome FROM e LEFT JOIN b ON e.x=b.x AND e.z=b.z AND e.y=b.y)
SELECT kind::BIGINT AS kind, sum((outcome='applied')::INT)::BIGINT AS applied, sum((outcome='precondition_failed')::INT)::BIGINT AS failed, count(*)::BIGINT AS total FROM o GROUP BY ROLLUP (kind)""",
    "f_points",
)
def a18_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes by kind, with a total row (null kind)."""
    _, judged = merges.apply_edits(blocks(spark, sf_dir), edits(spark, sf_dir), ["x", "z", "y"])
    return judged.rollup((F.col("src") % 4).alias("kind")).agg(F.count_if(F.col("outcome") == "applied").alias("applied"), F.count_if(F.col("outcome") == "precondition_failed").alias("failed"), F.count("*").alias("total"))


@query(f"WITH b AS ({BLOCKS}), e AS ({EDITS}) SELECT x::BIGINT AS x, z::BIGINT AS z, y::BIGINT AS y, state::INT AS state FROM b UNION ALL SELECT e.x::BIGINT, e.z::BIGINT, e.y::BIGINT, e.state::INT FROM e WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.x=e.x AND b.z=e.z AND b.y=e.y)", "f_points")
def j25_insert_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merges.insert_missing(blocks(spark, sf_dir), edits(spark, sf_dir).select("x", "z", "y", "state"), ["x", "z", "y"])


@query(
    """WITH c AS (SELECT o_orderkey AS k, o_custkey%5 AS h FROM orders WHERE o_orderkey%4<>0), n AS (SELECT o_orderkey AS k, o_custkey%5 AS h0, o_orderkey%5 AS nh FROM orders WHERE o_orderkey%3<>0)
SELECT coalesce(c.k,n.k) AS k, CASE WHEN n.k IS NULL THEN 'keep' WHEN c.k IS NULL THEN 'add' WHEN h=nh THEN 'same' WHEN h IN (n.k%2, 3) THEN 'upgrade' ELSE 'conflict' END AS decision FROM c FULL JOIN n ON c.k=n.k"""
)
def j26_quality_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("k"), (F.col("o_custkey") % 5).alias("hash"))
    current = o.where("k % 4 <> 0")
    incoming = o.where("k % 3 <> 0").select("k", (F.col("k") % 5).alias("new_hash"), F.array(F.col("k") % 2, F.lit(3).cast("long")).alias("baselines"))
    return merges.quality_merge(current, incoming, "k").select("k", "decision")


@query(f"WITH b AS ({BLOCKS}), e AS ({EDITS}), air AS (SELECT x, z, bool_and(state<>6) AS free FROM b GROUP BY 1,2) SELECT DISTINCT e.x::BIGINT AS x, e.z::BIGINT AS z FROM e JOIN air ON e.x=air.x AND e.z=air.z AND air.free WHERE NOT EXISTS (SELECT 1 FROM f_footprints f WHERE f.x0//8=e.x AND f.z0//8=e.z)", "f_points f_footprints")
def j27_protected_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns to fill: wanted by an edit, free of buildings, and outside what others own."""
    free = blocks(spark, sf_dir).groupBy("x", "z").agg(F.bool_and(F.col("state") != 6).alias("free")).where("free")
    owned = d.f_footprints(spark, sf_dir).select(F.floor(F.col("x0") / 8).alias("x"), F.floor(F.col("z0") / 8).alias("z"))
    return edits(spark, sf_dir).select("x", "z").distinct().join(free, ["x", "z"], "left_semi").join(owned, ["x", "z"], "left_anti")


LISTED = "SELECT path, bytes, sha256(text) AS sha FROM f_manifest"
FOUND = "SELECT path, bytes + CASE WHEN bytes%11=0 THEN 1 ELSE 0 END AS bytes, CASE WHEN bytes%13=0 THEN sha256(concat(text,'x')) ELSE sha256(text) END AS sha FROM f_manifest WHERE bytes%17<>0"


def _listings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    m = d.f_manifest(spark, sf_dir)
    listed = m.select("path", "bytes", F.sha2("text", 256).alias("sha256"))
    found = m.where("bytes % 17 <> 0").select("path", (F.col("bytes") + F.when(F.col("bytes") % 11 == 0, 1).otherwise(0)).alias("bytes"), F.when(F.col("bytes") % 13 == 0, F.sha2(F.concat("text", F.lit("x")), 256)).otherwise(F.sha2("text", 256)).alias("sha256"))
    return listed, found


@query(f"WITH l AS ({LISTED}), r AS ({FOUND}) SELECT l.path, CASE WHEN r.path IS NULL THEN 'missing' WHEN r.bytes<>l.bytes THEN 'size_mismatch' WHEN r.sha<>l.sha THEN 'hash_mismatch' ELSE 'ok' END AS status FROM l LEFT JOIN r ON l.path=r.path", "f_manifest")
def j28_manifest_verification(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed, found = _listings(spark, sf_dir)
    return merges.verify_manifest(listed, found).select("path", "status")


@query(f"WITH l AS ({LISTED}), r AS ({FOUND}) SELECT coalesce(l.path,r.path) AS path, CASE WHEN r.sha IS NULL THEN 'first_only' WHEN l.sha IS NULL THEN 'second_only' ELSE 'changed' END AS kind FROM l FULL JOIN r ON l.path=r.path WHERE l.sha IS DISTINCT FROM r.sha", "f_manifest")
def j29_world_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed, found = _listings(spark, sf_dir)
    return merges.differences(listed, found, "path", "sha256").select("path", "kind")


@query("WITH p AS (SELECT x_cm//51200 AS tx, z_cm//51200 AS tz, strip FROM f_points GROUP BY 1,2,3), c AS (SELECT tx, tz, count(*) AS n FROM p GROUP BY 1,2), e AS (SELECT tx, tz FROM (SELECT unnest(range(0,6)) AS tx), (SELECT unnest(range(0,6)) AS tz)) SELECT coalesce(c.tx,e.tx)::BIGINT AS tx, coalesce(c.tz,e.tz)::BIGINT AS tz, coalesce(n,0)::BIGINT AS owners, (e.tx IS NOT NULL) AS expected FROM c FULL JOIN e ON c.tx=e.tx AND c.tz=e.tz WHERE coalesce(n,0)<>1 OR e.tx IS NULL", "f_points")
def j34_exactly_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles that are not owned exactly once by the strips."""
    parts = d.f_points(spark, sf_dir).select(F.floor(F.col("x_cm") / 51200).alias("tx"), F.floor(F.col("z_cm") / 51200).alias("tz"), "strip").distinct()
    axis = lambda n: spark.range(6).withColumnRenamed("id", n)  # noqa: E731  the expected grid: 6 x 6 tiles
    return merges.ownership_faults(parts, axis("tx").join(axis("tz"), F.lit(True)), ["tx", "tz"])


@query(
    f"""WITH b AS ({BLOCKS}), e AS (SELECT DISTINCT x_cm//800 AS x, z_cm//800 AS z, y_dm//10 AS y FROM f_points WHERE strip>=2)
SELECT CASE WHEN b.x IS NULL THEN 'missing' WHEN e.x IS NULL THEN 'extra' ELSE 'equal' END AS kind, count(*)::BIGINT AS n FROM b FULL JOIN e ON b.x=e.x AND b.z=e.z AND b.y=e.y GROUP BY 1""",
    "f_points",
)
def j35_occupancy_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = blocks(spark, sf_dir).withColumn("a", F.lit(1)).drop("state")
    e = _cell(d.f_points(spark, sf_dir)).where("strip >= 2").select("x", "z", "y", F.lit(1).alias("e")).distinct()
    kind = F.when(F.col("a").isNull(), "missing").when(F.col("e").isNull(), "extra").otherwise("equal")
    return a.join(e, ["x", "z", "y"], "full_outer").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("WITH r AS (SELECT x_cm//800 AS x, z_cm//800 AS z, src, seq, cls, row_number() OVER (PARTITION BY x_cm//800, z_cm//800 ORDER BY cls DESC, src, seq) AS k, count(*) OVER (PARTITION BY x_cm//800, z_cm//800) AS n FROM f_points) SELECT x, z, src, seq::INT AS seq, cls::INT AS cls, (n-1)::BIGINT AS rejected FROM r WHERE k=1", "f_points")
def w15_priority_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = d.f_points(spark, sf_dir).select(F.floor(F.col("x_cm") / 800).alias("x"), F.floor(F.col("z_cm") / 800).alias("z"), "cls", F.struct("src", "seq").alias("order"))
    return rasters.resolve(e, ["x", "z"], "cls", "order").select("x", "z", "order.src", "order.seq", "cls", "rejected")


@query("SELECT x_cm//51200 AS tx, z_cm//51200 AS tz, sha256(string_agg(concat(x_cm,'|',z_cm,'|',y_dm,'|',cls,'|',src,'|',seq), chr(10) ORDER BY concat(x_cm,'|',z_cm,'|',y_dm,'|',cls,'|',src,'|',seq))) AS digest, count(*)::BIGINT AS rows FROM f_points WHERE cls=6 GROUP BY 1,2", "f_points")
def a17_content_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hash per tile that depends on content alone, not on order or packing."""
    p = d.f_points(spark, sf_dir).where("cls = 6").withColumn("tx", F.floor(F.col("x_cm") / 51200)).withColumn("tz", F.floor(F.col("z_cm") / 51200))
    return merges.digest(p, ["tx", "tz"], [F.col(c) for c in ("x_cm", "z_cm", "y_dm", "cls", "src", "seq")])


@query("SELECT path, bytes, sha256(text) AS sha256 FROM f_manifest", "f_manifest")
def s17_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.f_manifest(spark, sf_dir).select("path", "bytes", F.sha2("text", 256).alias("sha256"))


@query(
    """WITH r AS (SELECT bytes%50 AS request, path, bytes, text FROM f_manifest)
SELECT request, count(*)::BIGINT AS files, sum(bytes)::BIGINT AS total, sum((bytes>5000)::INT)::BIGINT AS large, (bool_and(path LIKE 'd/%') AND sum(bytes)<=100000) AS passed FROM r GROUP BY 1""",
    "f_manifest",
)
def a19_contribution_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = d.f_manifest(spark, sf_dir).withColumn("request", F.col("bytes") % 50)
    return m.groupBy("request").agg(F.count("*").alias("files"), F.sum("bytes").alias("total"), F.count_if(F.col("bytes") > 5000).alias("large"), (F.bool_and(F.col("path").like("d/%")) & (F.sum("bytes") <= 100000)).alias("passed"))


@query("SELECT DISTINCT x, z FROM (SELECT x_cm//25600 AS x, z_cm//25600 AS z FROM f_points WHERE cls=9 UNION ALL SELECT x0//256, z0//256 FROM f_footprints UNION ALL SELECT tx, tz FROM f_tiles)", "f_points f_footprints f_tiles")
def u2_union_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = d.f_points(spark, sf_dir).where("cls = 9").select(F.floor(F.col("x_cm") / 25600).alias("x"), F.floor(F.col("z_cm") / 25600).alias("z"))
    b = d.f_footprints(spark, sf_dir).select(F.floor(F.col("x0") / 256).alias("x"), F.floor(F.col("z0") / 256).alias("z"))
    return a.unionByName(b).unionByName(d.f_tiles(spark, sf_dir).select(F.col("tx").alias("x"), F.col("tz").alias("z"))).distinct()


@query("SELECT x_cm//800 AS x, z_cm//800 AS z FROM f_points WHERE strip<4 INTERSECT SELECT x_cm//800, z_cm//800 FROM f_points WHERE strip>=4", "f_points")
def u3_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cell(d.f_points(spark, sf_dir))
    return c.where("strip < 4").select("x", "z").intersect(c.where("strip >= 4").select("x", "z"))


@query("SELECT x_cm//800 AS x, z_cm//800 AS z FROM f_points WHERE strip<4 EXCEPT SELECT x_cm//800, z_cm//800 FROM f_points WHERE strip>=4", "f_points")
def u4_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _cell(d.f_points(spark, sf_dir))
    return c.where("strip < 4").select("x", "z").subtract(c.where("strip >= 4").select("x", "z"))


@query("SELECT count(DISTINCT (x_cm//25600)*1000+z_cm//25600)::BIGINT AS cells, round(count(DISTINCT (x_cm//25600)*1000+z_cm//25600)*65536/1000000.0, 6)::DOUBLE AS km2 FROM f_points", "f_points")
def a13_coverage_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.count_distinct(F.floor(F.col("x_cm") / 25600), F.floor(F.col("z_cm") / 25600))
    return d.f_points(spark, sf_dir).agg(n.alias("cells"), F.round(n * 65536 / 1000000.0, 6).alias("km2"))


@query("SELECT min(tx*512)::BIGINT AS west, max((tx+1)*512)::BIGINT AS east, min(tz*512)::BIGINT AS north, max((tz+1)*512)::BIGINT AS south, greatest(max((tx+1)*512)-min(tx*512), max((tz+1)*512)-min(tz*512))::BIGINT AS size FROM f_tiles", "f_tiles")
def a15_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, z = F.col("tx") * 512, F.col("tz") * 512
    e = d.f_tiles(spark, sf_dir).agg(F.min(x).alias("west"), F.max(x + 512).alias("east"), F.min(z).alias("north"), F.max(z + 512).alias("south"))
    return e.withColumn("size", F.expr("greatest(east - west, south - north)"))


@query("SELECT tz//16 AS page, tz%8 AS row, bit_or(CAST(1 AS BIGINT) << (tx+16)::INT)::BIGINT AS bits, count(*)::BIGINT AS tiles FROM (SELECT tx, tz+16 AS tz FROM f_tiles) GROUP BY 1,2", "f_tiles")
def a16_bitmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occupancy as bits, the least significant first."""
    t = d.f_tiles(spark, sf_dir).withColumn("tz", F.col("tz") + 16)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("tx") + 16).cast("int"))
    return t.groupBy(F.floor(F.col("tz") / 16).alias("page"), (F.col("tz") % 8).alias("row")).agg(F.bit_or(bit).alias("bits"), F.count("*").alias("tiles"))


@query("SELECT l_suppkey AS asset, count(DISTINCT l_partkey)::BIGINT AS members, sum(l_orderkey)::BIGINT AS bytes, max(l_orderkey)::BIGINT AS largest, sum((l_linenumber>5)::INT)::BIGINT AS partial FROM lineitem GROUP BY 1")
def a30_source_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy(F.col("l_suppkey").alias("asset")).agg(F.count_distinct("l_partkey").alias("members"), F.sum("l_orderkey").alias("bytes"), F.max("l_orderkey").alias("largest"), F.count_if(F.col("l_linenumber") > 5).alias("partial"))


@query("WITH s AS (SELECT p_brand AS id, count(DISTINCT p_size%3)::BIGINT AS variants, min(p_type) AS url FROM part WHERE p_size%5=0 GROUP BY 1) SELECT p.p_partkey AS survey, CASE WHEN s.id IS NULL THEN 'none' WHEN variants>1 THEN 'conflict' ELSE 'attached' END AS status, CASE WHEN variants=1 THEN url END AS url FROM part p LEFT JOIN s ON p.p_brand=s.id")
def j8_asset_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates must agree; the least url of an agreeing set is attached, a conflict is a row that says so."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    s = part.where("p_size % 5 = 0").groupBy(F.col("p_brand").alias("id")).agg(F.count_distinct(F.col("p_size") % 3).alias("variants"), F.min("p_type").alias("u"))
    met = part.join(s, part.p_brand == s.id, "left")
    return met.select(F.col("p_partkey").alias("survey"), F.when(F.col("id").isNull(), "none").when(F.col("variants") > 1, "conflict").otherwise("attached").alias("status"), F.when(F.col("variants") == 1, F.col("u")).alias("url"))
