"""Scalar functions and rule cascades over the derived tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions import attributes, frame, keys, times
from gridloom.operators import rasters
from gridloom.plans.registry import query
from gridloom.sources import derived as d


@query("SELECT fid, TRY_CAST(nullif(regexp_extract(height_tag, '^\\s*(\\d+(\\.\\d+)?)\\s*(m)?\\s*$', 1),'') AS DOUBLE) AS height FROM f_footprints", "f_footprints")
def f1_metre_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.f_footprints(spark, sf_dir).select("fid", attributes.metres(F.col("height_tag")).alias("height"))


@query("SELECT pix, round(116*CASE WHEN y>0.008856 THEN cbrt(y) ELSE 7.787*y+16.0/116 END-16, 4)::DOUBLE AS l FROM (SELECT pix, (0.2126*CASE WHEN r>0.04045 THEN pow((r+0.055)/1.055,2.4) ELSE r/12.92 END+0.7152*CASE WHEN g>0.04045 THEN pow((g+0.055)/1.055,2.4) ELSE g/12.92 END+0.0722*CASE WHEN b>0.04045 THEN pow((b+0.055)/1.055,2.4) ELSE b/12.92 END)/1.0 AS y FROM (SELECT pix, red/255.0 AS r, green/255.0 AS g, blue/255.0 AS b FROM f_bands))", "f_bands")
def f3_lightness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.f_bands(spark, sf_dir).select("pix", F.round(attributes.lab(F.col("red"), F.col("green"), F.col("blue"))[0], 4).alias("l"))


@query("SELECT path, (('0x' || sha256(path)[1:8])::BIGINT % 16)::BIGINT AS choice FROM f_manifest", "f_manifest")
def f5_stable_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.f_manifest(spark, sf_dir).select("path", attributes.stable_choice(F.col("path"), 16).alias("choice"))


@query("SELECT p_partkey AS id, concat(p_type,'[brand=',p_brand,',size=',p_size,']') AS key, p_type AS name, CAST(p_size AS VARCHAR) AS size FROM part")
def f6_state_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A canonical key from a map, and back."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    key = attributes.state_key(F.col("p_type"), F.create_map(F.lit("size"), F.col("p_size").cast("string"), F.lit("brand"), F.col("p_brand")))
    rows = part.select(F.col("p_partkey").alias("id"), key.alias("key"))
    name, properties = attributes.parse_state(F.col("key"))
    return rows.select("id", "key", name.alias("name"), F.element_at(properties, "size").alias("size"))


@query("SELECT DISTINCT tile, CAST(split_part(tile,'_',1) AS BIGINT) AS tx, CAST(split_part(tile,'_',2) AS BIGINT) AS tz, ((CAST(split_part(tile,'_',2) AS BIGINT)+1000)//4 % 5)::BIGINT AS shard FROM f_job_events", "f_job_events")
def f11_tile_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = d.f_job_events(spark, sf_dir).select("tile").distinct().withColumn("tx", keys.tile_x(F.col("tile"))).withColumn("tz", keys.tile_z(F.col("tile")))
    return t.withColumn("shard", keys.shard(F.col("tz"), 5))


@query("SELECT pix, round((red*256+green+blue/256.0-32768),6)::DOUBLE AS height FROM f_bands", "f_bands")
def f14_terrain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.f_bands(spark, sf_dir).select("pix", F.round(keys.terrain_height(F.col("red"), F.col("green"), F.col("blue")), 6).alias("height"))


@query("SELECT o_orderkey AS id, (o_custkey%16)::BIGINT AS v0, ((o_custkey//16)%16)::BIGINT AS v1, ((o_custkey//256)%16)::BIGINT AS v2 FROM orders")
def f17_bit_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"), keys.unpack_bits(F.array("o_custkey"), 4, 3).alias("v"))
    return o.select("id", *[F.col("v")[k].alias(f"v{k}") for k in range(3)])


@query("SELECT cid, captured AS first_day, least(date_diff('day', DATE '1997-07-01', captured), 99999)::INT AS gap_from_start, greatest(abs(date_diff('day', captured, DATE '1997-07-01')), abs(date_diff('day', captured, DATE '1997-07-31')))::INT AS max_gap, (captured BETWEEN DATE '1997-07-01' AND DATE '1997-07-31') AS overlaps FROM f_captures", "f_captures")
def f10_capture_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates against the interval of a month given as text."""
    start, end = times.interval(F.lit("1997-07"))
    day = F.col("captured")
    return d.f_captures(spark, sf_dir).select("cid", day.alias("first_day"), F.datediff(day, start).alias("gap_from_start"), times.max_gap(day, day, start, end).alias("max_gap"), day.between(start, end).alias("overlaps"))


@query("WITH n AS (SELECT max(ts) AS now FROM f_job_events), l AS (SELECT worker, max(ts) AS seen FROM f_job_events GROUP BY 1) SELECT worker, CASE WHEN date_diff('second', seen, now) < -300 THEN 'unknown' WHEN date_diff('second', seen, now) > 5400 THEN 'stale' ELSE 'recent' END AS state FROM l, n", "f_job_events")
def f18_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = d.f_job_events(spark, sf_dir)
    now = e.agg(F.max("ts").alias("now"))  # one row
    return e.groupBy("worker").agg(F.max("ts").alias("at")).join(F.broadcast(now), F.lit(True)).select("worker", times.freshness(F.col("at"), F.col("now")).alias("state"))


@query("SELECT p_partkey AS id, (p_type IN ('ECONOMY','PROMO')) AS building, CASE WHEN p_type='ECONOMY' AND p_size<20 THEN 'house' WHEN p_type IN ('PROMO','STANDARD') THEN 'shop' WHEN p_size>30 THEN 'large' END AS kind FROM part")
def p6_p7_tag_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null-safe tag predicate and ordered first-match rules."""
    part = spark.read.parquet(f"{sf_dir}/part.parquet")
    tags = F.map_from_arrays(F.array(F.lit("building")), F.array(F.when(F.col("p_type").isin("ECONOMY", "PROMO"), "yes").otherwise("no")))
    kind = attributes.first_match([("house", (F.col("p_type") == "ECONOMY") & (F.col("p_size") < 20)), ("shop", F.col("p_type").isin("PROMO", "STANDARD")), ("large", F.col("p_size") > 30)])
    return part.select(F.col("p_partkey").alias("id"), attributes.tagged(tags, "building", "building:part").alias("building"), kind.alias("kind"))


@query("SELECT fid, CASE WHEN height_tag IS NOT NULL THEN CAST(replace(height_tag,' m','') AS DOUBLE) WHEN w<=20 THEN w*3.0 ELSE 6.0 END::DOUBLE AS height, (height_tag IS NULL) AS estimated FROM f_footprints", "f_footprints")
def p8_presentation_estimates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A missing height from the storeys (here: the width), else a default; the original is marked."""
    h = attributes.metres(F.col("height_tag"))
    guess = F.when(F.col("w") <= 20, F.col("w") * 3.0).otherwise(6.0)
    return d.f_footprints(spark, sf_dir).select("fid", F.coalesce(h, guess).alias("height"), h.isNull().alias("estimated"))


@query("SELECT pix, CASE WHEN nir+red>0 THEN round((nir-red)*1.0/(nir+red),9) END::DOUBLE AS ndvi, (greatest(red,green,blue)<45) AS shadow, coalesce((nir-red)*1.0/nullif(nir+red,0)>0.3,false) AS vegetation FROM f_bands", "f_bands")
def p11_spectral_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = rasters.ndvi(F.col("red"), F.col("nir"))
    return d.f_bands(spark, sf_dir).select("pix", F.round(n, 9).alias("ndvi"), (F.greatest("red", "green", "blue") < 45).alias("shadow"), F.coalesce(n > 0.3, F.lit(False)).alias("vegetation"))


@query("SELECT pid, x_dm//160 AS cx, z_dm//160 AS cz, (x_dm//10)//512 AS rx, ((x_dm//160)%32+((z_dm//160)%32)*32)::BIGINT AS slot FROM f_places", "f_places")
def p3_grid_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, z = F.floor(F.col("x_dm") / 10), F.floor(F.col("z_dm") / 10)
    return d.f_places(spark, sf_dir).select("pid", keys.chunk(x).alias("cx"), keys.chunk(z).alias("cz"), keys.region(x).alias("rx"), keys.chunk_slot(keys.chunk(x), keys.chunk(z)).alias("slot"))


@query("SELECT pid, true AS within_1mm FROM f_places", "f_places")
def p1_p2_frame_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """World frame to geographic and back, for every place: within a millimetre."""
    x, z = F.col("x_dm") / 10, F.col("z_dm") / 10
    lon, lat = frame.to_geographic(x, z)
    bx, bz = frame.to_block(F.col("lon"), F.col("lat"))
    p = d.f_places(spark, sf_dir).withColumns({"lon": lon, "lat": lat})
    return p.select("pid", ((F.abs(bx - x) < 0.001) & (F.abs(bz - z) < 0.001)).alias("within_1mm"))


@query("SELECT path, CASE WHEN regexp_matches(path,'^d/[0-9]*0$') THEN 'manifest' WHEN regexp_matches(path,'^d/[0-9]+$') THEN 'tile' ELSE 'rejected' END AS kind, CAST(regexp_extract(path,'([0-9]+)$',1) AS BIGINT) AS id FROM f_manifest", "f_manifest")
def p21_path_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("path")
    kind = F.when(p.rlike("^d/[0-9]*0$"), "manifest").when(p.rlike("^d/[0-9]+$"), "tile").otherwise("rejected")
    return d.f_manifest(spark, sf_dir).select("path", kind.alias("kind"), F.regexp_extract(p, "([0-9]+)$", 1).cast("long").alias("id"))


@query("SELECT event_id, array_to_string([CASE WHEN value<0 THEN 'negative' END, CASE WHEN value>200 THEN 'too_large' END, CASE WHEN event_type='error' THEN 'error_type' END], ',') AS errors FROM events WHERE value<0 OR value>200 OR event_type='error'")
def p20_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that break a rule, with the rules they break."""
    v = F.col("value")
    errors = F.array_compact(F.array(F.when(v < 0, "negative"), F.when(v > 200, "too_large"), F.when(F.col("event_type") == "error", "error_type")))
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", F.array_join(errors, ",").alias("errors")).where("errors <> ''")
