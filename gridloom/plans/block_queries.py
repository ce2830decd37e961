"""Region files of blocks made from the point table: chunks, sections and block rows read back by the table functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.plans.registry import query
from gridloom.sources import blocks, file_ranges
from gridloom.sources import derived as d
from gridloom.streaming.jobs import scratch

_STATE = {2: "minecraft:grass_block", 6: "minecraft:bricks", 1: "minecraft:stone", 5: "minecraft:oak_leaves[distance=1,persistent=true]", 9: "minecraft:water[level=0]", 11: "minecraft:gray_concrete"}
_BLOCKS = "SELECT x_cm//100 - 1024 AS x, y_dm//8 - 240 AS y, z_cm//100 - 1024 AS z, CASE max(cls) " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _STATE.items()) + " END AS state FROM f_points GROUP BY 1, 2, 3"


def block_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """x, y, z, state: the highest class in each cell; cells lie on both sides of zero and in several sections."""
    names = F.create_map(*[F.lit(x) for pair in _STATE.items() for x in pair])
    cells = d.f_points(spark, sf_dir).groupBy((F.floor(F.col("x_cm") / 100) - 1024).alias("x"), (F.floor(F.col("y_dm") / 8) - 240).alias("y"), (F.floor(F.col("z_cm") / 100) - 1024).alias("z")).agg(F.max("cls").alias("cls"))
    return cells.select("x", "y", "z", names[F.col("cls")].alias("state"))


_HARM = "CASE (cx * 31 + cz) % 61 WHEN 7 THEN 'truncated' WHEN 8 THEN 'compression' WHEN 9 THEN 'place' END"


def regions(spark: SparkSession, sf_dir: str, harm: bool = False) -> DataFrame:
    return blocks.write_regions(block_table(spark, sf_dir), scratch(spark, "regions"), damage=F.expr(_HARM) if harm else None)


@query(f"SELECT x, y, z, state FROM ({_BLOCKS})", "f_points")
def s12_block_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block of the region files, decoded: the blocks that were written."""
    return blocks.block_rows(blocks.section_rows(regions(spark, sf_dir))).where("error IS NULL").drop("error")


@query(
    f"""WITH b AS ({_BLOCKS}), s AS (SELECT x >> 4 AS cx, z >> 4 AS cz, y >> 4 AS section, count(DISTINCT state) AS states, count(*) AS blocks FROM b GROUP BY 1, 2, 3),
p AS (SELECT *, states + CASE WHEN blocks < 4096 THEN 1 ELSE 0 END AS entries FROM s), q AS (SELECT *, greatest(4, len(ltrim(bin(greatest(entries, 2) - 1), '0')))::INT AS bits FROM p)
SELECT cx, cz, section::INT AS section, (cx & 31) + (cz & 31) * 32 AS slot, entries::INT AS entries, bits, CASE WHEN entries > 1 THEN ceil(4096.0 / (64 // bits))::INT END AS words FROM q""",
    "f_points",
)
def s12_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Palette sizes, index widths and word counts per section."""
    s = blocks.section_rows(regions(spark, sf_dir))
    return s.select(F.col("cx").cast("long").alias("cx"), F.col("cz").cast("long").alias("cz"), "section", F.col("slot").cast("long").alias("slot"), F.size("palette").alias("entries"), "bits", F.when(F.col("words").isNotNull(), F.size("words")).alias("words"))


@query(
    f"""WITH b AS ({_BLOCKS}), c AS (SELECT DISTINCT x >> 4 AS cx, z >> 4 AS cz, y >> 4 AS section FROM b), h AS (SELECT *, {_HARM} AS harm FROM c)
SELECT cx >> 5 AS rx, cz >> 5 AS rz, (cx & 31) + (cz & 31) * 32 AS slot, CASE harm WHEN 'truncated' THEN 'broken_payload' WHEN 'compression' THEN 'unknown_compression' WHEN 'place' THEN 'misplaced' ELSE 'sound' END AS outcome,
count(CASE WHEN harm IS NULL OR harm = 'place' THEN 1 END) AS sections FROM h GROUP BY ALL""",
    "f_points",
)
def x3_chunk_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region -> chunks -> sections in SQL with LATERAL, over files with planted faults: what became of each chunk."""
    blocks.register(spark)
    regions(spark, sf_dir, harm=True).createOrReplaceTempView("gridloom_regions")
    s = spark.sql(
        """SELECT rx, rz, CAST(slot AS BIGINT) AS slot, coalesce(c.error, s.error,
             CASE WHEN s.cx & 31 <> slot % 32 OR s.cz & 31 <> slot DIV 32 THEN 'misplaced' ELSE 'sound' END) AS outcome, s.section
           FROM gridloom_regions, LATERAL region_chunks(content) AS c CROSS JOIN LATERAL chunk_sections(c.payload, c.compression) AS s"""
    )
    return s.groupBy("rx", "rz", "slot", "outcome").agg(F.count("section").alias("sections"))


@query(
    f"""WITH b AS ({_BLOCKS}), c AS (SELECT DISTINCT x >> 4 AS cx, z >> 4 AS cz FROM b)
SELECT concat('r.', cx >> 5, '.', cz >> 5, '.mca') AS file, count(*) AS chunks, sum((cx & 31) + (cz & 31) * 32 + 1)::BIGINT AS stamps, min((cx & 31) + (cz & 31) * 32)::INT AS first_slot, 2 AS compression, 0::BIGINT AS faults FROM c GROUP BY 1""",
    "f_points",
)
def s11_region_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk listing of region files by their headers: slots, time stamps, compression, faults."""
    path = scratch(spark, "mca")
    named = regions(spark, sf_dir).select(F.concat(F.lit("r."), "rx", F.lit("."), "rz", F.lit(".mca")).alias("name"), "content")
    file_ranges.write_files(named, path).write.format("noop").mode("overwrite").save()
    file_ranges.register(spark)
    h = spark.read.format("gridloom_region_headers").option("path", path).load()
    return h.groupBy(F.element_at(F.split("file", "/"), -1).alias("file")).agg(F.count("slot").alias("chunks"), F.sum(F.col("stamp").cast("long")).alias("stamps"), F.min("slot").alias("first_slot"), F.max("compression").alias("compression"), F.count("error").alias("faults"))


@query("SELECT x_cm AS x, z_cm AS z, y_dm AS y, cls, withheld, intensity::INT AS intensity, strip::INT AS strip FROM f_points WHERE x_cm >= 20000 AND x_cm < 90000 AND z_cm > 30000 AND z_cm <= 120000", "f_points")
def s7_point_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box of the point files, by the record ranges that meet it and the columns that are asked for."""
    path = scratch(spark, "points")
    p = d.f_points(spark, sf_dir).select(F.col("x_cm").alias("x"), F.col("y_dm").alias("y"), F.col("z_cm").alias("z"), "cls", "withheld", "intensity", "strip")
    # files of half a million points, which a task sorts in some 50 MB; at most 2,000 ranges in all, of 4,000 points at least
    n = p.count()
    file_ranges.write_points(p, path, files=max(4, n // 500_000))
    file_ranges.point_index(spark, path, f"{path}-index", records=max(4000, n // 2000))
    read = spark.read.format("gridloom_points").schema("x long, z long, y long, cls int, withheld boolean, intensity int, strip int")
    return read.option("path", path).option("index", f"{path}-index").load().where("x >= 20000 AND x < 90000 AND z > 30000 AND z <= 120000")
