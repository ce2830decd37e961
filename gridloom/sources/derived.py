"""Map-like views over the star-schema tables, so that every query reads the given tables and grows with them.

Coordinates are integer centimetres and heights integer decimetres: sums and comparisons are exact in any engine.
Each view is a DataFrame here and the same SELECT in SQL (VIEWS) for the oracle.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VIEWS = {
    "f_points": "SELECT (l_orderkey*7919+l_linenumber*104729)%204800 AS x_cm, (l_partkey*15485+l_suppkey*611+l_orderkey*13)%204800 AS z_cm, 1800+CAST(l_quantity AS BIGINT) AS y_dm, CASE l_linenumber%7 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 6 WHEN 3 THEN 1 WHEN 4 THEN 5 WHEN 5 THEN 9 ELSE 11 END AS cls, (l_returnflag='R' AND l_linestatus='O') AS withheld, CAST(floor(l_extendedprice) AS BIGINT)%65536 AS intensity, l_suppkey%8 AS strip, l_orderkey AS src, l_linenumber AS seq FROM lineitem",
    "f_footprints": "SELECT p_partkey AS fid, (p_partkey*397)%2048 AS x0, (p_partkey*1009)%2048 AS z0, CAST(4+p_size%20 AS BIGINT) AS w, CAST(4+p_partkey%15 AS BIGINT) AS d, CASE WHEN p_partkey%3=0 THEN CAST(3+p_size%12 AS VARCHAR) WHEN p_partkey%3=1 THEN concat(CAST(3+p_size%12 AS VARCHAR),' m') ELSE NULL END AS height_tag, p_type AS material, p_brand AS owner FROM part",
    "f_tiles": "SELECT o_custkey%32-16 AS tx, o_orderkey%32-16 AS tz, min(o_orderkey) AS seq FROM orders GROUP BY 1,2",
    "f_captures": "SELECT o_orderkey AS cid, (o_custkey*31)%8-4 AS tx, (o_custkey*17)%8-4 AS tz, CAST(o_orderdate AS DATE) AS captured, o_orderkey%3=0 AS full_cover, 1+o_orderkey%4 AS bands FROM orders",
    "f_job_events": "SELECT event_id, ts, user_id AS worker, concat(CAST(event_id%16-8 AS VARCHAR),'_',CAST(user_id%16-8 AS VARCHAR)) AS tile, event_id%4 AS stage, CASE event_type WHEN 'click' THEN 'complete' WHEN 'view' THEN 'running' WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'complete' ELSE 'failed' END AS state, CAST(round(value*100) AS BIGINT) AS centiseconds FROM events",
    "f_cells": "SELECT x_cm//100 AS x, z_cm//100 AS z, max(y_dm) AS top, min(y_dm) AS ground, count(*) AS n FROM f_points GROUP BY 1,2",
    "f_coarse": "SELECT x_cm//1600 AS x, z_cm//1600 AS z, max(y_dm) AS top, min(y_dm) AS ground, count(*) AS n FROM f_points GROUP BY 1,2",
    "f_manifest": "SELECT concat('d/',CAST(doc_id AS VARCHAR)) AS path, CAST(n_chars AS BIGINT) AS bytes, text FROM documents",
    "f_places": "SELECT c_custkey AS pid, c_name AS name, c_mktsegment AS kind, (c_custkey*97)%20480 AS x_dm, (c_custkey*61)%20480 AS z_dm FROM customer",
    "f_bands": "SELECT vec_id AS pix, vec_id%32 AS x, vec_id//32 AS z, CAST(floor((embedding[1]+2)*60) AS BIGINT) AS red, CAST(floor((embedding[2]+2)*60) AS BIGINT) AS green, CAST(floor((embedding[3]+2)*60) AS BIGINT) AS blue, CAST(floor((embedding[4]+2)*60) AS BIGINT) AS nir FROM embeddings",
}
_NEEDS = {"f_cells": ["f_points"], "f_coarse": ["f_points"]}


def with_views(names: list[str], sql: str) -> str:
    """The oracle form of a query: its views as common table expressions before it."""
    order = []
    for n in names:
        order += [v for v in [*_NEEDS.get(n, []), n] if v not in order]
    recursive = "RECURSIVE " if re.search(r"\br\(", sql) else ""
    head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {recursive}{head}, {body[5:]}"
    return f"WITH {recursive}{head} {body}"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def f_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    cls = F.element_at(F.array(*map(F.lit, (2, 2, 6, 1, 5, 9, 11))), (c("l_linenumber") % 7 + 1).cast("int"))
    return _table(spark, sf_dir, "lineitem").select(
        ((c("l_orderkey") * 7919 + c("l_linenumber") * 104729) % 204800).alias("x_cm"),
        ((c("l_partkey") * 15485 + c("l_suppkey") * 611 + c("l_orderkey") * 13) % 204800).alias("z_cm"),
        (c("l_quantity").cast("long") + 1800).alias("y_dm"),
        cls.alias("cls"),
        ((c("l_returnflag") == "R") & (c("l_linestatus") == "O")).alias("withheld"),
        (F.floor("l_extendedprice") % 65536).alias("intensity"),
        (c("l_suppkey") % 8).alias("strip"),
        c("l_orderkey").alias("src"),
        c("l_linenumber").alias("seq"),
    )


def f_footprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    tag = (size % 12 + 3).cast("string")
    return _table(spark, sf_dir, "part").select(
        k.alias("fid"), ((k * 397) % 2048).alias("x0"), ((k * 1009) % 2048).alias("z0"), (size % 20 + 4).cast("long").alias("w"), (k % 15 + 4).alias("d"),
        F.when(k % 3 == 0, tag).when(k % 3 == 1, F.concat(tag, F.lit(" m"))).alias("height_tag"), F.col("p_type").alias("material"), F.col("p_brand").alias("owner"),
    )


def f_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").groupBy((F.col("o_custkey") % 32 - 16).alias("tx"), (F.col("o_orderkey") % 32 - 16).alias("tz")).agg(F.min("o_orderkey").alias("seq"))


def f_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, k = F.col("o_orderkey"), F.col("o_custkey")
    return _table(spark, sf_dir, "orders").select(o.alias("cid"), ((k * 31) % 8 - 4).alias("tx"), ((k * 17) % 8 - 4).alias("tz"), F.col("o_orderdate").cast("date").alias("captured"), (o % 3 == 0).alias("full_cover"), (o % 4 + 1).alias("bands"))


def f_job_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_events(_table(spark, sf_dir, "events"))


def job_events(events: DataFrame) -> DataFrame:
    """The job-event columns of an events table or stream."""
    e, u = F.col("event_id"), F.col("user_id")
    states = F.create_map(*[F.lit(x) for pair in {"click": "complete", "view": "running", "signup": "pending", "purchase": "complete"}.items() for x in pair])
    return events.select(
        e, "ts", u.alias("worker"), F.concat_ws("_", (e % 16 - 8).cast("string"), (u % 16 - 8).cast("string")).alias("tile"), (e % 4).alias("stage"),
        F.coalesce(F.try_element_at(states, F.col("event_type")), F.lit("failed")).alias("state"), F.round(F.col("value") * 100).cast("long").alias("centiseconds"),
    )


def _grid(points: DataFrame, cm: int) -> DataFrame:
    return points.groupBy(F.floor(F.col("x_cm") / cm).alias("x"), F.floor(F.col("z_cm") / cm).alias("z")).agg(F.max("y_dm").alias("top"), F.min("y_dm").alias("ground"), F.count("*").alias("n"))


def f_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(f_points(spark, sf_dir), 100)


def f_coarse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _grid(f_points(spark, sf_dir), 1600)


def f_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select(F.concat(F.lit("d/"), F.col("doc_id").cast("string")).alias("path"), F.col("n_chars").cast("long").alias("bytes"), "text")


def f_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return _table(spark, sf_dir, "customer").select(k.alias("pid"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("kind"), ((k * 97) % 20480).alias("x_dm"), ((k * 61) % 20480).alias("z_dm"))


def f_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    # all in single precision, as the SQL is: with whole-number literals Spark would compute in double
    band = lambda i: F.floor((F.col("embedding")[i] + F.lit(2).cast("float")) * F.lit(60).cast("float"))
    v = F.col("vec_id")
    return _table(spark, sf_dir, "embeddings").select(v.alias("pix"), (v % 32).alias("x"), F.floor(v / 32).alias("z"), band(0).alias("red"), band(1).alias("green"), band(2).alias("blue"), band(3).alias("nir"))
