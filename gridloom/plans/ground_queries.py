"""Ground classes of the imagery cells, and holes in paving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import ground
from gridloom.plans.registry import query
from gridloom.sources import derived as d

_L = ground.LIMIT
_SMALL = {"concrete": 2, "asphalt": 2, "soil": 2, "field": 3, "prairie": 2, "marsh": 2, "mud": 2}
_SIDES = "(VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) o(dx, dz)"


@query(
    f"""WITH b AS (SELECT *, CASE pix % 7 WHEN 3 THEN 30 WHEN 4 THEN 40 WHEN 5 THEN 90 END AS cover, pix % 13 = 0 AS parking, pix % 17 = 0 AS wetland, pix % 11 <> 0 AS editable, greatest(red, green, blue) >= 45 AS visible, (nir - red) * 1.0 / nullif(nir + red, 0) AS v FROM f_bands),
t AS (SELECT pix, x, z, editable, parking, coalesce(cover = 90, false) OR wetland AS wet, coalesce(cover = 40, false) AS crops, coalesce(cover = 30, false) AS grass, visible AND v IS NOT NULL AS seen, coalesce(visible AND v <= {_L['bare index']}, false) AS bare, coalesce(visible AND v > {_L['green index']}, false) AS green_,
  (red + green + blue) / 3.0 AS mean, greatest(red, green, blue) - least(red, green, blue) AS chroma, v, red, green, blue FROM b),
f AS (SELECT *, bare AND mean >= {_L['shade']} AND chroma < {_L['neutral chroma']} AS hard FROM t),
e AS (SELECT *, seen AND mean >= {_L['shade']} AND v <= {_L['soil index']} AND NOT hard AND red > green + {_L['red over green']} AND red > blue + {_L['red over blue']} AS earth FROM f),
c AS (SELECT pix, x, z, CASE WHEN NOT editable THEN 'keep' WHEN wet AND earth THEN 'mud' WHEN wet AND green_ THEN 'marsh' WHEN grass AND green_ AND NOT parking THEN 'prairie' WHEN crops AND NOT parking AND seen AND NOT bare THEN 'field' WHEN parking AND seen AND NOT green_ THEN 'asphalt' WHEN earth THEN 'soil' WHEN hard AND mean < {_L['pale']} THEN 'asphalt' WHEN hard THEN 'concrete' ELSE 'keep' END AS class FROM e),
r(x, z, class, label) AS (SELECT x, z, class, pix FROM c WHERE class <> 'keep' UNION SELECT c.x, c.z, c.class, r.label FROM r, {_SIDES}, c WHERE c.x = r.x + dx AND c.z = r.z + dz AND c.class = r.class),
l AS (SELECT x, z, class, min(label) AS label FROM r GROUP BY 1, 2, 3), n AS (SELECT label, count(*) AS n FROM l GROUP BY 1)
SELECT pix, CASE WHEN n.n < CASE c.class {" ".join(f"WHEN '{k}' THEN {v}" for k, v in _SMALL.items())} END THEN 'keep' ELSE c.class END AS class FROM c LEFT JOIN l USING (x, z) LEFT JOIN n USING (label)""",
    "f_bands",
)
def p12_ground_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes by the rule table within the editable cells, without specks."""
    pix = F.col("pix")
    cover = F.when(pix % 7 == 3, 30).when(pix % 7 == 4, 40).when(pix % 7 == 5, 90)
    seen = d.f_bands(spark, sf_dir).withColumns({"visible": F.greatest("red", "green", "blue") >= 45, "cover": cover, "parking": pix % 13 == 0, "wetland": pix % 17 == 0, "editable": pix % 11 != 0})
    cells = ground.classified(seen).select("pix", "x", "z", "class")
    return ground.without_specks(cells, _SMALL).select("pix", "class")


@query(
    f"""WITH c AS (SELECT x, z, CASE WHEN n % 5 = 0 AND n % 3 = 0 THEN 'soil' WHEN n % 5 = 0 THEN 'keep' WHEN n % 2 = 0 THEN 'concrete' ELSE 'asphalt' END AS class, (top % 10) / 10.0::DOUBLE AS index, ground % 3 > 0 AS sunlit, top % 11 > 0 AS visible, (x * 7 + z * 3) % 29 > 0 AS editable FROM f_coarse),
w AS (SELECT x, z, x * 100000 + z AS id FROM c WHERE class IN ('keep', 'soil') AND editable), r(x, z, label) AS (SELECT x, z, id FROM w UNION SELECT w.x, w.z, r.label FROM r, {_SIDES}, w WHERE w.x = r.x + dx AND w.z = r.z + dz),
a AS (SELECT x, z, min(label) AS label FROM r GROUP BY 1, 2), o AS (SELECT DISTINCT label FROM a, {_SIDES} WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.x = a.x + dx AND c.z = a.z + dz)),
k AS (SELECT c.*, x * 100000 + z AS id FROM c JOIN a USING (x, z) WHERE class = 'keep' AND label NOT IN (SELECT label FROM o)), r2(x, z, label) AS (SELECT x, z, id FROM k UNION SELECT k.x, k.z, r2.label FROM r2, {_SIDES}, k WHERE k.x = r2.x + dx AND k.z = r2.z + dz),
h AS (SELECT x, z, min(label) AS label FROM r2 GROUP BY 1, 2),
lawn AS (SELECT x // 64 AS tx, z // 64 AS tz, quantile_cont(index, 0.5) AS lawn FROM c WHERE class = 'keep' AND editable AND visible AND NOT EXISTS (SELECT 1 FROM h WHERE h.x = c.x AND h.z = c.z) GROUP BY 1, 2),
j AS (SELECT label, count(*) AS n, quantile_cont(index, 0.5) AS middle, avg(sunlit::INT) AS lit, arg_min(x, (z, x)) AS fx, min(z) AS fz FROM h JOIN c USING (x, z) GROUP BY 1),
t AS (SELECT h.x, h.z FROM h JOIN j USING (label) JOIN lawn ON tx = fx // 64 AND tz = fz // 64 WHERE n < 128 AND middle < lawn - 0.2 AND lit > 0.5),
p AS (SELECT t.x, t.z, c.class AS paved, row_number() OVER (PARTITION BY t.x, t.z ORDER BY (t.x - c.x) * (t.x - c.x) + (t.z - c.z) * (t.z - c.z), c.z, c.x) AS i FROM t JOIN c ON c.class IN ('concrete', 'asphalt') AND (t.x - c.x) * (t.x - c.x) + (t.z - c.z) * (t.z - c.z) <= 256)
SELECT c.x, c.z, coalesce(paved, class) AS class, paved IS NOT NULL AS filled FROM c LEFT JOIN (SELECT * FROM p WHERE i = 1) q USING (x, z)""",
    "f_coarse",
)
def g3_filled_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of 16 m with the holes in paving filled."""
    n, top = F.col("n"), F.col("top")
    name = F.when((n % 5 == 0) & (n % 3 == 0), "soil").when(n % 5 == 0, "keep").when(n % 2 == 0, "concrete").otherwise("asphalt")
    cells = d.f_coarse(spark, sf_dir).select("x", "z", name.alias("class"), ((top % 10) / 10).alias("index"), (F.col("ground") % 3 > 0).alias("sunlit"), (top % 11 > 0).alias("visible"), ((F.col("x") * 7 + F.col("z") * 3) % 29 > 0).alias("editable"), name.alias("before"))
    filled = ground.without_holes(cells, 64)
    return filled.select("x", "z", "class", (F.col("class") != F.col("before")).alias("filled"))
