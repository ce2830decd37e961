"""Licence scans with a trained paragraph classifier, with DataFrame operations alone on the main path.

Blocks end at lines without a letter or digit. What is judged is each line of a block, and for notices that are wrapped
over lines the joined block: whole up to 16 lines, else in windows of 16 that overlap by 8, so that a notice of up to nine
lines lies within one. Sparse word 1- and 2-grams with logistic weights per licence family give a probability, corrected for
the weight that members have in training; below the family's threshold it is not of this family. The family "unknown" is
for licence notices of no known family: it is learned from all notices, also with their families' names masked, and from
other licences, against all else, and holds only where no known family does. A prediction counts as confirmed if most of the 2-grams of one of the
family's notices are covered (an unknown one never). Of overlapping predictions the one that covers its notice best stands,
of equal ones the shortest; a shorter one gives way to no longer one of another family that covers less. Two notices of one
family within a window count once unless each is a line.

Features count only in a paragraph with a marker, a word of the notices that hardly any other text has; so it is in training
too. Text without a marker therefore has no feature, and its probability is that of the bias, below every threshold: it is
passed by without being split up, and nothing that the classifier would find is lost. A marker is first looked for as a
substring, which passes more than it must.

Training is small and bounded: the fixed notices below with their variants, and `negatives` distinct paragraphs of the corpus
(the first by a hash) that stand for all other text. Thresholds are set on every fifth row, which weights are not fitted to.

Results for odd inputs: null and empty texts have no paragraph; rows with equal ids are scanned each; paragraphs and texts of
any length are read whole; an empty table trains on the notices alone and gives no rows; extra columns are ignored, whatever
their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import doc_key

# Short notices by licence family.
NOTICES: dict[str, list[str]] = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.", "This project is released under the Apache License 2.0.", "SPDX-License-Identifier: Apache-2.0"],
    "MIT": ["Released under the MIT License.", "This software is distributed under the terms of the MIT license.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files", "SPDX-License-Identifier: MIT"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.", "SPDX-License-Identifier: GPL-3.0-or-later"],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2.", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation", "SPDX-License-Identifier: GPL-2.0-only"],
    "LGPL": ["Licensed under the GNU Lesser General Public License.", "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: LGPL-2.1-or-later"],
    "AGPL": ["Licensed under the GNU Affero General Public License.", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation", "SPDX-License-Identifier: AGPL-3.0-only"],
    "BSD": ["Released under the BSD License.", "Use of this source code is governed by a BSD-style license.", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met", "SPDX-License-Identifier: BSD-3-Clause"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "Released under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0"],
    "ISC": ["Released under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted", "SPDX-License-Identifier: ISC"],
    "CC-BY": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.", "SPDX-License-Identifier: CC-BY-4.0"],
    "CC-BY-SA": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "SPDX-License-Identifier: CC-BY-SA-4.0"],
    "CC-BY-NC": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "SPDX-License-Identifier: CC-BY-NC-4.0"],
    "CC0": ["Released under CC0 1.0 Universal.", "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain.", "SPDX-License-Identifier: CC0-1.0"],
}
# Notices of licences that are of no family above.
OTHER_NOTICES = """Licensed under the Eclipse Public License 2.0.
This program and the accompanying materials are made available under the terms of the Eclipse Public License which accompanies this distribution
Licensed under the European Union Public Licence, version 1.2.
Licensed under the Artistic License 2.0.
This library is distributed under the zlib license.
Distributed under the Boost Software License, Version 1.0.
Released under the Unlicense.
This software is distributed under the terms of the PostgreSQL License.
This library is released under the terms of the Zope Public License.
This software is licensed under the Academic Free License version 3.0.
Licensed under the Common Development and Distribution License.
SPDX-License-Identifier: EPL-2.0""".splitlines()
# Words that name a family of NOTICES.
NAMES = "apache mit gnu general lesser affero gpl lgpl agpl bsd mozilla mpl isc creative commons attribution sharealike noncommercial cc cc0 by sa nc".split()
UNKNOWN = "unknown"
# Text about licences, rights or permission that grants nothing.
OTHER_TEXT = """All rights reserved.
Terms of use apply.
The driver lost the license last year.
A license plate and a fishing license are not the same.
Permission denied.
You need permission to enter the building.
See the license agreement of your provider for details.
The copyright holder could not be reached.
No license is granted to any patent.
The public library is open; the general public is welcome.
Version 2.0 of the program will be released soon.
This work is published by the foundation under its own terms.
Licensed to drive, fly and fish.
Released in May, version 3.""".splitlines()
WORD = "[^a-z0-9.]+|\\.+(?=[^a-z0-9]|$)"


def words(column: Column) -> Column:
    """Lower-case words of letters, digits and inner dots."""
    return F.filter(F.split(F.lower(column), WORD), lambda w: w != "")


def grams(w: Column) -> Column:
    """The distinct word 1- and 2-grams."""
    # w is bound to a variable first; in the lambda over places it would be worked out anew for each
    pairs = lambda v: F.when(F.size(v) > 1, F.transform(F.sequence(F.lit(0), F.size(v) - 2), lambda i: F.concat_ws(" ", v[i], v[i + 1]))).otherwise(F.array().cast("array<string>"))
    return F.transform(F.array(w), lambda v: F.array_distinct(F.concat(v, pairs(v))))[0]


def _grams(text: str) -> list[str]:
    w = [x for x in re.split(WORD, text.lower()) if x]
    return list(dict.fromkeys(w + [f"{a} {b}" for a, b in zip(w, w[1:])]))


@dataclass
class LicenceModel:
    weights: dict[str, dict[str, float]]  # family -> gram -> weight
    bias: dict[str, float]
    threshold: dict[str, float]
    markers: list[str]  # in a paragraph without one of these words no gram counts


def _markers(notices: list[str], others: list[str], each: int = 4) -> list[str]:
    """Words of at least three letters that at most one in 500 other paragraphs holds, be it within a word, until each notice has `each` of them or no more."""
    lower = [t.lower() for t in others]
    common = {w: sum(w in t for t in lower) for n in notices for w in _grams(n) if " " not in w and len(w) > 2}
    sets = [{w for w in _grams(t) if w in common and 500 * common[w] <= len(others)} for t in notices]
    chosen: set[str] = set()
    while open_ := [s for s in sets if len(s & chosen) < min(each, len(s))]:
        votes = Counter(w for s in open_ for w in s - chosen)
        chosen.add(min(votes, key=lambda w: (-votes[w], common[w], w)))
    return sorted(chosen)


def train(docs: DataFrame, negatives: int = 2000, features: int = 1500, rounds: int = 200) -> LicenceModel:
    """One logistic regression per family, by gradient steps with soft thresholding (what keeps the weights sparse)."""
    # about `negatives` lines per line of an average document pass the hash, whatever the size of the corpus
    lines = docs.select(F.explode(F.split(F.col("text").cast("string"), "\n")).alias("paragraph")).where(F.length("paragraph").between(1, 2000) & (F.trim("paragraph") != ""))
    lines = lines.where(F.pmod(F.xxhash64("paragraph", F.lit(3)), F.lit(max(1, docs.count()))) < negatives).distinct()
    sample = [r[0] for r in lines.orderBy(F.xxhash64("paragraph"), "paragraph").limit(negatives).collect()] + OTHER_TEXT * 5
    rows: list[tuple[list[str], str | None, str | None]] = []  # grams, family, and the family that a masked notice is silent on
    for family, notices in NOTICES.items():
        for k, notice in enumerate(notices):
            for variant in (notice, notice.rstrip("."), "Note: " + notice, f"{notice} See the LICENSE file for details.", f"{OTHER_TEXT[k]} {notice}"):
                rows.append((_grams(variant), family, None))
            masked = [w for w in re.split(WORD, notice.lower()) if w and w not in NAMES]
            rows.append((_grams(" x ".join([" ".join(masked[:3]), " ".join(masked[3:])])), UNKNOWN, family))
    rows += [(_grams(t), UNKNOWN, None) for notice in OTHER_NOTICES for t in (notice, "Note: " + notice, f"{notice} See the LICENSE file for details.")]
    families = [*NOTICES, UNKNOWN]
    cue = re.compile(r"licen[sc]e|licensed|creative commons|spdx|redistribut|public domain|hereby granted|cc0|cc by", re.I)
    others = [t for t in sample if t in OTHER_TEXT or not cue.search(t)]
    common = Counter(g for t in others for g in _grams(t))
    markers = _markers([n for ns in NOTICES.values() for n in ns] + OTHER_NOTICES, [t for t in others if t not in OTHER_TEXT])
    known = {g for x, f, _ in rows if f for g in x}
    rows += [(_grams(t), None, None) for t in others]
    rows = [(x if not set(markers).isdisjoint(x) else [], f, own) for x, f, own in rows]
    held = [r for i, r in enumerate(rows) if i % 5 == 4]
    fit = [r for i, r in enumerate(rows) if i % 5 != 4]
    vocabulary = sorted(known, key=lambda g: (common[g], g))[:features]
    allowed = set(vocabulary)
    merged = Counter((tuple(g for g in x if g in allowed), f, own) for x, f, own in fit)
    member = lambda f, family: f == family or (family == UNKNOWN and f is not None)
    weights, bias = {}, {}
    for family in families:
        w: dict[str, float] = defaultdict(float)
        b, step, shrink = -2.0, 0.5, 0.002
        used = [(x, member(f, family), n * (20 if f == family else 1)) for (x, f, own), n in merged.items() if own != family]
        total = sum(n for *_, n in used)
        for _ in range(rounds):
            slope: dict[str, float] = defaultdict(float)
            slope_b = 0.0
            for x, is_member, n in used:
                z = b + sum(w[g] for g in x)
                miss = n * (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - is_member) / total
                slope_b += miss
                for g in x:
                    slope[g] += miss
            b -= 4 * step * slope_b
            for g, s in slope.items():
                v = w[g] - 40 * step * s
                w[g] = math.copysign(max(0.0, abs(v) - shrink), v)
        # members counted twenty times: their odds are too high by that, a calibrated bias is lower
        weights[family], bias[family] = {g: round(v, 6) for g, v in w.items() if abs(v) > 1e-3}, round(b - math.log(20), 6)

    def chance(family: str, x: list[str]) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, bias[family] + sum(weights[family].get(g, 0.0) for g in x)))))

    threshold = {}
    logit = lambda p: math.log(p / (1 - p))
    for family in families:  # midway, in log odds, between the best stranger and the worst member of the held-out rows, above what text without features gets
        strangers = max([chance(family, x) for x, f, own in held if not member(f, family) and own != family], default=0.001)
        members = min([chance(family, x) for x, f, _ in held if f == family], default=0.999)
        middle = 1 / (1 + math.exp(-(logit(strangers) + logit(members)) / 2)) if strangers < members else strangers + 1e-3
        threshold[family] = round(min(0.99, max(0.1, chance(family, []) + 1e-3, middle)), 6)
    return LicenceModel(weights, bias, threshold, markers)


def paragraphs(docs: DataFrame, size: int = 16, wanted: Callable[[Column], Column] = lambda c: F.lit(True)) -> DataFrame:
    """text and other columns -> a row per line that is not blank and per window of up to `size` lines of a block: block (from 0), line (first, from 0 in the block), last, paragraph, and the other columns.

    wanted: a test of text which a paragraph passes if a part of it does; what fails it is left out.
    """
    others = [c for c in docs.columns if c != "text"]
    blocks = docs.select(*others, F.posexplode(F.split("text", "\n(?:[^\\p{L}\\p{N}\n]*\n)+")).alias("block", "_t")).where(wanted(F.col("_t"))).withColumn("_l", F.split("_t", "\n"))
    n = F.size("_l")
    part = lambda lo, hi, text: F.struct(lo.cast("int").alias("line"), hi.cast("int").alias("last"), text.alias("paragraph"))
    lines = F.transform("_l", lambda x, i: part(i, i, x))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), n - size // 2 - 1), F.lit(size // 2)) if size > 1 else F.array(F.lit(0))
    starts = F.when(n > size, starts).otherwise(F.array(F.lit(0)))
    windows = F.transform(starts, lambda i: part(i, F.least(i + size, n) - 1, F.array_join(F.slice("_l", i + 1, F.lit(size)), " ")))
    units = F.when(n > 1, F.concat(lines, windows)).otherwise(lines)
    units = blocks.select(*others, "block", F.explode(units).alias("_u")).select(*others, "block", "_u.*")
    return units.where(F.trim("paragraph") != "").where(wanted(F.col("paragraph")))


def classify(docs: DataFrame, model: LicenceModel, confirm: float = 0.7) -> DataFrame:
    """documents -> d and h (id as a sort key, hash of the text), row (tells rows apart), block, line, last, family, probability, confirmed: the lines and windows of a known family or of an unknown one."""
    spark = docs.sparkSession
    schema = T.StructType([T.StructField("gram", T.StringType()), T.StructField("family", T.StringType()), T.StructField("weight", T.DoubleType())])
    table = spark.createDataFrame([(g, f, w) for f, ws in model.weights.items() for g, w in ws.items()], schema)
    families = spark.createDataFrame([(f, model.bias[f], model.threshold[f], [[g for g in _grams(n) if " " in g] for n in NOTICES.get(f, [])]) for f in model.bias], "family string, bias double, threshold double, notices array<array<string>>")
    # the lambda's variable: lower-cased once, not once for each marker
    marked = lambda c: F.exists(F.array(F.lower(c)), lambda t: reduce(or_, [t.contains(w) for w in model.markers]))
    # the id is made and used in this plan alone; results go by d and h
    rows = docs.select(doc_key().alias("d"), F.col("text").cast("string").alias("text")).where(marked(F.col("text")))
    rows = rows.select("d", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), "text")
    place = ["d", "h", "row", "block", "line", "last"]
    maybe = paragraphs(rows, wanted=marked).withColumn("w", words(F.col("paragraph")))
    maybe = maybe.where(F.arrays_overlap("w", F.array(*map(F.lit, model.markers))))
    # grams of other words have no weight
    used = sorted({w for ws in model.weights.values() for g in ws for w in g.split(" ")})
    has = lambda w: w.isin(used)
    pairs = lambda v: F.when(F.size(v) > 1, F.transform(F.filter(F.sequence(F.lit(0), F.size(v) - 2), lambda i: has(v[i]) & has(v[i + 1])), lambda i: F.concat_ws(" ", v[i], v[i + 1]))).otherwise(F.array().cast("array<string>"))
    found = maybe.withColumn("g", F.transform(F.array("w"), lambda v: F.array_distinct(F.concat(F.filter(v, has), pairs(v))))[0])
    # both tables are as large as the notices and the feature limit make them
    scored = found.select(*place, "paragraph", F.explode("g").alias("gram")).join(F.broadcast(table), "gram").groupBy(*place, "family").agg(F.sum("weight").alias("z"), F.first("paragraph").alias("paragraph"))
    known = scored.join(F.broadcast(families), "family").withColumn("probability", F.round(1 / (1 + F.exp(-(F.col("z") + F.col("bias")))), 6)).where("probability >= threshold").withColumn("g", grams(words(F.col("paragraph"))))
    known = known.withColumn("cover", F.coalesce(F.array_max(F.transform("notices", lambda n: F.size(F.array_intersect(n, F.col("g"))) / F.greatest(F.size(n), F.lit(1)))), F.lit(0.0))).drop("g", "notices", "paragraph")
    # a window may hold notices of several families, a line is of one; an unknown licence is what no known family claims
    order = Window.partitionBy("row", "block", "line", "last").orderBy(F.col("family") == UNKNOWN, F.desc("z"), "family")
    best = known.withColumn("k", F.row_number().over(order)).where((F.col("k") == 1) | ((F.col("last") > F.col("line")) & (F.col("cover") >= confirm)))
    hit = F.struct((F.col("family") == UNKNOWN).alias("late"), (-F.col("cover")).alias("rank"), (F.col("last") - F.col("line")).alias("more"), "line", "last", "family", "probability", (F.col("cover") >= confirm).alias("confirmed"))
    listed = best.groupBy("d", "h", "row", "block").agg(F.array_sort(F.collect_list(hit)).alias("hits"))

    def stands(chosen: Column, x: Column) -> Column:
        over = F.exists(chosen, lambda a: (a["line"] <= x["last"]) & (x["line"] <= a["last"]) & ((a["family"] == x["family"]) | (x["family"] == UNKNOWN) | (a["more"] >= x["more"])))
        return F.when(over, chosen).otherwise(F.concat(chosen, F.array(x)))

    none = F.filter("hits", lambda x: F.lit(False))
    return listed.select("d", "h", "row", "block", F.explode(F.aggregate("hits", none, stands)).alias("u")).select("d", "h", "row", "block", "u.line", "u.last", "u.family", "u.probability", "u.confirmed")


def scan(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """documents -> doc_id, n_paragraphs, n_licence, n_confirmed, families (sorted, comma-separated; null if none), probability: a row per document; n_paragraphs counts non-empty lines."""
    model = model or train(docs)
    hits = classify(docs, model).groupBy("d", "h", "row").agg(F.count("*").alias("n"), F.count_if("confirmed").alias("c"), F.array_join(F.array_sort(F.collect_set("family")), ",").alias("f"), F.max("probability").alias("p"))
    # rows equal in id and text have equal hits
    hits = hits.groupBy("d", "h").agg(F.max(F.struct("n", "c", "f", "p")).alias("hit"))
    text = F.col("text").cast("string")
    lines = F.size(F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x != ""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lines.cast("long").alias("n_paragraphs"), doc_key().alias("d"), F.xxhash64(text).alias("h"))
    return rows.join(hits, ["d", "h"], "left").select("doc_id", "n_paragraphs", F.coalesce("hit.n", F.lit(0)).cast("long").alias("n_licence"), F.coalesce("hit.c", F.lit(0)).cast("long").alias("n_confirmed"), F.col("hit.f").alias("families"), F.col("hit.p").alias("probability"))
