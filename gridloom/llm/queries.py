"""The registered queries of this subpackage: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the tokenizers' vocabularies are; a parameter of every operator that reads ids.
BYTE_BPE, WORD_BPE, PIECE_BPE = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import page_of, read_warc, write_warc

    read = read_warc(write_warc(spark.read.parquet(f"{sf_dir}/pages.parquet")))
    return read.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary(BYTE_BPE))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), digest_only=True)


def op4_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix_sources

    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet"), limit=2.0).select("doc_id", "source", "n_tokens", "copies")


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licences import scan

    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import near_vectors

    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op7_audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .audio import audio_features, media_column

    rows, _ = audio_features(media_column(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    return rows.drop("file")


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_store import read_store, write_store

    docs = read_store(write_store(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary(WORD_BPE)))
    return docs.select("doc_id", "start", "n_tokens", "ids_crc32", "verified")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import held_out, labelled, score, train

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(labelled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_jaccard

    return ngram_jaccard(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op11_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .piece_ids import piece_ids

    return piece_ids(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary(PIECE_BPE), digest_only=True)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import materialize
    from .prefix_trie import prefix_trie, shared_openings, turns_in_order

    turns = materialize(turns_in_order(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "turns")
    return prefix_trie(shared_openings(turns), turns.where("pos = 1").select("conv_id"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .conversation_repair import damage, repair

    return repair(damage(spark.read.parquet(f"{sf_dir}/conversations.parquet")), digest_only=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_warc, op2_best_fit_packing, op3_suffix_dedup, op4_temperature_mixing, op5_licence_scan, op6_embedding_dedup, op7_audio_features, op8_token_store, op9_toxicity, op10_ngram_jaccard, op11_piece_ids, op12_prefix_trie, op13_conversation_repair)}
_DIGITS = ", ".join(f"(v >> {k}) & 31" for k in (15, 10, 5, 0))
#: The CRC-32 of an ASCII string: eight shifts after each byte; -1 stands for a shift.
_CRC32 = "xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''), lambda c: list_prepend(ascii(c)::BIGINT, [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))), lambda acc, v: CASE WHEN v >= 0 THEN xor(acc, v) ELSE xor(acc >> 1, 3988292384::BIGINT * (acc & 1)) END), 4294967295::BIGINT)"
#: In the repair's SQL: a state's best with an edit more, by the edit's letter and the state's; "~" is no way.
_EDITS = {
    edit + state: f"CASE WHEN {state} = '~' THEN '~' ELSE lpad((substr({state}, 1, 6)::INT + {cost})::VARCHAR, 6, '0') || substr({state}, 7) || '{edit.upper()}' END"
    for edit, cost in {"d": "3", "k": "cut", "r": "2 + cut", "i": "2"}.items()
    for state in "esua"
}
_MIXED = "((((({0} + {1}) % 2147483647 * 48271 + 12345) % 2147483647 * 69621 + 12345) % 2147483647 * 16807 + 12345) % 2147483647)"

ORACLE_SQL: dict[str, str] = {
    # five hex digits of the SHA-1 are four base32 digits
    "op1_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
g AS (SELECT h, max(page_id) AS top FROM p GROUP BY h),
d AS (SELECT h, string_agg(array_to_string(list_transform([{_DIGITS}], lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x::INT + 1, 1)), ''), '' ORDER BY i) AS b32
      FROM (SELECT h, i, ('0x' || substr(h, (5 * i + 1)::INT, 5))::BIGINT AS v FROM g, range(8) r(i)) GROUP BY h)
SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, b32 AS payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to FROM p JOIN g USING (h) JOIN d USING (h)""",
    "op4_temperature_mixing": f"""
WITH RECURSIVE docs AS (SELECT doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> ''))::BIGINT AS n, {_MIXED.format("doc_id % 2147483647", 7)} AS h FROM documents),
tot AS (SELECT source, sum(n)::BIGINT AS n FROM docs GROUP BY 1 HAVING sum(n) > 0),
p AS (SELECT source, n, n / (SELECT sum(n) FROM tot)::DOUBLE AS p FROM tot),
ends AS (SELECT min(p) AS least, max(p) AS most FROM p),
bis(k, lo, hi) AS (SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE UNION ALL
  SELECT k + 1, CASE WHEN pow(least, (lo + hi) / 2 - 1) / pow(most, (lo + hi) / 2 - 1) <= 2.0 THEN lo ELSE (lo + hi) / 2 END, CASE WHEN pow(least, (lo + hi) / 2 - 1) / pow(most, (lo + hi) / 2 - 1) <= 2.0 THEN (lo + hi) / 2 ELSE hi END FROM bis, ends WHERE k < 50),
alpha AS (SELECT round(CASE WHEN pow(least, -1) / pow(most, -1) <= 2.0 THEN 0.0 ELSE hi END, 9) AS a FROM bis, ends WHERE k = 50),
norm AS (SELECT sum(pow(p, a)) AS s FROM p, alpha),
plan AS (SELECT source, n, round(round(pow(p, a) / s, 18) * ((SELECT sum(n) FROM tot)::DOUBLE * pow(most, 1 - a) * s) + 1e-6)::BIGINT AS owed FROM p, alpha, norm, ends),
blocks AS (SELECT source, h % 1024 AS b, sum(n)::BIGINT AS size FROM docs GROUP BY 1, 2),
placed AS (SELECT k.source, b, size, owed // n AS full_, owed % n - coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY {_MIXED.format("b", 8)}, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_ FROM blocks k JOIN plan w ON k.source IS NOT DISTINCT FROM w.source),
met AS (SELECT d.*, full_, left_, size, sum(d.n) OVER (PARTITION BY d.source, d.h % 1024 ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM docs d LEFT JOIN placed k ON d.source IS NOT DISTINCT FROM k.source AND d.h % 1024 = k.b)
SELECT doc_id, source, n AS n_tokens, coalesce(full_ + CASE WHEN n > 0 AND left_ > 0 AND (left_ >= size OR upto <= left_) THEN 1 ELSE 0 END, 1)::BIGINT AS copies FROM met""",
    "op10_ngram_jaccard": """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM w),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r(doc_id, label) AS (SELECT doc_id, doc_id FROM s UNION SELECT CASE WHEN l.a = r.doc_id THEN l.b ELSE l.a END, r.label FROM r JOIN l ON l.a = r.doc_id OR l.b = r.doc_id)
SELECT s.doc_id, len(any_value(g))::BIGINT AS n_shingles, min(label)::BIGINT AS component_id FROM s JOIN r USING (doc_id) GROUP BY 1""",
    "op12_prefix_trie": f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, md5(coalesce(role, '') || chr(10) || coalesce(text, '')) AS k, octet_length(encode(coalesce(text, ''))) AS b FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, {_CRC32.format("conv_id::VARCHAR")} % 9 AS h FROM t),
r AS (SELECT c.conv_id, 0 AS part, pos, k, b FROM c JOIN t ON t.conv_id = base AND pos <= h UNION ALL SELECT conv_id, 1, pos, k, b FROM c JOIN t USING (conv_id) WHERE pos > h),
p AS (SELECT conv_id, row_number() OVER w AS d, string_agg(k, '') OVER w AS path, b FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY part, pos) UNION ALL SELECT conv_id, 0, '', 0 FROM c),
n AS (SELECT path, any_value(d) AS d, any_value(b) AS b, min(conv_id) AS least, count(*) AS n FROM p GROUP BY path),
e AS (SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM p JOIN (SELECT conv_id, max(d) AS d FROM p GROUP BY 1) USING (conv_id, d) GROUP BY 1),
k AS (SELECT substr(path, 1, len(path) - 32) AS path, count(*) AS children FROM n WHERE d > 0 GROUP BY 1),
s AS (SELECT a.path, sum(CASE WHEN k.path IS NULL THEN 1 ELSE 0 END) AS leaves, sum((m.n - 1) * m.b) AS saved FROM n m JOIN p a ON a.conv_id = m.least AND a.d <= m.d LEFT JOIN k ON k.path = m.path GROUP BY 1)
SELECT n.least AS conv_id, n.d::BIGINT AS depth, up.least AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN k USING (path) LEFT JOIN e USING (path) LEFT JOIN n up ON n.d > 0 AND up.path = substr(n.path, 1, len(n.path) - 32)""",
    # best cost (six digits) and edits per grammar state, row by row
    "op13_conversation_repair": f"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_CRC32.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS f FROM conversations),
w AS (SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role, CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy FROM o, range(2) c(copy) WHERE f <> 0 AND (copy = 0 OR f = 3)),
x AS (SELECT *, row_number() OVER v AS i, substr(role, 1, 1) AS ini, lag(substr(role, 1, 1)) OVER v AS before, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again FROM w WINDOW v AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
y AS (SELECT *, CASE WHEN body = '' THEN 1 WHEN again > 1 THEN 2 WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault FROM x),
z AS (SELECT *, fault IN (1, 2) AS goes, CASE WHEN fault = 3 THEN 1 ELSE 0 END AS cut FROM y),
r(conv_id, i, e, s, u, a) AS (SELECT DISTINCT conv_id, 0::BIGINT, '000000', '~', '~', '~' FROM z UNION ALL
  SELECT conv_id, i, {{de}}, least({{ds}}, CASE WHEN NOT goes AND ini = 's' THEN {{ke}} ELSE '~' END),
    least({{du}}, CASE WHEN goes THEN '~' ELSE least({{re}}, {{rs}}, {{ra}}) END, CASE WHEN goes OR ini <> 'u' THEN '~' ELSE least({{ke}}, {{ks}}, {{ka}}) END),
    least({{da}}, CASE WHEN goes THEN '~' ELSE {{ru}} END, CASE WHEN goes OR ini <> 'a' THEN '~' ELSE {{ku}} END)
  FROM (SELECT conv_id, z.i, ini, goes, cut, e, s, u, least(a, {{iu}}) AS a FROM (SELECT conv_id, i, e, s, a, least(u, {{ie}}, {{is}}, {{ia}}) AS u FROM r) q JOIN z USING (conv_id) WHERE z.i = q.i + 1)),
best AS (SELECT conv_id, least(e, a, {{iu}}) AS b FROM (SELECT conv_id, e, a, least(u, {{ie}}, {{is}}, {{ia}}) AS u FROM r JOIN (SELECT conv_id, max(i) AS i FROM z GROUP BY 1) USING (conv_id, i))),
ed AS (SELECT conv_id, substr(b, 7) AS audit, k, substr(b, k + 6, 1) AS edit, len(replace(substr(b, 7, k), 'I', '')) AS i, len(replace(substr(b, 7, k), 'D', '')) AS place FROM best, range(1, 10000) g(k) WHERE k <= len(b) - 6),
had AS (SELECT conv_id, bool_or(ini = 's' AND edit = 'K') AS system_first FROM ed JOIN z USING (conv_id, i) GROUP BY 1),
out AS (SELECT conv_id, k, CASE WHEN edit = 'K' THEN role WHEN (place - CASE WHEN system_first THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line FROM ed LEFT JOIN z USING (conv_id, i) JOIN had USING (conv_id) WHERE edit <> 'D'),
whole AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS lines FROM out GROUP BY 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM z GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(substr(b, 1, 6)::BIGINT, 0) AS cost, coalesce(substr(b, 7), '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts USING (conv_id) LEFT JOIN best USING (conv_id) LEFT JOIN whole USING (conv_id)""".format(**_EDITS),
}
