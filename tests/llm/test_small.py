"""The training-data operators on small tables against brute force, with nulls, empties, ties, repeats and clashing columns."""

import base64
import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("gridloom.llm")
from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

from gridloom.llm import audio, licences, packing, suffix_dedup, token_store, toxicity  # noqa: E402
from gridloom.llm.components import components  # noqa: E402
from gridloom.llm.embedding_dedup import near_vectors  # noqa: E402
from gridloom.llm.mixing import mix_sources, tokens  # noqa: E402
from gridloom.llm.ngram_join import ngram_jaccard, shingles  # noqa: E402
from gridloom.llm.queries import BYTE_BPE, WORD_BPE, vocabulary  # noqa: E402
from gridloom.llm.tokens import Encoder  # noqa: E402
from gridloom.llm.warc import page_of, read_warc, write_warc  # noqa: E402

WORDS = "alpha beta gamma delta rho sigma tau omega kappa lambda mu nu xi pi".split()


def prose(seed: int, n: int) -> str:
    r = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(j % 7) for i, j in zip(r.integers(0, len(WORDS), n), r.integers(0, 50, n)))


def corpus() -> list[tuple]:
    base, passage = prose(1, 120), prose(2, 60)
    rows = [(1, base), (2, base), (3, base + " tail words here"), (4, None), (5, ""), (6, "one two"), (7, "one two"), (8, prose(3, 300)), (9, prose(4, 40) + " " + passage + " " + prose(5, 40)), (10, prose(6, 50) + " " + passage), (11, "  \n\t "), (None, prose(7, 30)), (12, "ä" * 300), (13, "x" + "ä" * 299), (14, "a" * 5000), (2, base)]
    return [(i, t, "clash", 7, "src" if k % 3 else None) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), "doc_id long, text string, key string, d int, source string").repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


def texts() -> list[bytes]:
    return [(t or "").encode() for _, t, *_ in corpus()]


@given(st.lists(st.integers(1, 64), min_size=1, max_size=120))
@settings(max_examples=60, deadline=None)
def test_packing_kernel(sizes):
    a = np.array(sizes)
    bins, offsets, loads = packing.best_fit_decreasing(a, 64)
    assert len(loads) >= packing.lower_bound(a, 64) >= -(-sum(sizes) // 64) and loads.max() <= 64
    for b in range(len(loads)):
        own = sorted((offsets[i], a[i]) for i in range(len(a)) if bins[i] == b)
        assert sum(n for _, n in own) == loads[b] and all(x + n == y for (x, n), (y, _) in zip(own, own[1:]))


def test_lower_bound_sees_large_pieces():
    assert packing.lower_bound(np.array([40, 40, 40]), 64) == 3


def test_packing(docs, none):
    rows = packing.pack_documents(docs, vocabulary(BYTE_BPE)).collect()
    enc = Encoder(vocabulary(BYTE_BPE), "byte")
    ids = {i: np.frombuffer(e, "<u4").tolist() + [2] for (i, t, *_), e in zip(corpus(), enc.encode([r[1] for r in corpus()]))}
    for r in rows:
        assert zlib.crc32(np.array(ids[r.doc_id][r.start : r.start + r.length], "<u4").tobytes()) == r.ids_crc32
    assert collections.Counter(r.doc_id for r in rows if r.piece == 0)[2] == 2
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for s in by.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:])) and sum(n for _, n in s) <= 1024
    assert packing.pack_documents(none, vocabulary(BYTE_BPE)).count() == 0


def test_packing_exchanges_documents(spark):
    pieces = spark.range(4000).selectExpr("id AS doc_id", "cast(1 + (id * 7919) % 900 as long) AS length")
    out = packing.best_fit_pack(pieces, 1024, group_pieces=300).collect()
    assert len(out) == 4000
    sizes = np.array([r.length for r in out])
    whole = len(packing.best_fit_decreasing(sizes, 1024)[2])
    assert packing.lower_bound(sizes, 1024) <= len({r.sequence_id for r in out}) <= whole * 1.02  # a random part of the pieces is never as well balanced as the whole


@pytest.mark.parametrize("name,kind", [(BYTE_BPE, "byte"), (WORD_BPE, "word")])
def test_encoder_equals_the_library(name, kind):
    enc = Encoder(vocabulary(name), kind, entries=50)
    odd = ["a\n\n b  c\t\td\x1ce 'S don't x  ", "  ", "\n", "é İstanbul ΣΑΣ ok<|endoftext|>\n\n<|endoftext|> x", "　日本語 テキスト 12 345", "a" * 3000 + " b", "x,y. z! (w)", "L'été déjà-vu", "", None, prose(9, 400)]
    for _ in range(2):
        for t, got in zip(odd, enc.encode(odd)):
            assert got == np.array(enc.tokenizer.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()


@given(st.lists(st.integers(0, 30), max_size=600))
@settings(max_examples=60, deadline=None)
def test_chunks_cover_the_stream(ids):
    ends = token_store.chunk_ends(np.array(ids, np.uint32), 16, 4, 64, 4)
    assert ends[-1] == len(ids) and all(0 < b - a <= 64 for a, b in zip([0, *ends], ends) if len(ids))


def test_token_store(docs, none):
    store = token_store.write_store(docs, vocabulary(WORD_BPE))
    rows = token_store.read_store(store).orderBy("start").collect()
    enc = Encoder(vocabulary(WORD_BPE), "word")
    want = sorted(((i if i is not None else -(2**63), len(e) // 4 + 1, zlib.crc32(e + np.array([2], "<u4").tobytes())) for (i, *_), e in zip(corpus(), enc.encode([r[1] for r in corpus()]))), key=lambda x: x[0])
    assert all(r.verified for r in rows)
    assert [(r.n_tokens, r.ids_crc32) for r in rows] == [(n, c) for _, n, c in want]
    assert [r.start for r in rows] == np.cumsum([0] + [n for _, n, _ in want])[:-1].tolist()
    assert store["index"].count() == store["index"].select("digest").distinct().count()
    assert token_store.read_store(token_store.write_store(none, vocabulary(WORD_BPE))).count() == 0


def test_token_store_finds_a_wrong_manifest_and_missing_chunks(docs):
    store = token_store.write_store(docs, vocabulary(WORD_BPE))
    recipes, manifest = store["recipes"], store["manifest"]
    part = recipes.select("part").first()[0]
    for wrong in (manifest.withColumn("root", F.when(F.col("part") == part, F.lit(bytes(16))).otherwise(F.col("root"))), manifest.where(F.col("part") != part)):
        rows = token_store.read_store({**store, "manifest": wrong}).collect()
        assert len(rows) == len(corpus()) and sum(not r.verified for r in rows) == recipes.where(F.col("part") == part).count()
    for wrong in (recipes.withColumn("root", F.when(F.col("doc_id") == 8, F.lit(bytes(16))).otherwise(F.col("root"))), recipes.where("doc_id <> 8 OR doc_id IS NULL")):
        rows = token_store.read_store({**store, "recipes": wrong}).collect()
        assert not all(r.verified for r in rows)
    one = store["index"].first()["digest"]
    rows = token_store.read_store({**store, "index": store["index"].where(F.col("digest") != F.lit(bytes(one)))}).collect()
    assert len(rows) == len(corpus()) and 0 < sum(not r.verified for r in rows) < len(rows)


def test_mixing_with_clashing_names(docs):
    want = sorted((str(r.doc_id), r.n_tokens, r.copies) for r in mix_sources(docs).collect())
    clashing = docs
    for c in ("n_tokens", "copies", "_h", "_b", "_n", "_s", "_k", "_left", "_last", "_own1"):
        clashing = clashing.withColumn(c, F.lit("theirs"))
    got = mix_sources(clashing)
    assert sorted((str(r.doc_id), r.n_tokens, r.copies) for r in got.collect()) == want
    assert got.where("_h = 'theirs' AND _own1 = 'theirs'").count() == len(want) and got.columns.count("n_tokens") == 1


def _archive(spark, folder, records: list[bytes], level: int, damage: int | None = None):
    import zlib

    members = []
    for r in records:
        gz = zlib.compressobj(level, zlib.DEFLATED, 31)
        members.append(gz.compress(r) + gz.flush())
    data = bytearray(b"".join(members))
    if damage is not None:
        data[damage : damage + 40] = bytes(x ^ 255 for x in data[damage : damage + 40])
    path = folder / f"{level}-{damage}.warc.gz"
    path.write_bytes(bytes(data))
    return spark.createDataFrame([(str(path), len(data), len(records), f"file://{folder}")], "path string, bytes long, records long, root string"), len(data)


def test_warc_damage_is_an_error_for_every_split(spark, tmp_path):
    from gridloom.llm.warc import _record

    records = []
    for i in range(120):
        body = prose(i, 150).encode()
        records.append(_record("response", i, "u", body, base64.b32encode(hashlib.sha1(body).digest()).decode(), None))
    whole, size = _archive(spark, tmp_path, records, 3)
    for split in (3_000, 20_000, size):
        assert read_warc(whole, split).count() == 120
    for place in (size // 2, size // 7, size - 60):
        broken, _ = _archive(spark, tmp_path, records, 3, place)
        for split in (3_000, 20_000, 100_000, size):
            with pytest.raises(Exception, match="broken record|payload digest differs"):
                read_warc(broken, split).count()


def test_warc_archives_inside_payloads(spark, tmp_path):
    import gzip

    from gridloom.llm.warc import _record

    records = []
    for i in range(40):
        inner = b"".join(gzip.compress(_record("response", 1000 + 9 * i + k, "v", prose(k, 60).encode(), "", None)) for k in range(9))
        records.append(_record("response", i, "u", inner, base64.b32encode(hashlib.sha1(inner).digest()).decode(), None))
    stored, size = _archive(spark, tmp_path, records, 0)  # nothing is compressed: the inner members stand in the file as they are
    for split in (500, 5_000, 40_000, size):
        got = read_warc(stored, split).select("record_id", "place").collect()
        assert sorted(r.record_id for r in got) == sorted(f"urn:page:{i}" for i in range(40))


def test_warc(spark):
    rows = [(1, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (3, None, None), (4, "u", ""), (None, "v", "same"), (5, "w", "é" * 4000), (2, "http://b", "same"), (6, "z", prose(8, 20000))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    for split in (None, 1 << 24, 200):
        got = read_warc(write_warc(pages), split).withColumn("p", page_of("record_id")).withColumn("r", page_of("refers_to")).collect()
        assert len(got) == len(rows)
        kinds = collections.Counter((r.p, r.record_type, r.r) for r in got)
        assert kinds == collections.Counter([(1, "revisit", 2), (2, "response", None), (2, "response", None), (None, "revisit", 2), (3, "revisit", 4), (4, "response", None), (5, "response", None), (6, "response", None)])
        assert {r.p: r.payload_bytes for r in got}[5] == 8000
    assert read_warc(write_warc(pages, min_revisit_bytes=5)).where("record_type = 'revisit'").count() == 0
    assert read_warc(write_warc(pages.where("false"))).count() == 0


def test_suffix_ranks_and_matches():
    rng = np.random.default_rng(3)
    text = rng.integers(0, 2, 300).astype(np.uint8)
    rank = suffix_dedup.suffix_ranks(text, 12)
    keys = [bytes(text[i : i + 12]) for i in range(289)]
    for i in range(288):
        assert (rank[i] == rank[i + 1]) == (keys[i] == keys[i + 1]) and (rank[i] < rank[i + 1]) == (keys[i] < keys[i + 1])
    starts = np.arange(289)
    seen, want = set(), []
    for k in keys:
        want.append(k in seen)
        seen.add(k)
    assert suffix_dedup.earlier_match(text, starts, starts, 12).tolist() == want


def brute_repeats(rows, length):
    order = sorted(range(len(rows)), key=lambda i: -(2**63) if rows[i][0] is None else rows[i][0])
    first: dict[bytes, tuple] = {}
    for i in order:
        d, b = (-(2**63) if rows[i][0] is None else rows[i][0]), (rows[i][1] or "").encode()
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(first.get(w, (d, p)), (d, p))
    out = {}
    for i in order:
        d, b = (-(2**63) if rows[i][0] is None else rows[i][0]), (rows[i][1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < (d, p):
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[d] = (len(b), sum(gone), sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("often", [256, 2])
def test_suffix_dedup(docs, none, often):
    got = suffix_dedup.remove_repeats(docs, often=often).collect()
    want = brute_repeats(corpus(), 100)
    assert len(got) == len(corpus())
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[-(2**63) if r.doc_id is None else r.doc_id], r.doc_id
        assert r.key == "clash"
    assert suffix_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("often", [256, 2])
def test_suffix_dedup_of_ids_with_several_texts(spark, often):
    base, other, passage = prose(21, 60), prose(22, 60), prose(23, 40)
    twice = passage + " " + prose(24, 20) + " " + passage
    rows = [(1, base), (5, base), (5, other), (None, twice), (None, prose(25, 60)), (6, prose(26, 9) + " " + passage), (7, twice), (7, prose(27, 30) + passage), (9, prose(28, 30) + prose(29, 30)), (9, prose(28, 9) + " " + prose(29, 30))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    first, own = {}, {}
    for i, (d, text) in enumerate(rows):
        b = text.encode()
        for p in range(len(b) - 99):
            first[b[p : p + 100]] = min(first.get(b[p : p + 100], 10**9), -1 if d is None else d)
            own.setdefault((i, b[p : p + 100]), p)
    want = []
    for i, (d, text) in enumerate(rows):
        b = text.encode()
        gone = {q for p in range(len(b) - 99) if first[b[p : p + 100]] < (-1 if d is None else d) or own[i, b[p : p + 100]] < p for q in range(p, p + 100)}
        want.append((d, len(b), len(gone), hashlib.sha256(bytes(c for q, c in enumerate(b) if q not in gone)).hexdigest()))
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(df, often=often).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def brute_jaccard(rows):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    part = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                if a is not None and b is not None and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) and part[a] != part[b]:
                    part[a] = part[b] = min(part[a], part[b])
                    changed = True
    return {i: (len(sets[i]), part[i]) for i in sets}


def test_ngram_jaccard(docs, none, spark):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard(docs).collect()}
    assert got == brute_jaccard(corpus())
    assert ngram_jaccard(none).count() == 0
    base = prose(20, 150).split()
    rng = np.random.default_rng(4)
    rows = []
    for i in range(60):  # copies with a few words changed: links of every strength
        w = list(base)
        for j in rng.integers(0, len(w), rng.integers(0, 6)):
            w[j] = f"new{i}x{j}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, prose(30 + i, 80) + " " + " ".join(base[:40])) for i in range(30)]
    near = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard(near).collect()} == brute_jaccard(rows)


def test_ngram_jaccard_of_a_large_group(spark):
    """Several hundred near copies around the threshold, settled by their differences (direct=4), with a very long text and clashing columns."""
    base, other = prose(50, 120).split(), prose(51, 120).split()
    rng, rows = np.random.default_rng(8), []
    for i in range(260):
        w = list(base if i % 4 else other)
        for j in rng.choice(len(w), rng.integers(0, 9), replace=False):
            w[j] = f"w{i}x{j}" if i % 3 else f"shared{j % 5}"
        rows.append((i, " ".join(w), "x", 1, "y"))
    rows += [(900, prose(60, 30_000), "x", 1, "y"), (901, " ".join(base[:100]), "x", 1, "y"), (902, " ".join(base[20:]), "x", 1, "y"), (903, None, "x", 1, "y"), (904, "", "x", 1, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, n int, class string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_jaccard(df, direct=4, tiny=2).collect()}
    assert got == brute_jaccard(rows)
    assert len({c for _, c in got.values()}) > 20


def test_shingles_of_short_texts():
    s = lambda t: len(shingles(np.frombuffer(t.encode(), np.uint8)))
    assert [s(""), s("  \n"), s("one"), s("a b c d"), s("a b c d e"), s("a b c d e f"), s("a a a a a a a")] == [0, 0, 1, 1, 1, 2, 1]
    assert (shingles(np.frombuffer(b"A B", np.uint8)) == shingles(np.frombuffer(b" a\tb\n", np.uint8))).all()


def test_components(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.root for r in components(chain).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_near_vectors(spark):
    rng = np.random.default_rng(0)
    centre = rng.standard_normal((12, 16))
    rows = []
    for k, c in enumerate(centre):
        for j in range(10):
            rows.append((len(rows), k % 3, (c + rng.standard_normal(16) * (0.12 if j < 8 else 0.35)).astype(np.float32).tolist()))
    odd = [(900, None, rows[0][2]), (901, 0, None), (902, 0, [0.0] * 16), (903, 0, [float("nan")] * 16), (904, 0, []), (905, 0, [1.0, None]), (None, 0, rows[0][2]), (0, 0, rows[0][2])]
    df = spark.createDataFrame(rows + odd, "vec_id long, label int, embedding array<float>").repartition(3)
    got = near_vectors(df).collect()
    assert len(got) == len(rows) + len(odd)
    usable = [(i, l, np.array(v, float)) for i, l, v in rows + [odd[6], odd[7]]]
    x = np.stack([v / np.linalg.norm(v) for _, _, v in usable])
    near = (x @ x.T >= 0.93) & (np.array([l for _, l, _ in usable])[:, None] == np.array([l for _, l, _ in usable])[None, :])
    np.fill_diagonal(near, False)
    assert sum(r.n_links for r in got) >= 0.9 * near.sum() and sum(r.n_links for r in got) <= near.sum()
    by = {r.vec_id: r for r in got}
    assert all(by[i].n_links == 0 and by[i].kept for i in range(900, 906))
    assert near_vectors(df.where("false")).count() == 0


def test_near_vectors_with_a_common_direction(spark):
    rng, n, dim, pairs = np.random.default_rng(4), 3000, 32, 300
    x = rng.standard_normal((n, dim))
    x = 0.9 * np.eye(dim)[0] + np.sqrt(1 - 0.9**2) * x / np.linalg.norm(x, axis=1, keepdims=True)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = rng.standard_normal((pairs, dim))
    near -= (near * x[:pairs]).sum(1, keepdims=True) * x[:pairs]
    x[pairs : 2 * pairs] = 0.98 * x[:pairs] + np.sqrt(1 - 0.98**2) * near / np.linalg.norm(near, axis=1, keepdims=True)
    df = spark.createDataFrame([(i, 0, v) for i, v in enumerate(x.tolist())], "vec_id long, label int, embedding array<double>")
    links = x @ x.T >= 0.97
    np.fill_diagonal(links, False)
    got = sum(r.n_links for r in near_vectors(df, threshold=0.97, window=3).collect())
    assert 0.97 * links.sum() <= got <= links.sum()


def test_mixing(docs, none, spark):
    got = mix_sources(docs, limit=2.0)
    assert got.count() == len(corpus()) and got.where("copies < 1").count() == 0
    rows = [(i, "w " * (1 + i % 5), "big" if i % 10 else f"small{i % 3}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    n = df.withColumn("n", tokens()).groupBy("source").sum("n").collect()
    total = {r[0]: r[1] for r in n}
    have = {r[0]: r[1] / total[r[0]] for r in mix_sources(df, limit=3.0).groupBy("source").agg({"n_tokens": "max"}).collect()}
    assert set(have) == set(total)
    mixed = mix_sources(df, limit=3.0, blocks=16).selectExpr("source", "n_tokens * copies AS t").groupBy("source").sum("t").collect()
    times = {r[0]: r[1] / total[r[0]] for r in mixed}
    assert times["big"] == 1 and 2.9 < max(times.values()) <= 3.0
    half = mix_sources(df, limit=1.0, budget=sum(total.values()) // 2, blocks=16).selectExpr("sum(n_tokens * copies)").first()[0]
    assert 0.45 * sum(total.values()) < half <= 0.51 * sum(total.values())
    assert mix_sources(none).count() == 0


def test_licences(spark, none):
    notices = [(i, f"{prose(i, 20)}\n{n}\n{prose(i + 50, 10)}", f) for i, (f, n) in enumerate((f, n) for f in ("MIT", "Apache-2.0", "GPL-3.0", "CC-BY-NC") for n in licences.NOTICES[f][:1])]
    other = [(100 + i, t, None) for i, t in enumerate([None, "", "All rights reserved.", "A license plate and a fishing license are not the same.", prose(3, 200)])]
    df = spark.createDataFrame([(i, t) for i, t, _ in notices + other], "doc_id long, text string")
    model = licences.train(df)
    got = {r.doc_id: r.families for r in licences.scan(df, model).collect()}
    assert got == {i: f for i, _, f in notices + other}
    assert licences.scan(none, model).count() == 0


WRAPPED = {
    "GPL-3.0": "# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:",
    "BSD": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at",
}


def test_licences_in_wrapped_headers(spark):
    lines = "\n".join(prose(k, 9) for k in range(40))
    rows = [(f, f"{prose(1, 20)}\n\n{t}\n\n{prose(2, 10)}") for f, t in WRAPPED.items()]
    rows += [(f, f"{lines}\n{t}\n{lines}") for f, t in WRAPPED.items()]
    rows += [("GPL-3.0,MIT", "Released under the MIT License.\n" + WRAPPED["GPL-3.0"]), (None, lines)]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan(df).collect()}
    assert {i: r.families for i, r in got.items()} == {i: f for i, (f, _) in enumerate(rows)}
    assert all(got[i].n_confirmed == len(f.split(",")) for i, (f, _) in enumerate(rows) if f)


def test_licence_scan_equals_the_ungated_classifier(spark, none):
    model = licences.train(none)
    assert all(1 / (1 + np.exp(-b)) < model.threshold[f] for f, b in model.bias.items())
    rng, notices = np.random.default_rng(2), [n for ns in licences.NOTICES.values() for n in ns] + licences.OTHER_NOTICES + licences.OTHER_TEXT
    texts = []
    for i in range(300):  # parts of notices among other words
        w = rng.choice(notices).split()
        a, b = sorted(rng.integers(0, len(w) + 1, 2).tolist())
        texts.append(" ".join([prose(i, 3), *w[a : b + 1], prose(i + 7, 2)]))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = {}
    for i, t in enumerate(texts):
        x = licences._grams(t)
        x = x if set(x) & set(model.markers) else []
        z = {f: model.bias[f] + sum(model.weights[f].get(g, 0.0) for g in x) for f in model.bias}
        able = [f for f in z if round(1 / (1 + np.exp(-z[f])), 6) >= model.threshold[f]]
        if able:
            want[i] = min(able, key=lambda f: (f == licences.UNKNOWN, -z[f], f))
    got = {r.doc_id: r.families for r in licences.scan(df, model).collect() if r.families}
    assert got == want and len(want) > 60


def test_unknown_licences(spark, none):
    model = licences.train(none)
    texts = ["Licensed under the Sleepycat License, version 1.1.", "This software is released under the terms of the OpenSSL License.", "All rights reserved.", "The driver lost the license last year.", prose(4, 60)]
    df = spark.createDataFrame([(i, f"{prose(i, 20)}\n\n{t}\n\n{prose(9 + i, 20)}") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.families for r in licences.scan(df, model).collect()}
    assert got == {0: "unknown", 1: "unknown", 2: None, 3: None, 4: None}


def test_toxicity(spark, none):
    bad = ["gronk", "blarg", "snirt"]
    rows = []
    for i in range(400):
        toxic = i % 4 == 0
        w = prose(i, 60).split()
        if toxic:
            w[10:10] = [bad[i % 3]]
            w[30:30] = ["you", bad[(i + 1) % 3]]
        rows.append((i, " ".join(w), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").union(spark.createDataFrame([(5, None)], "doc_id long, toxic int"))
    model = toxicity.train(toxicity.labelled(df, labels))
    got = {r.doc_id: r for r in toxicity.score(df, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].predicted == rows[i][2] for i in held)
    odd = spark.createDataFrame([(1, None), (2, ""), (None, "x " * 50_000)], "doc_id long, text string")
    assert [r.predicted for r in toxicity.score(odd, model).collect()] == [0, 0, 0]
    blank = toxicity.train(toxicity.labelled(df, labels.where("toxic = 0")))
    assert toxicity.score(df, blank).where("predicted = 1").count() == 0
    assert toxicity.score(df.where("false"), model).count() == 0


def test_grammar_tags():
    lexicon = toxicity.Lexicon({"=clod": 2.0})
    tags = lambda t: {k for k, v in zip(toxicity.TAGS, lexicon.features(t)) if v > 0}
    assert tags("what a clod") == {"plain"} and tags("you clod") == {"aimed"} and tags("he is not a clod") == {"negated"}
    assert tags("she said clod") == {"reported"} and tags("they kill") == {"menace"} and tags("nothing here") == set()


@given(st.binary(max_size=700))
@settings(max_examples=40, deadline=None)
def test_wav_round_trip(data):
    assert audio.wav_samples(audio.wav(data)) == (data, audio.RATE)


def test_resample_keeps_a_tone():
    t = np.arange(4096) / audio.RATE
    x = np.sin(2 * np.pi * 440 * t).astype(np.float32)
    for up, down in ((1, 2), (5, 8), (3, 2)):
        y = audio.resample(x, up, down)
        want = np.sin(2 * np.pi * 440 * np.arange(len(y)) * down / up / audio.RATE)
        assert np.abs(y - want)[64:-64].max() < 0.02


def test_segments_by_hysteresis():
    e = np.array([0, 0, 0, 0, 5, 5, 3, 5, 5, 0, 0, 0, 0, 5, 0, 0], float)
    assert audio.segments(e, least=3).tolist() == [[4, 9]]


def test_audio_features(docs, none):
    rows, root = audio.audio_features(audio.media_column(docs))
    got = rows.collect()
    for r in got:
        t = {(i): (x or "").encode() for i, x, *_ in corpus()}[r.doc_id]
        p = t + b"\xff" * (max(576, -(-len(t) // 576) * 576) - len(t))
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(t), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
    assert len({r.feature for r in got if r.doc_id in (1, 2)}) == 1
    assert audio.audio_features(audio.media_column(none))[0].count() == 0
