"""Operators 11 to 13 against the sentencepiece library, plain prefix counting and exhaustive search."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridloom.llm.conversation_repair import GOES, TRUNCATED, cheapest, damage, repair, structure
from gridloom.llm.piece_ids import PieceEncoder, piece_ids
from gridloom.llm.prefix_trie import prefix_trie, shared_openings, turns_in_order
from gridloom.llm.queries import PIECE_BPE, vocabulary

DOCS = "doc_id long, text string"
TURNS = "conv_id long, turn long, role string, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11 ---


@pytest.fixture(scope="module")
def pieces():
    return PieceEncoder(vocabulary(PIECE_BPE), entries=500)


def test_piece_ids_equal_the_library(pieces):
    r = random.Random(7)
    parts = list("abcdeé .,;\n\t▁  0123456789ß中文日本🙂\u0000　'\"-_=(){}ABC") + ["<s>", "</s>", "<0x0A>", "<unk>", " the", "ing", "    ", "ﷺ", "\U0010ffff", "word.", "end!\n"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(0, 90))) for _ in range(3000)]
    texts += ["a" * 6000, " " * 3000, "▁" * 99, "ab" * 4000, "中" * 999, " lead", "trail ", "\n", ""]
    for begin in range(0, len(texts), 500):
        some = texts[begin : begin + 500]
        ids = pieces.encode(some)
        assert [i.tolist() for i in ids] == pieces.vocabulary.library.encode(some)
        assert pieces.decode(ids) == [t.replace("▁", " ") for t in some]


def test_short_and_long_agendas_agree(pieces):
    r = random.Random(8)
    units = ["".join(r.choice("▁thequickbrownfx0.,中é") for _ in range(r.randrange(1, 40))) for _ in range(2000)]
    short = pieces.units(units)
    heaps = PieceEncoder(vocabulary(PIECE_BPE), short=0)
    assert heaps.units(units) == short


def test_piece_ids_rows(spark):
    docs = spark.createDataFrame([(1, "Hello  world.\n"), (1, "Hello  world.\n"), (None, "x"), (3, None), (4, ""), (5, "long " * 300_000)], DOCS).withColumn("ids", F.lit("clash")).withColumn("decoded", F.lit(1))
    rows = piece_ids(docs, vocabulary(PIECE_BPE), group_chars=1000).collect()
    library = PieceEncoder(vocabulary(PIECE_BPE)).vocabulary.library
    want = sorted((r["doc_id"] or -1, tuple(library.encode(r["text"] or "")), r["text"] or "") for r in docs.collect())
    assert sorted((r["doc_id"] or -1, tuple(r["ids"]), r["decoded"]) for r in rows) == want
    digests = piece_ids(docs, vocabulary(PIECE_BPE), digest_only=True).collect()
    assert sorted((r["doc_id"] or -1, r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in digests) == sorted((d, len(i), sha(",".join(map(str, i))), sha(t)) for d, i, t in want)
    assert piece_ids(docs.limit(0), vocabulary(PIECE_BPE)).count() == 0


def test_a_difference_from_the_library_is_an_error(pieces):
    broken = PieceEncoder(vocabulary(PIECE_BPE))
    broken.vocabulary.ranks = broken.vocabulary.ranks[::-1].copy()
    with pytest.raises(ValueError):
        broken.encode(["several ordinary words of a sentence"])


# --- 12 ---


def plain_trie(rows) -> set:
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in built.items():
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = set()
    for path, who in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        children = sum(len(q) == len(path) + 1 for q in below)
        out.add((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), children, len(leaves), saved, sha(",".join(map(str, sorted(ends[path]))))))
    return out


def trie_rows(spark, rows) -> set:
    turns = turns_in_order(spark.createDataFrame(rows, TURNS).withColumn("pos", F.lit("clash")).withColumn("x", F.lit(1)))
    found = prefix_trie(shared_openings(turns), turns.where("pos = 1").select("conv_id")).collect()
    assert len(found) == len({tuple(r) for r in found})
    return {tuple(r) for r in found}


def test_prefix_trie_equals_plain_counting(spark):
    r = random.Random(12)
    rows = []
    for c in [*range(-7, 60), *range(1000, 1030)]:
        for turn in range(r.randrange(0, 14)):
            rows.append((c, turn, r.choice(["user", "assistant"]), r.choice("abé") * r.randrange(1, 3)))
    rows += [(200 + k, t, "user", "copy") for k in range(40) for t in range(9)]  # copies
    rows += [(300, t, "user", f"turn {t % 7} " * 20) for t in range(150)]  # very long
    rows += [(301, t, "user", f"turn {t % 7} " * 20) for t in range(130)]
    rows += [(400, None, None, None), (400, None, "user", "b"), (400, 3, "user", "b"), (400, 3, "user", "b"), (None, 0, "user", "left out"), (405, 0, "x" * 5000, "y" * 90_000)]
    r.shuffle(rows)
    assert trie_rows(spark, rows) == plain_trie(rows)


def test_prefix_trie_of_nothing(spark):
    assert trie_rows(spark, []) == set()
    alone = [(9, 0, "user", "all turns go")]
    assert trie_rows(spark, alone) == plain_trie(alone)


# --- 13 ---


def exhaustive(rows) -> tuple[int, str]:
    found = []

    def go(i, roles, cost, edits, inserted):
        if cost > 3 * len(rows):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, edits))
        if inserted < 3:
            for r in "ua":
                go(i, roles + r, cost + 2, edits + "I", inserted + 1)
        if i < len(rows):
            initial, fault = rows[i]
            go(i + 1, roles, cost + 3, edits + "D", 0)
            if fault != GOES:
                more = int(fault == TRUNCATED)
                go(i + 1, roles + initial, cost + more, edits + "K", 0)
                for r in "ua":
                    go(i + 1, roles + r, cost + 2 + more, edits + "R", 0)

    go(0, "", 0, "", 0)
    return min(found)


def test_cheapest_edits_equal_exhaustive_search():
    kinds = list(itertools.product(["s", "u", "a", "x", ""], range(3)))
    for n in range(3):
        for rows in itertools.product(kinds, repeat=n):
            assert cheapest(list(rows)) == exhaustive(rows), rows
    r = random.Random(13)
    for n in [3] * 120 + [4] * 40:
        rows = [r.choice(kinds) for _ in range(n)]
        assert cheapest(rows) == exhaustive(rows), rows


def test_prices_of_blocks_agree():
    from gridloom.llm.conversation_repair import auction

    r = random.Random(14)
    for _ in range(20):
        rows = [(r.choice("suax"), r.choice([0, 0, 1, 2])) for _ in range(r.randrange(1, 90))]
        assert len({auction(rows, block)[0][0] for block in (1, 3, 16, 1000)}) == 1


def plain_report(rows) -> tuple:
    """rows (turn, role, text) in order -> the report and the repaired text's digest, from the exhaustive edits."""
    blank = duplicate = cut = 0
    seen, shape = set(), []
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        fault = "b" if not body else "d" if (role, text) in seen else "t" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        blank, duplicate, cut = blank + (fault == "b"), duplicate + (fault == "d"), cut + (fault == "t")
        shape.append((role[:1], GOES if fault in ("b", "d") else TRUNCATED if fault else 0))
    initials = [s[0] for s in shape]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    cost, audit = exhaustive(shape)
    lines, left, put = [], list(rows), 0
    for edit in audit:
        row = left.pop(0) if edit != "I" else (None, "", "")
        if edit == "K":
            lines.append(f"{row[1]}:{row[2]}")
            put += row[1][:1] in ("u", "a")
        elif edit in "RI":
            lines.append(("user" if put % 2 == 0 else "assistant") + ":" + row[2])
            put += 1
    return gaps, blank, duplicate, cut, illegal, cost, audit, sha("\n".join(lines))


def test_repair_equals_a_plain_version(spark):
    r = random.Random(15)
    rows, want = [], {}
    for c in range(60):
        ours = sorted((t, r.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "unknown"]), r.choice(["One. Two!", "cut off", "", " \t\n", "same.", "é?", "Done. "])) for t in r.sample(range(9), r.randrange(1, 6)))
        ours += [ours[-1]] * (c % 7 == 0)
        want[c] = plain_report(ours)
        rows += [(c, *x) for x in ours]
    r.shuffle(rows)
    table = spark.createDataFrame(rows, TURNS).withColumn("present", F.lit(True)).withColumn("audit", F.lit("clash")).withColumn("digest", F.lit(1))
    assert {r["conv_id"]: tuple(r)[1:] for r in repair(table, digest_only=True).collect()} == want
    turns = defaultdict(dict)
    for x in repair(table).collect():
        turns[x["conv_id"]][x["position"]] = f"{x['role']}:{x['text']}"
    assert {c: sha("\n".join(t for _, t in sorted(turns[c].items()))) for c in want} == {c: w[-1] for c, w in want.items()}


def test_damage_and_edge_rows(spark):
    def code(c, t):
        return zlib.crc32(f"{c}:{t}".encode()) % 20

    turn = {k: next(t for t in range(999) if code(1, t) == k) for k in range(6)}
    table = spark.createDataFrame([(1, turn[0], "user", "gone."), (1, turn[1], "user", "emptied."), (1, turn[2], "assistant", "a.b!c?"), (1, turn[3], None, None), (1, turn[4], "assistant", "x."), (1, turn[5], "tool", "y.")], TURNS).withColumn("code", F.lit("clash"))
    kept = {(r["turn"], r["role"], r["text"]) for r in damage(table).where("present").collect()}
    assert kept == {(turn[1], "user", ""), (turn[2], "assistant", "abc"), (turn[3], " ", " "), (turn[4], "user", "x."), (turn[5], "tool", "y.")}
    assert damage(table).where("present").count() == 6  # the repeated row stands twice
    gone = repair(damage(table.where(F.col("turn") == turn[0])), digest_only=True).collect()
    assert [tuple(r) for r in gone] == [(1, 0, 0, 0, 0, 0, 0, "", sha(""))]
    assert repair(damage(table.limit(0)), digest_only=True).count() == 0


def test_long_conversations_null_ids_and_texts(spark):
    rows = [(None, t, "user" if t % 2 == 0 else "assistant", f"row {t}.") for t in range(3000)] + [(7, None, "user", "long " * 200_000), (7, None, "user", "long " * 200_000)]
    found = {r["conv_id"]: r for r in structure(spark.createDataFrame(rows, TURNS).withColumn("present", F.lit(True))).collect()}
    assert (found[None]["cost"], found[None]["audit"]) == (0, "K" * 3000)
    assert (found[7]["duplicate"], found[7]["truncated"], found[7]["gaps"], found[7]["cost"], found[7]["audit"]) == (1, 1, 0, 6, "DD")
