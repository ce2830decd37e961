"""SentencePiece ids of whole texts for merge-type (BPE) vocabularies: a score-ordered agenda of adjacent symbol pairs.

A text becomes symbols (its characters, with U+2581 for each space and one in front); the pair of neighbours whose joined
piece has the best score, the leftmost of equals, is joined until no pair is a piece; characters without a piece become byte
pieces. Pairs never join across a boundary that lies inside no piece of the vocabulary, so a text falls into units (a word
with the spaces before it) that are encoded once each. Many short units share one agenda in numpy, whose rounds take the top
pair of every unit; long units have a heap each, so that time stays n log n.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import tidy, tune

SPACE = "▁"
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = ".,;:!?\n"
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_FAR = np.int64(1) << 40


class PieceVocabulary:
    """The pieces of a model file, their pair table and the library's own processor beside them."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        trained, normal = proto.trainer_spec, proto.normalizer_spec
        kinds = {p.type for p in proto.pieces}
        if trained.model_type != 2 or not trained.byte_fallback or trained.treat_whitespace_as_suffix or normal.precompiled_charsmap or normal.remove_extra_whitespaces or not normal.add_dummy_prefix or kinds - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("only merge-type models with byte fallback, an identity normaliser and a leading space are encoded here")
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == _NORMAL}
        self.bytes_at = np.array([i for i, p in enumerate(proto.pieces) if p.type == _BYTE], np.int64)
        singles = {p for p in pieces if len(p) == 1}
        codes = dict(pieces)  # characters that are no piece but begin or end one get codes beyond the ids
        self.size = len(proto.pieces)
        for c in sorted({c for p in pieces for c in (p[0], p[-1])} - singles):
            codes[c] = self.size + len(codes) - len(pieces)
        scores = sorted({proto.pieces[i].score for i in pieces.values()}, reverse=True)
        rank_of = {s: k for k, s in enumerate(scores)}
        self.codes = max(codes.values()) + 1
        table = [
            (codes[p[:k]] * self.codes + codes[p[k:]], rank_of[proto.pieces[i].score], i)
            for p, i in pieces.items()
            for k in range(1, len(p))
            if p[:k] in codes and p[k:] in codes
        ]
        found = np.array(sorted(table), np.int64).reshape(-1, 3)
        self.pairs, self.ranks, self.joined = (np.ascontiguousarray(found[:, k]) for k in range(3))
        self.by_pair = None
        self.of_char = np.full(0x110000, -1, np.int64)
        for p, c in codes.items():
            if len(p) == 1:
                self.of_char[ord(p)] = c
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            self.units = re.compile("(?s).+")
        else:  # units end before spaces, and where a letter meets a mark that stands beside a letter in no piece
            marks = "".join(re.escape(m) for m in _MARKS if not any(re.search(f"[{_LETTERS}]{re.escape(m)}|{re.escape(m)}[{_LETTERS}]", p) for p in pieces))
            by_marks = f"{SPACE}*[{_LETTERS}]+(?=[{marks}{SPACE}]|\\Z)|(?<=[{_LETTERS}])[{marks}]+(?=[{_LETTERS}{SPACE}]|\\Z)|" if marks else ""
            self.units = re.compile(f"{by_marks}{SPACE}*[^{SPACE}]+|{SPACE}+")

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Where each pair of codes stands in the pair table; -1 where it is no piece."""
        keys = np.where((left < 0) | (right < 0), -1, left * self.codes + right)
        at = np.searchsorted(self.pairs, keys)
        at[at == len(self.pairs)] = 0
        return np.where(self.pairs[at] == keys, at, -1) if len(self.pairs) else np.full(len(keys), -1)


class PieceEncoder:
    """texts -> ids. The cache of units is bounded by `entries`; units of more than `short` symbols have a heap of their own.

    Null and empty texts have no ids. Every unit that is not in the cache is checked against the library, and so is one whole
    text in `every` of a batch; a difference is an error.
    """

    def __init__(self, path: str, entries: int = 600_000, short: int = 48, longest: int = 40, every: int = 64):
        self.vocabulary = PieceVocabulary(path)
        self.cache: dict[str, bytes] = {}
        self.entries, self.short, self.longest, self.every = entries, short, longest, every

    def _long(self, symbols: list[int]) -> list[int]:
        """One unit, with a heap: entries that a later join made stale are known by the codes they were pushed with."""
        v = self.vocabulary
        if v.by_pair is None:
            v.by_pair = dict(zip(v.pairs.tolist(), zip(v.ranks.tolist(), v.joined.tolist())))
        n = len(symbols)
        before, after, alive = list(range(-1, n - 1)), [*range(1, n), -1], [True] * n
        agenda: list[tuple[int, int, int, int, int, int]] = []

        def push(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and symbols[i] >= 0 and symbols[j] >= 0:
                hit = v.by_pair.get(symbols[i] * v.codes + symbols[j])
                if hit:
                    heapq.heappush(agenda, (hit[0], i, j, symbols[i], symbols[j], hit[1]))

        for i in range(n - 1):
            push(i, i + 1)
        while agenda:
            _, i, j, left, right, joined = heapq.heappop(agenda)
            if alive[i] and alive[j] and after[i] == j and symbols[i] == left and symbols[j] == right:
                symbols[i], alive[j], after[i] = joined, False, after[j]
                if after[i] >= 0:
                    before[after[i]] = i
                push(before[i], i)
                push(i, after[i])
        return [s for s, a in zip(symbols, alive) if a]

    def _short(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Many units at once: a round joins the best pair of each unit, leftmost of equals, and finished units leave the agenda."""
        v = self.vocabulary
        done: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        names = np.arange(len(sizes))
        starts = np.cumsum(sizes) - sizes
        at = np.full(len(symbols), -1)
        at[:-1] = v.look_up(symbols[:-1], symbols[1:])
        at[np.cumsum(sizes) - 1] = -1  # no pair reaches into the next unit
        while len(names):
            order = np.where(at >= 0, v.ranks[at], _FAR) * (1 << 22) + np.arange(len(at))
            best = np.minimum.reduceat(order, starts)
            going = best < _FAR * (1 << 22)
            if not going.all():
                stays = np.repeat(going, sizes)
                done.append((names[~going], sizes[~going], symbols[~stays]))
                shift = np.cumsum(stays) - 1
                symbols, at = symbols[stays], at[stays]
                names, sizes, best = names[going], sizes[going], best[going]
                if not len(names):
                    break
                here = shift[best & ((1 << 22) - 1)]
            else:
                here = best & ((1 << 22) - 1)
            symbols[here] = v.joined[at[here]]
            keep = np.ones(len(symbols), bool)
            keep[here + 1] = False
            ends = np.cumsum(sizes) - 1
            at[here] = -1
            symbols, at = symbols[keep], at[keep]
            here = here - np.arange(len(here))  # each earlier unit lost one symbol
            sizes = sizes - 1
            ends = np.cumsum(sizes) - 1
            starts = ends - sizes + 1
            right = here[here < ends]
            at[right] = v.look_up(symbols[right], symbols[right + 1])
            left = here[here > starts]
            at[left - 1] = v.look_up(symbols[left - 1], symbols[left])
        units = np.concatenate([d[0] for d in done])
        lengths = np.concatenate([d[1] for d in done])
        flat = np.concatenate([d[2] for d in done])
        order = np.argsort(units, kind="stable")
        first = np.cumsum(lengths) - lengths
        sizes = lengths[order]
        take = np.repeat(first[order] - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(flat))
        return flat[take], sizes

    def _spell(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols -> ids: characters that are no piece of their own give the pieces of their UTF-8 bytes."""
        v = self.vocabulary
        odd = np.flatnonzero((symbols < 0) | (symbols >= v.size))
        if not len(odd):
            return symbols, sizes
        spelled = {int(s): v.bytes_at[np.frombuffer(self._char(int(s)).encode(), np.uint8)] for s in np.unique(symbols[odd])}
        width = np.ones(len(symbols), np.int64)
        width[odd] = [len(spelled[s]) for s in symbols[odd].tolist()]
        ids = np.repeat(symbols, width)
        first = np.cumsum(width) - width
        for i in odd.tolist():
            ids[first[i] : first[i] + width[i]] = spelled[int(symbols[i])]
        return ids, np.add.reduceat(width, np.cumsum(sizes) - sizes)

    def _char(self, symbol: int) -> str:
        return chr(-symbol - 1) if symbol < 0 else chr(int(np.flatnonzero(self.vocabulary.of_char == symbol)[0]))

    def units(self, units: list[str]) -> list[bytes]:
        """The ids of each unit, none of them empty, as little-endian unsigned 32-bit bytes."""
        out: list[bytes] = [b""] * len(units)
        for long in (False, True):
            which = [k for k, u in enumerate(units) if (len(u) > self.short) == long]
            for begin in range(0, len(which), 50_000):
                some = which[begin : begin + 50_000]
                points = np.frombuffer("".join(map(units.__getitem__, some)).encode("utf-32-le"), "<u4").astype(np.int64)
                symbols = self.vocabulary.of_char[points]
                symbols = np.where(symbols < 0, -points - 1, symbols)
                sizes = np.array([len(units[k]) for k in some], np.int64)
                if long:
                    joined = [self._long(symbols[e - n : e].tolist()) for n, e in zip(sizes.tolist(), np.cumsum(sizes).tolist())]
                    symbols, sizes = np.array([s for j in joined for s in j], np.int64), np.array([len(j) for j in joined], np.int64)
                else:
                    symbols, sizes = self._short(symbols, sizes)
                ids, sizes = self._spell(symbols, sizes)
                data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(sizes)).tolist()
                for k, a, b in zip(some, [0, *ends], ends):
                    out[k] = data[a:b]
        return out

    def _checked(self, fresh: list[str]) -> dict[str, bytes]:
        """The ids of units, compared with the library's for a text that holds them a line each (no piece holds a line feed)."""
        found = dict(zip(fresh, self.units(fresh)))
        line = self.units(["\n"])[0]
        for begin in range(0, len(fresh), 4096):
            some = fresh[begin : begin + 4096]
            theirs = self.vocabulary.library.encode("\n" + "\n".join(some).replace(SPACE, " "))
            ours = self.units([SPACE])[0] + b"".join(line + found[u] for u in some)
            if np.array(theirs, "<u4").tobytes() != ours:
                raise ValueError("ids of units differ from the library's")
        return found

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        find, cache = self.vocabulary.units.findall, self.cache
        lists = [find(SPACE + t.replace(" ", SPACE)) if t else [] for t in texts]
        fresh = self._checked(list(set().union(*lists).difference(cache))) if lists else {}
        full = len(cache) + len(fresh) > self.entries  # early units are the common ones; later ones then come and go
        cache.update(fresh)
        out = [np.frombuffer(b"".join(map(cache.__getitem__, units)), "<u4") for units in lists]
        for u in fresh if full else [u for u in fresh if len(u) > self.longest]:
            del cache[u]
        for k in range(0, len(texts), self.every):
            if out[k].tolist() != self.vocabulary.library.encode(texts[k] or "", num_threads=1):
                raise ValueError("ids of a text differ from the library's")
        return out

    def decode(self, ids: list[np.ndarray]) -> list[str]:
        return self.vocabulary.library.decode([i.tolist() for i in ids], num_threads=1) if ids else []


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One per worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


def piece_ids(docs: DataFrame, path: str, digest_only: bool = False, group_chars: int = 1_000_000) -> DataFrame:
    """Rows of docs (doc_id, text) -> doc_id, ids array<int>, decoded string; with digest_only the ids' and the decoded text's digests instead.

    Each row stands for itself: repeated rows and ids give repeated rows, a null id stays null, null and empty texts have no
    ids and an empty decoded text, other columns are left out whatever their names, an empty table gives an empty one. Texts
    are encoded whole; a task holds about `group_chars` characters of them at a time, or one text that is longer.
    """
    tune(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ("n_tokens long, ids_sha256 string, decoded_sha256 string" if digest_only else "ids array<int>, decoded string")

    @tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        decimals = [str(i) for i in range(e.vocabulary.size)]
        for batch in batches:
            texts = batch.column(1).to_pylist()
            begin = 0
            while begin < len(texts):
                end, chars = begin, 0
                while end < len(texts) and chars < group_chars:
                    chars += len(texts[end] or "")
                    end += 1
                ids = e.encode(texts[begin:end])
                decoded = e.decode(ids)
                keys = batch.column(0).slice(begin, end - begin)
                if digest_only:
                    columns = [
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(",".join(map(decimals.__getitem__, i.tolist())).encode()).hexdigest() for i in ids], pa.string()),
                        pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays([keys, *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                    flat = pa.array(np.concatenate(ids).astype(np.int32) if ids else [], pa.int32())
                    yield pa.RecordBatch.from_arrays([keys, pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(decoded, pa.string())], ["doc_id", "ids", "decoded"])
                begin = end

    return docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, schema)
