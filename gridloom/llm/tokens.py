"""Token ids of whole texts, by the tokenizers library, with a cache over the pieces that its pre-tokenizer never joins."""

from __future__ import annotations

import os
import re

import numpy as np

#: The Unicode property White_Space, which the tokenizers' patterns mean by \s (Python's \s also has U+001C to U+001F).
_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters in any Unicode version; a run of them that one of _AFTER or the end follows is a piece of its own in both tokenizers.
_LETTERS, _AFTER = "A-Za-zÀ-ÖØ-öø-ÿ", f"(?=[{_SPACE},.;:!?]|$)"
#: Where a tokenizer's pre-tokenizer always cuts: byte-level ones keep one leading space with a word, word-end ones drop white space.
PIECES = {
    "byte": re.compile(f" ?[{_LETTERS}]+{_AFTER}| ?[^{_SPACE}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"),
    "word": re.compile(f"[{_LETTERS}]+{_AFTER}|[^{_SPACE}]+"),
}
#: Plain words; many of them are encoded as one text, whose ids fall apart again where a token begins or ends a word.
_PLAIN = {"byte": re.compile(f" [{_LETTERS}]+"), "word": re.compile(f"[{_LETTERS}]+")}
_BREAK = {"byte": "\u0120", "word": "</w>"}
END_ID = 2
#: Cached pieces, some 100 bytes each, so at most 100 MB or so a worker; pieces beyond these are encoded again where they come up.
ENTRIES = {"byte": 1_000_000, "word": 1_000_000}
_encoders: dict[tuple[str, str], "Encoder"] = {}


class Encoder:
    """texts -> ids as little-endian unsigned 32-bit bytes, equal to Tokenizer.encode(text, add_special_tokens=False).

    A text that holds a special token's string is encoded whole, as such tokens cut the text before the pre-tokenizer.
    Null and empty texts have no ids. The cache is bounded: `entries` pieces of at most `longest` characters.
    """

    def __init__(self, path: str, kind: str, entries: int | None = None, longest: int = 40, group_chars: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = self.words = Tokenizer.from_file(path)
        if kind == "word":  # plain words with a space between them need none of the file's patterns, only its lower case, bytes and merges
            self.words = Tokenizer.from_file(path)
            self.words.normalizer = normalizers.Lowercase()
            self.words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.pieces, self.plain, self.kind, self.entries, self.longest, self.group_chars = PIECES[kind], _PLAIN[kind].fullmatch, kind, entries or ENTRIES[kind], longest, group_chars
        self.cache: dict[str, bytes] = {}
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.breaks = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.breaks[i] = token.startswith(_BREAK[kind]) if kind == "byte" else token.endswith(_BREAK[kind])

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _fresh(self, pieces: set[str]) -> dict[str, bytes]:
        plain = list(filter(self.plain, pieces))
        rest = list(pieces.difference(plain))
        found = {p: np.array(e.ids, "<u4").tobytes() for p, e in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))}
        if plain:
            ids = np.array(self.words.encode_batch_fast([("" if self.kind == "byte" else " ").join(plain)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.breaks[ids])
            if len(cuts) != len(plain):
                raise ValueError("the tokenizer joined words that were expected to stay apart")
            data = ids.tobytes()
            at = [*cuts.tolist(), len(ids)] if self.kind == "byte" else [0, *(cuts + 1).tolist()]
            found.update((p, data[4 * a : 4 * b]) for p, a, b in zip(plain, at, at[1:]))
        return found

    def _group(self, texts: list[str]) -> list[bytes]:
        lists = [self.pieces.findall(t) for t in texts]
        cache = self.cache
        fresh = self._fresh(set().union(*lists).difference(cache))
        full = len(cache) + len(fresh) > self.entries  # early words are the common ones; later ones then come and go
        cache.update(fresh)
        out = [b"".join(map(cache.__getitem__, pieces)) for pieces in lists]
        for p in fresh if full else [p for p in fresh if len(p) > self.longest]:
            del cache[p]
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes | None] = [None] * len(texts)
        group: list[int] = []
        chars = 0
        for k, text in enumerate(texts):
            if not text:
                out[k] = b""
            elif any(s in text for s in self.special):
                out[k] = np.array(self._ids(text), "<u4").tobytes()
            else:
                group.append(k)
                chars += len(text)
                if chars >= self.group_chars:
                    for g, ids in zip(group, self._group([texts[g] for g in group])):
                        out[g] = ids
                    group, chars = [], 0
        for g, ids in zip(group, self._group([texts[g] for g in group]) if group else ()):
            out[g] = ids
        return out


def encoder(path: str, kind: str) -> Encoder:
    """One per worker process, kept from task to task."""
    if (path, kind) not in _encoders:
        _encoders[path, kind] = Encoder(path, kind)
    return _encoders[path, kind]
