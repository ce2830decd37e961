"""The token cache: words of a large vocabulary are encoded once."""

from gridloom.llm.queries import BYTE_BPE, vocabulary
from gridloom.llm.tokens import Encoder


def test_300_000_words_stay_in_the_byte_cache(monkeypatch):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [letters[i % 26] + letters[i // 26 % 26] + letters[i // 676 % 26] + letters[i // 17576 % 26] for i in range(300_000)]
    texts = [" " + " ".join(words[i : i + 1000]) for i in range(0, 300_000, 1000)]
    enc = Encoder(vocabulary(BYTE_BPE), "byte")
    first = enc.encode(texts)
    fresh, asked = enc._fresh, []
    monkeypatch.setattr(enc, "_fresh", lambda pieces: asked.extend(pieces) or fresh(pieces))
    assert enc.encode(texts) == first
    assert not asked
