"""Members are read alike wherever the reader's window ends."""

import random
import zlib

import pyarrow as pa

from gridloom.llm import warc


def test_a_window_may_end_at_any_byte_of_a_member(tmp_path):
    r = random.Random(3)
    words = ["".join(r.choices("abcdefghij", k=6)) for _ in range(300)]
    data, starts = b"", []
    for i in range(3):
        starts.append(len(data))
        gz = zlib.compressobj(3, zlib.DEFLATED, 31)
        data += gz.compress(warc._record("response", i, "http://a/", " ".join(r.choices(words, k=60)).encode(), "A", None)) + gz.flush()
    (tmp_path / "a").write_bytes(data)
    with pa.OSFile(str(tmp_path / "a")) as file:
        whole = [warc._member(warc._Window(file, len(data)), s, True) for s in starts]
        assert [w[1] for w in whole] == [*starts[1:], len(data)]
        for block in range(1, starts[1]):
            win = warc._Window(file, len(data), block)
            assert [warc._member(win, s, True) for s in starts] == whole, block


def test_what_is_no_record_is_still_none(tmp_path):
    for text in (b"", b"WARC", b"WARC/2.0 and more", b"other " * 50):
        gz = zlib.compressobj(3, zlib.DEFLATED, 31)
        (tmp_path / "b").write_bytes(data := gz.compress(text) + gz.flush())
        with pa.OSFile(str(tmp_path / "b")) as file:
            assert all(warc._member(warc._Window(file, len(data), block), 0, True) is None for block in range(1, len(data) + 1))
