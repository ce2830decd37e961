"""Region files through the table functions: round trips and faults."""

import gzip
import random
import struct
import zlib

from pyspark.sql import functions as F

from gridloom.sources import blocks


def test_round_trip_with_negative_places_and_full_sections(spark, tmp_path):
    r = random.Random(4)
    cells = {(r.randrange(-40, 40), r.randrange(-70, 70), r.randrange(-600, -500)): r.choice(["a", "b[x=1,y=2]", "c", *(f"d[n={i}]" for i in range(40))]) for _ in range(4000)}
    cells |= {(x, y, z): f"e[k={(x + 16 * y + 5 * z) % 300}]" for x in range(16) for y in range(16) for z in range(16)}  # no air, 9 bits
    cells |= {(x, y, z): "one" for x in range(16, 32) for y in range(16) for z in range(16)}  # one entry, no words
    table = spark.createDataFrame([(*k, v) for k, v in cells.items()], "x long, y int, z long, state string")
    sections = blocks.section_rows(blocks.write_regions(table, str(tmp_path / "r"))).cache()
    assert sections.where("error IS NOT NULL").count() == 0
    assert {(s.cx, s.cz, s.section): (s.bits, s.words is None) for s in sections.where("cz = 0").collect()} == {(0, 0, 0): (9, False), (1, 0, 0): (4, True)}
    assert {(b.x, b.y, b.z): b.state for b in blocks.block_rows(sections).collect()} == cells
    assert blocks.block_rows(sections, air=None).count() == 4096 * sections.count()


def _region(payloads: dict[int, tuple[int, bytes]], entries: dict[int, int] | None = None) -> bytes:
    header, body, sector = bytearray(8192), b"", 2
    for slot, (kind, packed) in payloads.items():
        raw = struct.pack(">IB", len(packed) + 1, kind) + packed
        count = -(-len(raw) // 4096)
        struct.pack_into(">I", header, 4 * slot, sector << 8 | count)
        struct.pack_into(">I", header, 4096 + 4 * slot, 1000 + slot)
        body += raw.ljust(count * 4096, b"\0")
        sector += count
    for slot, entry in (entries or {}).items():
        struct.pack_into(">I", header, 4 * slot, entry)
    return bytes(header) + body


def test_faults_are_rows(spark):
    def chunk(cx, palette, words):
        return blocks.chunk_tags(cx, 0, [(0, palette, words)])

    some = [0] * 256
    good = chunk(0, ["air", "x"], [1, *some[1:]])
    payloads = {
        0: (2, zlib.compress(good)),
        1: (1, gzip.compress(chunk(1, ["x"], []))),
        2: (3, chunk(2, ["air", "x"], [15, *some[1:]])),  # index 15 of two
        3: (2, zlib.compress(chunk(3, [], some))),
        4: (2, zlib.compress(chunk(4, ["air", "x"], []))),
        5: (2, zlib.compress(chunk(5, ["air", "x"], some[:-1]))),
        6: (2, zlib.compress(good)),
        7: (7, b"abc"),
        8: (2, zlib.compress(good)[:-9]),
        9: (2, zlib.compress(good[:60])),
        10: (2, zlib.compress(b"\x0a\x00\x00\x63")),
    }
    content = _region(payloads, {20: 2 << 8 | 1, 21: 5000 << 8 | 1, 22: 1 << 8 | 1})
    files = spark.createDataFrame([(0, 0, bytearray(content)), (1, 0, bytearray(content[:9000])), (2, 0, bytearray())], "rx long, rz long, content binary")
    sections = blocks.section_rows(files)
    found = {(s.rx, s.slot): s.error for s in sections.collect()}
    assert found == {
        (0, 0): None, (0, 1): None, (0, 2): None, (0, 3): "empty_palette", (0, 4): "no_words", (0, 5): "word_count", (0, 6): "misplaced", (0, 7): "unknown_compression",
        (0, 8): "broken_payload", (0, 9): "broken_tags", (0, 10): "broken_tags", (0, 20): "overlapping_sectors", (0, 21): "outside_file", (0, 22): "outside_file", (1, None): "bad_file_length",
    }
    rows = blocks.block_rows(sections, air="air")
    assert [(b.x, b.y, b.z, b.state) for b in rows.where("error IS NULL AND state = 'x' AND x < 16").collect()] == [(0, 0, 0, "x")]
    assert rows.where("x >= 16 AND x < 32 AND state = 'x'").count() == 4096
    assert [(b.x, b.error) for b in rows.where("error IS NOT NULL").collect()] == [(32, "index_outside_palette")]


def test_table_functions_in_sql(spark):
    blocks.register(spark)
    content = _region({3: (2, zlib.compress(blocks.chunk_tags(3, 0, [(-4, ["air", "x[a=b]"], [1] + [0] * 255)])))})
    spark.createDataFrame([(bytearray(content),)], "content binary").createOrReplaceTempView("files")
    row = spark.sql("SELECT c.slot, c.stamp, s.* FROM files, LATERAL region_chunks(content) c, LATERAL chunk_sections(c.payload, c.compression) s").collect()
    assert [(r.slot, r.stamp, r.cx, r.section, r.palette[1]["name"], r.palette[1]["properties"], len(r.words)) for r in row] == [(3, 1003, 3, -4, "x", {"a": "b"}, 256)]
    assert spark.range(1).select(blocks.palette_bits(F.lit(17))).first()[0] == 5
