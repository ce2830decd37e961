"""Region files of block chunks: table functions region -> chunks -> sections, and the block rows that Spark unpacks from them.

A region's header and a chunk's tags are read by two small Python table functions, used with LATERAL (or lateralJoin); palette
indices are unpacked, and rows made, by Spark's own functions. Whatever breaks a rule is a row with an `error`.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from gridloom.functions.attributes import state_key
from gridloom.functions.keys import packed_part, unpack_index
from gridloom.sources.readers import inflate

SECTOR, HEADER, SLOTS, SECTION = 4096, 8192, 1024, 4096
#: Numbers of the tag format by their type code, big-endian; arrays have the code of their elements.
NUMBERS = {1: ">b", 2: ">h", 3: ">i", 4: ">q", 5: ">f", 6: ">d"}
ARRAYS = {7: ">i1", 11: ">i4", 12: ">i8"}


class _Tags:
    """A cursor over tag bytes."""

    def __init__(self, raw: bytes):
        self.raw, self.at = raw, 0

    def number(self, form: str):
        value = struct.unpack_from(form, self.raw, self.at)[0]
        self.at += struct.calcsize(form)
        return value

    def text(self) -> str:
        n = self.number(">H")
        self.at += n
        if self.at > len(self.raw):
            raise ValueError("text beyond the end")
        return self.raw[self.at - n : self.at].decode()

    def value(self, kind: int):
        if kind in NUMBERS:
            return self.number(NUMBERS[kind])
        if kind == 8:
            return self.text()
        if kind in ARRAYS:
            n = self.number(">i")
            found = np.frombuffer(self.raw, ARRAYS[kind], n, self.at)
            self.at += found.nbytes
            return found
        if kind == 9:
            inner, n = self.number(">b"), self.number(">i")
            return [self.value(inner) for _ in range(n)]
        if kind == 10:
            found = {}
            while inner := self.number(">b"):
                name = self.text()
                found[name] = self.value(inner)
            return found
        raise ValueError(f"tag type {kind}")


def read_tags(raw: bytes) -> dict:
    """The root compound of a chunk."""
    tags = _Tags(raw)
    if tags.number(">b") != 10:
        raise ValueError("no compound")
    tags.text()
    return tags.value(10)


def _named(kind: int, name: str, body: bytes) -> bytes:
    return struct.pack(">bH", kind, len(name.encode())) + name.encode() + body


def _compound(*parts: bytes) -> bytes:
    return b"".join(parts) + b"\0"


def _list(kind: int, items: list[bytes]) -> bytes:
    return struct.pack(">bi", kind, len(items)) + b"".join(items)


def _text(value: str) -> bytes:
    return struct.pack(">H", len(value.encode())) + value.encode()


def chunk_tags(cx: int, cz: int, sections: list[tuple[int, list[str], list[int]]]) -> bytes:
    """The fixture's writer: a chunk with its place and, per section, the palette (`name[key=value,...]`) and the packed words."""

    def state(key: str) -> bytes:
        name, _, rest = key.rstrip("]").partition("[")
        parts = [_named(8, "Name", _text(name))]
        if rest:
            parts.append(_named(10, "Properties", _compound(*(_named(8, k, _text(v)) for k, v in (p.split("=") for p in rest.split(","))))))
        return _compound(*parts)

    def section(y: int, palette: list[str], words: list[int]) -> bytes:
        data = [_named(12, "data", struct.pack(f">i{len(words)}q", len(words), *words))] if words else []
        return _compound(_named(1, "Y", struct.pack(">b", y)), _named(10, "block_states", _compound(_named(9, "palette", _list(10, [state(k) for k in palette])), *data)))

    return _named(10, "", _compound(_named(3, "xPos", struct.pack(">i", cx)), _named(3, "zPos", struct.pack(">i", cz)), _named(9, "sections", _list(10, [section(*s) for s in sections]))))


@udtf(returnType="slot int, stamp int, compression int, payload binary, error string")
class RegionChunks:
    """content binary -> a row per used slot of its header: time stamp, compression and compressed payload, or an error."""

    def eval(self, content: bytes) -> Iterator[tuple]:
        if not content:
            return
        if len(content) < HEADER or len(content) % SECTOR:
            yield None, None, None, None, "bad_file_length"
            return
        entries, stamps = np.frombuffer(content, ">u4", SLOTS), np.frombuffer(content, ">u4", SLOTS, SECTOR)
        used: set[int] = set()
        for slot in np.flatnonzero(entries).tolist():
            first, count = int(entries[slot]) >> 8, int(entries[slot]) & 255
            span = range(first, first + count)
            if first < 2 or not count or (first + count) * SECTOR > len(content):
                yield slot, int(stamps[slot]), None, None, "outside_file"
            elif used.intersection(span):
                yield slot, int(stamps[slot]), None, None, "overlapping_sectors"
            else:
                length, kind = struct.unpack_from(">IB", content, first * SECTOR)
                fits = 1 < length <= count * SECTOR - 4
                yield slot, int(stamps[slot]), kind, content[first * SECTOR + 5 : first * SECTOR + 4 + length] if fits else None, None if fits else "bad_length"
            used.update(span)


@udtf(returnType="cx int, cz int, section int, palette array<struct<name:string,properties:map<string,string>>>, words array<bigint>, error string")
class ChunkSections:
    """(payload, compression) -> a row per section with its palette and packed words; a chunk that can't be read is one error row, no payload a row of nulls."""

    def eval(self, payload: bytes, compression: int) -> Iterator[tuple]:
        if payload is None:  # the slot's own fault stays a row
            yield (None,) * 6
            return
        if compression not in (1, 2, 3):
            yield None, None, None, None, None, "unknown_compression"
            return
        try:
            root = read_tags(inflate(payload, compression))
            rows = []
            for s in root["sections"]:
                states = s.get("block_states", {})
                palette = [(p["Name"], p.get("Properties", {})) for p in states.get("palette", [])]
                words = states.get("data")
                rows.append((root["xPos"], root["zPos"], s["Y"], palette, None if words is None else words.tolist(), None))
            yield from rows
        except (zlib.error, EOFError, OSError):
            yield None, None, None, None, None, "broken_payload"
        except (struct.error, ValueError, KeyError, TypeError, AttributeError):
            yield None, None, None, None, None, "broken_tags"


def register(spark: SparkSession) -> None:
    """region_chunks(content) and chunk_sections(payload, compression), for SQL with LATERAL."""
    spark.udtf.register("region_chunks", RegionChunks)
    spark.udtf.register("chunk_sections", ChunkSections)


def section_rows(regions: DataFrame) -> DataFrame:
    """regions (rx, rz, content) -> rx, rz, slot, stamp, cx, cz, section, palette (state keys), words, bits, error: a row per section or fault.

    Faults: those of the file, the slot and the chunk; misplaced (the chunk names another place than its slot), empty_palette,
    no_words, word_count. Sections without a fault have an error of null.
    """
    chunks = regions.lateralJoin(RegionChunks(F.col("content").outer())).drop("content")
    sections = chunks.withColumnRenamed("error", "fault").lateralJoin(ChunkSections(F.col("payload").outer(), F.col("compression").outer()))
    keys = F.transform("palette", lambda p: state_key(p["name"], p["properties"]))
    s = sections.select("rx", "rz", "slot", "stamp", "cx", "cz", "section", keys.alias("palette"), "words", "fault", "error")
    s = s.withColumn("bits", palette_bits(F.size("palette")))
    place = (F.shiftright("cx", 5) != F.col("rx")) | (F.shiftright("cz", 5) != F.col("rz")) | (F.pmod("cx", F.lit(32)) + F.pmod("cz", F.lit(32)) * 32 != F.col("slot"))
    found = F.when(place, "misplaced").when(F.size("palette") == 0, "empty_palette").when((F.size("palette") > 1) & F.col("words").isNull(), "no_words")
    found = found.when((F.size("palette") > 1) & (F.size("words") != F.ceil(F.lit(SECTION) / F.floor(F.lit(64) / F.col("bits")))), "word_count")
    return s.withColumn("error", F.coalesce("fault", "error", found)).drop("fault")


def palette_bits(entries: Column) -> Column:
    """Bits of a palette index: enough for the last one, four at least."""
    return F.greatest(F.lit(4), F.length(F.bin((F.greatest(entries, F.lit(2)) - 1).cast("long")))).cast("int")


def block_rows(sections: DataFrame, air: str | None = "minecraft:air") -> DataFrame:
    """Sound sections -> x, y, z, state of every block but air, and rows with error `index_outside_palette` whose state is null.

    Cells of a section go x fastest, then z, then y. A section of one palette entry has no words.
    """
    sound = sections.where("error IS NULL")
    if air is not None:  # sections of air alone give no rows, so they need not be unpacked
        sound = sound.where(~((F.size("palette") == 1) & (F.col("palette")[0] == air)))
    cell = F.posexplode(F.sequence(F.lit(0), F.lit(SECTION - 1))).alias("cell", "_")
    cells = sound.select("cx", "cz", "section", "palette", "words", "bits", cell)
    at = F.when(F.col("words").isNull(), F.lit(0).cast("long")).otherwise(unpack_index(F.col("words"), F.col("bits"), F.col("cell")))
    states = cells.select("cx", "cz", "section", "cell", F.get("palette", at.cast("int")).alias("state"))
    if air is not None:
        states = states.where(F.col("state").isNull() | (F.col("state") != air))
    x = F.col("cx").cast("long") * 16 + F.col("cell") % 16
    z = F.col("cz").cast("long") * 16 + F.shiftright("cell", 4) % 16
    y = F.col("section").cast("long") * 16 + F.shiftright("cell", 8)
    return states.select(x.alias("x"), y.alias("y"), z.alias("z"), "state", F.when(F.col("state").isNull(), "index_outside_palette").alias("error"))


def write_regions(blocks: DataFrame, path: str, air: str = "minecraft:air", damage: Column | None = None) -> DataFrame:
    """blocks (x, y, z, state; one row a cell) -> (rx, rz, content) written to path and read back: chunks of packed sections in region files.

    Palettes and words are made by Spark's functions from at most 4,096 cells a section; Python only lays out bytes, for at
    most 1,024 chunks at a time. `damage` (over cx and cz: null, truncated, compression or place) breaks chunks for tests.
    """
    b = blocks.select(*(F.col(c).cast("long").alias(c) for c in "xyz"), "state")
    placed = b.select(F.shiftright("x", 4).alias("cx"), F.shiftright("z", 4).alias("cz"), F.shiftright("y", 4).alias("section"), (F.pmod("y", F.lit(16)) * 256 + F.pmod("z", F.lit(16)) * 16 + F.pmod("x", F.lit(16))).cast("int").alias("cell"), "state")
    keys = ["cx", "cz", "section"]
    s = placed.groupBy(*keys).agg(F.collect_list(F.struct("cell", "state")).alias("cells"), F.sort_array(F.collect_set("state")).alias("used"))
    s = s.withColumn("palette", F.when(F.size("cells") < SECTION, F.array_union(F.array(F.lit(air)), "used")).otherwise(F.col("used")))
    s = s.withColumn("bits", palette_bits(F.size("palette")))
    each = s.select(*keys, "palette", "bits", F.explode("cells").alias("c")).select(*keys, "palette", "bits", "c.cell", (F.array_position("palette", F.col("c.state")) - 1).alias("index"))
    word, part = packed_part(F.col("index"), F.col("bits"), F.col("cell"))
    words = each.groupBy(*keys, "palette", "bits", word.alias("word")).agg(F.bit_or(part).alias("part")).groupBy(*keys, "palette", "bits").agg(F.map_from_entries(F.collect_list(F.struct("word", "part"))).alias("parts"))
    whole = F.transform(F.sequence(F.lit(0), (F.ceil(F.lit(SECTION) / F.floor(F.lit(64) / F.col("bits"))) - 1).cast("int")), lambda w: F.coalesce(F.try_element_at("parts", w), F.lit(0).cast("long")))
    s = words.select(*keys, "palette", F.when(F.size("palette") > 1, whole).alias("words"))
    harm = (damage if damage is not None else F.lit(None)).cast("string").alias("damage")
    chunks = s.groupBy("cx", "cz").agg(F.sort_array(F.collect_list(F.struct("section", "palette", "words"))).alias("sections")).select("cx", "cz", "sections", harm, F.shiftright("cx", 5).alias("rx"), F.shiftright("cz", 5).alias("rz"))

    def lay_out(rows: pd.DataFrame) -> pd.DataFrame:
        header, body, stamps = bytearray(SECTOR), [], bytearray(SECTOR)
        sector = 2
        for r in rows.sort_values(["cz", "cx"]).itertuples():
            tags = chunk_tags(int(r.cx) + (r.damage == "place"), int(r.cz), [(int(x["section"]), list(x["palette"]), [] if x["words"] is None else [int(w) for w in x["words"]]) for x in r.sections])
            packed = zlib.compress(tags)
            packed = packed[: len(packed) // 2] if r.damage == "truncated" else packed
            raw = struct.pack(">IB", len(packed) + 1, 9 if r.damage == "compression" else 2) + packed
            count = -(-len(raw) // SECTOR)
            slot = int(r.cx) % 32 + int(r.cz) % 32 * 32
            struct.pack_into(">I", header, 4 * slot, sector << 8 | count)
            struct.pack_into(">I", stamps, 4 * slot, slot + 1)
            body.append(raw.ljust(count * SECTOR, b"\0"))
            sector += count
        return pd.DataFrame({"rx": [int(rows.rx.iloc[0])], "rz": [int(rows.rz.iloc[0])], "content": [bytes(header + stamps) + b"".join(body)]})

    chunks.groupBy("rx", "rz").applyInPandas(lay_out, "rx long, rz long, content binary").write.parquet(path)
    return blocks.sparkSession.read.parquet(path)
