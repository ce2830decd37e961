"""Grid keys: block, chunk, region and tile addresses, with floor semantics for negatives."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cell(v: Column, size: float) -> Column:
    """The index of the cell of this size."""
    return F.floor(v / size)


def chunk(v: Column) -> Column:
    return F.shiftright(v, 4)


def region(v: Column) -> Column:
    return F.shiftright(v, 9)


def chunk_slot(cx: Column, cz: Column) -> Column:
    """The slot of a chunk in its region file: 32 x 32, x fastest."""
    return F.pmod(cx, F.lit(32)) + F.pmod(cz, F.lit(32)) * 32


def tile_id(tx: Column, tz: Column) -> Column:
    return F.concat_ws("_", tx.cast("string"), tz.cast("string"))


def tile_x(tile: Column) -> Column:
    return F.regexp_extract(tile, r"^(-?\d+)_(-?\d+)$", 1).cast("long")


def tile_z(tile: Column) -> Column:
    return F.regexp_extract(tile, r"^(-?\d+)_(-?\d+)$", 2).cast("long")


def shard(tz: Column, shards: int) -> Column:
    """Bands of four tile rows, dealt round."""
    return F.pmod(F.floor(tz / 4), F.lit(shards))


def unpack_bits(words: Column, bits: int, count: int) -> Column:
    """`count` values of `bits` bits from 64-bit words; a value never spans two words."""
    per = 64 // bits
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.call_function("shiftrightunsigned", F.element_at(words, (F.floor(i / per) + 1).cast("int")), ((i % per) * bits).cast("int")).bitwiseAND(F.lit((1 << bits) - 1)))


def pack_bits(values: Column, bits: int) -> Column:
    """The inverse of unpack_bits."""
    per = 64 // bits
    words = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / per).cast("int"))
    return F.transform(words, lambda w: F.aggregate(F.sequence(F.lit(0), F.lit(per - 1)), F.lit(0).cast("long"), lambda s, k: s.bitwiseOR(F.coalesce(F.call_function("shiftleft", F.get(values, w * per + k).cast("long"), (k * bits).cast("int")), F.lit(0).cast("long")))))


def unpack_index(words: Column, bits: Column, i: Column) -> Column:
    """Value i of packed words whose width is a column; null beyond the words."""
    per = F.floor(F.lit(64) / bits)
    shifted = F.call_function("shiftrightunsigned", F.get(words, F.floor(i / per).cast("int")), ((i % per) * bits).cast("int"))
    return shifted.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1)


def packed_part(value: Column, bits: Column, i: Column) -> tuple[Column, Column]:
    """(word, that word's share) of value i: words are the bitwise or of their values' shares."""
    per = F.floor(F.lit(64) / bits)
    return F.floor(i / per).cast("int"), F.call_function("shiftleft", value.cast("long"), ((i % per) * bits).cast("int"))


def terrain_height(red: Column, green: Column, blue: Column) -> Column:
    """Metres from a terrain-RGB pixel."""
    return red * 256 + green + blue / 256 - 32768


def mercator_pixel(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Web-Mercator pixel coordinates at a zoom level."""
    size = 256 * 2**zoom
    s = F.sin(F.radians(lat))
    return (lon + 180) / 360 * size, (0.5 - F.log((1 + s) / (1 - s)) / (4 * 3.141592653589793)) * size
