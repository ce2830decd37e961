"""Attribute functions over tags, colours and identifiers."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def metres(value: Column) -> Column:
    """A number with an optional metre unit; other units and text are null."""
    return F.regexp_extract(value, r"(?i)^\s*(\d+(?:\.\d+)?)\s*(?:m|metres?|meters?)?\s*$", 1).try_cast("double")


def tagged(tags: Column, *keys: str) -> Column:
    """Whether one of the keys has a value that means yes."""
    found = [F.coalesce(~F.element_at(tags, k).isin("", "no", "false", "0"), F.lit(False)) for k in keys]
    out = found[0]
    for f in found[1:]:
        out = out | f
    return out


def first_match(rules: list[tuple[str, Column]], default: Column | None = None) -> Column:
    """The name of the first rule whose condition holds."""
    out = F.when(rules[0][1], F.lit(rules[0][0]))
    for name, condition in rules[1:]:
        out = out.when(condition, F.lit(name))
    return out if default is None else out.otherwise(default)


# Named colours (red, green, blue).
NAMED_COLOURS = {"black": (20, 20, 20), "white": (235, 235, 235), "gray": (128, 128, 128), "brown": (120, 80, 50), "beige": (220, 205, 170), "red": (160, 60, 50), "tan": (200, 170, 130), "silver": (190, 190, 195), "darkgray": (70, 70, 70), "lightgray": (200, 200, 200)}


def colour(value: Column) -> Column:
    """array(red, green, blue) of #rgb, #rrggbb or a name; otherwise null."""
    text = F.regexp_replace(F.regexp_replace(F.lower(F.trim(value)), "grey", "gray"), " ", "")
    long = F.when(text.rlike("^#[0-9a-f]{6}$"), text).when(text.rlike("^#[0-9a-f]{3}$"), F.regexp_replace(text, "([0-9a-f])", "$1$1"))
    part = lambda i: F.conv(F.substring(long, i, 2), 16, 10).cast("int")
    names = F.create_map(*[x for k, rgb in NAMED_COLOURS.items() for x in (F.lit(k), F.array(*map(F.lit, rgb)))])
    return F.when(long.isNotNull(), F.array(part(2), part(4), part(6))).otherwise(F.try_element_at(names, text))


def linear(channel: Column) -> Column:
    """Linear light of an 8-bit sRGB channel."""
    v = channel / 255
    return F.when(v > 0.04045, F.pow((v + 0.055) / 1.055, 2.4)).otherwise(v / 12.92)


def lab(red: Column, green: Column, blue: Column) -> tuple[Column, Column, Column]:
    """CIELAB (D65) of an sRGB colour."""
    r, g, b = linear(red), linear(green), linear(blue)
    # sRGB to XYZ rows, each over the D65 white point.
    rows = ((0.4124, 0.3576, 0.1805, 0.95047), (0.2126, 0.7152, 0.0722, 1.0), (0.0193, 0.1192, 0.9505, 1.08883))
    x, y, z = ((r * p + g * q + b * s) / w for p, q, s, w in rows)
    f = lambda t: F.when(t > 0.008856, F.cbrt(t)).otherwise(7.787 * t + 16 / 116)
    return 116 * f(y) - 16, 500 * (f(x) - f(y)), 200 * (f(y) - f(z))


def hue_light_saturation(red: Column, green: Column, blue: Column) -> tuple[Column, Column, Column]:
    """Hue (0 to 1), lightness and saturation of an 8-bit colour; grey has hue and saturation 0."""
    r, g, b = red / 255, green / 255, blue / 255
    high, low = F.greatest(r, g, b), F.least(r, g, b)
    total, spread = high + low, high - low
    light = total / 2
    saturation = F.when(spread == 0, 0.0).when(light <= 0.5, spread / total).otherwise(spread / (2 - total))
    sector = F.when(spread == 0, 0.0).when(r == high, (g - b) / spread).when(g == high, 2 + (b - r) / spread).otherwise(4 + (r - g) / spread)
    return F.pmod(sector / 6, F.lit(1.0)), light, saturation


# Window glass by wall, as block names.
GLASS = {"dark wall": "minecraft:gray_stained_glass", "warm wall": "minecraft:brown_stained_glass", "other": "minecraft:black_stained_glass"}


def window_glass(red: Column, green: Column, blue: Column) -> Column:
    """Glass for a wall colour: grey on dark walls, brown on saturated orange to brown ones, else black."""
    hue, light, saturation = hue_light_saturation(red, green, blue)
    rules = [(GLASS["dark wall"], light < 0.25), (GLASS["warm wall"], (saturation > 0.2) & (hue > 0.02) & (hue < 0.15))]
    return first_match(rules, F.lit(GLASS["other"]))


# A lane's and a parking strip's width in metres, and road classes without parking.
LANE, PARKING, NO_PARKING = 3.2, 2.4, ("primary", "secondary", "trunk")


def half_width(tags: Column) -> Column:
    """struct(value, how): half a carriageway from its width tag, else from lanes and parking; unreadable widths are as none."""
    mapped = F.split_part(F.trim(F.element_at(tags, "width")), F.lit(" "), F.lit(1)).try_cast("double")
    lanes, one_way = F.element_at(tags, "lanes"), F.coalesce(F.element_at(tags, "oneway") == "yes", F.lit(False))
    count = F.when(lanes.rlike("^[0-9]+$"), lanes.try_cast("int")).otherwise(F.when(one_way, 1).otherwise(2))
    parking = F.when(F.element_at(tags, "highway").isin(*NO_PARKING), 0.0).otherwise(PARKING)
    return F.when(mapped.isNotNull(), F.struct((mapped / 2).alias("value"), F.lit("width tag").alias("how"))).otherwise(F.struct(((count * LANE + parking) / 2).alias("value"), F.lit("lanes").alias("how")))


@F.pandas_udf(StringType())
def fold_text(texts: pd.Series) -> pd.Series:
    """Accents off, case folded, every run of other than letters and digits one space; null stays null."""

    def fold(text: str | None) -> str | None:
        if text is None:
            return None
        plain = "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).casefold()
        return re.sub(r"[\W_]+", " ", plain).strip()

    return texts.map(fold)


def stable_choice(text: Column, n: int) -> Column:
    """An index below n from the SHA-256 of a text."""
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long") % n


def state_key(name: Column, properties: Column) -> Column:
    """name[k=v,...] with sorted keys, from a map."""
    pairs = F.transform(F.array_sort(F.map_entries(properties)), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return F.when(F.size(properties) > 0, F.concat(name, F.lit("["), F.array_join(pairs, ","), F.lit("]"))).otherwise(name)


def parse_state(text: Column) -> tuple[Column, Column]:
    """(name, properties) of a state key."""
    inner = F.regexp_extract(text, r"\[(.*)\]$", 1)
    empty = F.create_map().cast("map<string,string>")
    return F.regexp_extract(text, r"^[^\[]+", 0), F.when(inner != "", F.str_to_map(inner, F.lit(","), F.lit("="))).otherwise(empty)


def year_in_name(name: Column) -> Column:
    """The smallest four-digit year in a name; without one, that of a D or B with two digits (2000 on)."""
    long = F.array_min(F.transform(F.regexp_extract_all(name, F.lit(r"((?:19|20)\d\d)"), 1), lambda y: y.cast("int")))
    return F.coalesce(long, F.regexp_extract(name, r"[_-][DB](\d\d)(?:_|$)", 1).try_cast("int") + 2000)
