"""Text: column names, tag-length-value data, merchant address, character sets."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalise_name(name: str) -> str:
    """Table column name of a layout field name."""
    cleaned = re.sub(r"[\[\].'()/]", "", name)
    cleaned = re.sub(r"[- ]", "_", cleaned)
    return re.sub(r"_{2,3}", "_", cleaned)


def tlv_map(c: Column, max_elements: int | None = None) -> Column:
    """Map of repeated ``tag(4) length(3) value`` elements; the first of a tag wins.

    The scan ends at the first header that is not numeric or runs past the text.
    ``max_elements`` bounds the steps; by default the text length does (an element
    is at least seven characters long).
    """
    steps = F.lit(max_elements) if max_elements else F.floor(F.length(c) / 7).cast("int")
    start = F.struct(
        F.lit(1).alias("p"),
        F.lit(None).cast("map<string,string>").alias("none"),
        F.array().cast("array<struct<k:string,v:string>>").alias("m"),
    )

    def step(state: Column, _: Column) -> Column:
        pos = state["p"]
        tag, size = F.substr(c, pos, F.lit(4)), F.substr(c, pos + 4, F.lit(3))
        ok = (pos > 0) & tag.rlike("^[0-9]{4}$") & size.rlike("^[0-9]{3}$")
        length = F.when(ok, size.try_cast("int")).otherwise(0)
        seen = F.exists(state["m"], lambda e: e["k"] == tag)
        item = F.struct(tag.alias("k"), F.substr(c, pos + 7, length).alias("v"))
        return F.struct(
            F.when(ok, pos + 7 + length).otherwise(F.lit(0)).alias("p"),
            state["none"].alias("none"),
            F.when(ok & ~seen, F.concat(state["m"], F.array(item))).otherwise(state["m"]).alias("m"),
        )

    return F.aggregate(
        F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")),
        start,
        step,
        lambda s: F.map_from_entries(s["m"]),
    )


def acceptor_parts(c: Column) -> dict[str, Column]:
    r"""Merchant name, street, city, postal code, region and country.

    The field has up to four parts split by ``\``. The last part ends in a
    three-character region and a three-character country; what is before them is
    the postal code. With fewer than three parts only the country is known.
    """
    parts = F.split(c, r"\\", 4)
    tail = F.element_at(parts, -1)
    known = F.size(parts) >= 3

    def part(i: int) -> Column:
        return F.when(known, F.try_element_at(parts, F.lit(i)))

    def cut(text: Column, size: int | None, drop: int) -> Column:
        """Characters that remain after dropping ``drop`` from the right, last ``size`` of them."""
        kept = F.greatest(F.length(text) - drop, F.lit(0))
        head = F.substr(text, F.lit(1), kept)
        return head if size is None else F.right(head, F.lit(size))

    return {
        "name": part(1),
        "street": part(2),
        "city": F.regexp_replace(part(3), r"\\", ""),
        "postal_code": F.when(known, F.regexp_replace(cut(tail, None, 6), r"\\", "")),
        "region": F.when(known, cut(tail, 3, 3)),
        "country": F.right(tail, F.lit(3)),
    }


def bytes_to_text(c: Column, ebcdic: bool = False) -> Column:
    """Bytes as text, from ISO-8859-1 or from EBCDIC code page 500."""
    latin = F.decode(c, "ISO-8859-1")
    if not ebcdic:
        return latin
    codes = bytes(range(1, 256))
    return F.translate(latin, codes.decode("latin-1"), codes.decode("cp500"))


def text_or_blank(c: Column) -> Column:
    """Text form used by the rule conditions: null becomes the word ``BLANK``."""
    return F.coalesce(c.cast("string"), F.lit("BLANK"))
