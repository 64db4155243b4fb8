"""Text helpers as column expressions."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from forecourt.functions.staging import bind

# Everything Unicode counts as white space; Spark's own trim only removes blanks.
_SPACE_CHARACTERS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())
SPACE = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip_space(text: Column) -> Column:
    """Remove any Unicode white space at both ends."""
    return F.btrim(text, F.lit(_SPACE_CHARACTERS))


# References to the unused control range 128-159 mean Windows-1252 characters.
_CONTROLS = "".join(map(chr, range(128, 160)))
_WINDOWS = "".join(
    bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(128, 160)
)


def _numeric_character(reference: Column) -> Column:
    """`&#233;` or `&#xE9;` -> é, however many zeros lead; numbers that are no character -> U+FFFD.

    Control characters and non-characters of Unicode vanish, as the standard library has it.
    """
    digits = F.regexp_extract(reference, r"^&#[xX]?0*([0-9a-fA-F]+);?$", 1)
    is_hex = F.lower(F.substring(reference, 3, 1)) == "x"
    number = F.when(F.length(digits) <= 8, F.when(is_hex, F.conv(digits, 16, 10)).otherwise(digits)).cast("bigint")
    usable = ((number > 0) & (number < 0xD800)) | ((number > 0xDFFF) & (number <= 0x10FFFF))
    silent = (
        number.between(0x1, 0x8) | (number == 0xB) | number.between(0xE, 0x1F) | (number == 0x7F)
        | number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    character = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return (
        F.when(usable & silent, F.lit(""))
        .when(usable, F.translate(character, _CONTROLS, _WINDOWS))
        .otherwise(F.lit("\ufffd"))
    )


# The standard's names, from Python's own table.  Those it also allows without
# `;` match as far as they reach, the longest first.
_NAMED = json.dumps({f"&{name}": text for name, text in html5.items()})
_UNENDED = "|".join(sorted((n for n in html5 if not n.endswith(";")), key=len, reverse=True))
_CUT = (
    rf"&(?:[a-zA-Z][a-zA-Z0-9]*;|#[0-9]+;?|#[xX][0-9a-fA-F]+;?|(?:{_UNENDED}))|[^&]+|&"
)


def decode_entities(text: Column) -> Column:
    """Decode numeric and named character references.

    Each is replaced where it stands, so that `&amp;lt;` ends as `&lt;`.
    """
    named = F.from_json(F.lit(_NAMED), "map<string,string>")

    def character(reference: Column) -> Column:
        return F.when(
            F.startswith(reference, F.lit("&#")), _numeric_character(reference)
        ).otherwise(F.coalesce(F.try_element_at(named, reference), begun(reference)))

    def begun(reference: Column) -> Column:
        # An unknown name may begin with one that needs no end.
        known = F.regexp_extract(reference, f"^&(?:{_UNENDED})", 0)
        rest = F.substring(reference, F.length(known) + 1, F.length(reference))
        return F.when(known == "", reference).otherwise(
            F.concat(F.try_element_at(named, known), rest))

    return F.array_join(
        F.transform(
            F.regexp_extract_all(text, F.lit(_CUT), F.lit(0)),
            lambda p: F.when(F.startswith(p, F.lit("&")), character(p)).otherwise(p),
        ), ""
    )


def plain_text(text: Column) -> Column:
    """Text with entities decoded and both ends stripped; most texts have no entities."""
    return bind(text, lambda t: strip_space(
        F.when(F.contains(t, F.lit("&")), decode_entities(t)).otherwise(t)
    ))
