"""Character references of HTML, decoded as the standard says, as a Catalyst expression."""

from __future__ import annotations

from functools import cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .letters import literal_map

# fixed value: what a reference looks like; a name is as long as it can be
REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
REPLACEMENT = "�"


@cache
def _names() -> tuple[dict[str, dict[str, str]], str]:
    """Names by first letter; a pattern of those that need no semicolon, longest first."""
    by: dict[str, dict[str, str]] = {}
    for name, value in html5.items():
        by.setdefault(name[0], {})[name] = value
    bare = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
    return by, "|".join(bare)


@cache
def _windows() -> dict[str, str]:
    """Numbers from 128 to 159 mean what Windows has there; where it has nothing, themselves."""
    return {str(i): bytes([i]).decode("latin-1" if i in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else "cp1252") for i in range(0x80, 0xA0)}


def _number(n: Column) -> Column:
    """The character of a number; none for controls and numbers that are no characters."""
    text = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    silent = n.between(1, 8) | (n == 11) | n.between(14, 31) | n.between(127, 159) | n.between(0xFDD0, 0xFDEF) | (F.pmod(n, F.lit(0x10000)) >= 0xFFFE)
    windows = F.try_element_at(literal_map(_windows()), n.cast("string"))
    return F.coalesce(windows, F.when((n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), REPLACEMENT).when(silent, "").otherwise(text))


def _decoded(x: Column) -> Column:
    by_letter, bare = _names()
    digits = F.regexp_replace(F.regexp_extract(x, "^&#[xX]?0*([0-9a-fA-F]*)", 1), "^$", "0")
    hexed = x.rlike("^&#[xX]")
    n = F.when(F.length(digits) > 8, F.lit(0x110000).cast("long")).when(hexed, F.conv(digits, 16, 10).cast("long")).otherwise(digits.cast("long"))
    name = F.substring(x, 2, 40)
    of_letter = F.try_element_at(literal_map(by_letter), F.substring(x, 2, 1))
    named = F.try_element_at(of_letter, name)
    start = F.regexp_extract(name, f"^({bare})", 1)
    short = F.try_element_at(of_letter, start)
    number = F.get(F.transform(F.array(n), _number), F.lit(0))  # n computed once
    return F.when(x.startswith("&#"), number).otherwise(F.coalesce(named, F.concat(short, F.regexp_replace(name, f"^(?:{bare})", "")), x))


def unescape(c: Column) -> Column:
    """c with its named and numeric character references decoded; one that is none stays. Null stays null; text without & passes through one test."""
    tokens = F.regexp_extract_all(c, F.lit(REFERENCE), F.lit(0))
    pieces = F.zip_with(F.split(c, REFERENCE, -1), tokens, lambda gap, x: F.concat(F.coalesce(gap, F.lit("")), F.coalesce(_decoded(x), F.lit(""))))
    return F.when(c.contains("&"), F.array_join(pieces, "")).otherwise(c)
