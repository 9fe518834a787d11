"""Other letters in plain ones: marks dropped, scripts spelled in Latin letters, all as Catalyst expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: how letters that have no plain letter inside are spelled
LATIN = dict(pair.split(":") for pair in "ß:ss æ:ae œ:oe þ:th ð:d đ:d ħ:h ı:i ł:l ŋ:ng ø:o ŧ:t ĸ:k ƒ:f ə:a".split())
GREEK = dict(pair.split(":") for pair in "α:a β:b γ:g δ:d ε:e ζ:z η:e θ:th ι:i κ:k λ:l μ:m ν:n ξ:x ο:o π:p ρ:r σ:s ς:s τ:t υ:u φ:ph χ:kh ψ:ps ω:o".split())
CYRILLIC = dict(pair.split(":") for pair in "а:a б:b в:v г:g д:d е:e ё:io ж:zh з:z и:i й:i к:k л:l м:m н:n о:o п:p р:r с:s т:t у:u ф:f х:kh ц:ts ч:ch ш:sh щ:shch ъ: ы:y ь: э:e ю:iu я:ia ђ:dj є:ie і:i ї:yi ј:j љ:lj њ:nj ћ:tsh ў:u џ:dz ґ:g".split())
GEORGIAN = dict(pair.split(":") for pair in "ა:a ბ:b გ:g დ:d ე:e ვ:v ზ:z თ:t ი:i კ:k ლ:l მ:m ნ:n ო:o პ:p ჟ:zh რ:r ს:s ტ:t უ:u ფ:p ქ:k ღ:gh ყ:q შ:sh ჩ:ch ც:ts ძ:dz წ:ts ჭ:ch ხ:kh ჯ:j ჰ:h".split())
#: Blocks whose letters hold plainer ones: Latin, Greek, Cyrillic, ligatures and wide forms.
BLOCKS = [(0x00C0, 0x024F), (0x0370, 0x03FF), (0x0400, 0x04FF), (0x1E00, 0x1FFF), (0x2070, 0x209F), (0xFB00, 0xFB06), (0xFF01, 0xFF5E)]
#: Hangul syllables are their three parts, counted from the first one.
HANGUL, VOWELS, ENDS = 0xAC00, 21, 28


@cache
def tables() -> tuple[str, str, dict[str, str]]:
    """(from, to) of letters that become one letter, and the spelling of the others."""
    spelled = LATIN | GREEK | CYRILLIC | GEORGIAN
    one = {c: s for c, s in spelled.items() if len(s) == 1}
    many = {c: s for c, s in spelled.items() if len(s) != 1}
    for lo, hi in BLOCKS:
        for c in map(chr, range(lo, hi + 1)):
            if c in spelled or unicodedata.category(c) == "Cn":
                continue
            plain = "".join(spelled.get(x, x) for x in unicodedata.normalize("NFKD", c).lower() if unicodedata.category(x) != "Mn")
            if plain.isascii() and plain != c:
                (one if len(plain) == 1 else many)[c] = plain
    for c in map(chr, [*range(0x3041, 0x3097), *range(0x30A1, 0x30FB)]):  # kana are named as they sound
        many[c] = unicodedata.name(c).rsplit(" ", 1)[1].lower()
    return "".join(one), "".join(one.values()), many


def literal_map(entries: Mapping[str, object]) -> Column:
    """A map of constants, which the optimizer keeps as one value; inner mappings become maps."""

    def said(x: object) -> str:
        if isinstance(x, Mapping):
            return f"map({', '.join(f'{said(k)}, {said(v)}' for k, v in x.items())})"
        return str(x) if isinstance(x, int) else "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"

    return F.expr(said(entries))


def _hangul() -> list[list[str]]:
    """How the parts of a syllable sound: what the names of syllables share."""
    name = lambda i: unicodedata.name(chr(HANGUL + i)).rsplit(" ", 1)[1].lower()
    vowels = [name(11 * VOWELS * ENDS + v * ENDS) for v in range(VOWELS)]  # the twelfth first part is silent
    firsts = [name(a * VOWELS * ENDS)[: -len(vowels[0])] for a in range(19)]
    ends = [name(11 * VOWELS * ENDS + e)[len(vowels[0]) :] for e in range(ENDS)]
    return [firsts, vowels, ends]


def plain_letters(c: Column) -> Column:
    """c in lower case, its letters spelled in a to z where they have a spelling here; other letters become u and their code point in hex, between spaces.

    Null stays null. ASCII text passes through one test.
    """
    c = F.lower(c)
    one_from, one_to, many = tables()
    spelled = literal_map(many)
    firsts, vowels, ends = (F.array(*map(F.lit, x)) for x in _hangul())

    def letter(x: Column) -> Column:
        i = F.ascii(x) - HANGUL
        syllable = F.concat(F.get(firsts, (i / (VOWELS * ENDS)).cast("int")), F.get(vowels, (i / ENDS).cast("int") % VOWELS), F.get(ends, i % ENDS))
        code = F.concat(F.lit(" u"), F.lower(F.hex(F.ascii(x))), F.lit(" "))
        other = F.when((i >= 0) & (i < 19 * VOWELS * ENDS), syllable).when(x.rlike(r"^\p{L}$"), code).otherwise(x)
        return F.when(x < "\x80", x).otherwise(F.coalesce(F.try_element_at(spelled, x), other))

    odd = F.translate(F.regexp_replace(c, r"\p{M}+", ""), one_from, one_to)
    return F.when(c.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(F.split(odd, ""), letter), "")).otherwise(c)
