"""Nested structs out of flat paths, as Catalyst expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V


def tree(leaves: Mapping[str, Column]) -> Column:
    """Structs within structs: the column of a.b.c is field c of field b of field a; fields stand in the order given. A path can't be a leaf and a branch."""
    branches: dict[str, dict[str, Column]] = {}
    fields: dict[str, Column | None] = {}
    for path, leaf in leaves.items():
        head, _, rest = path.partition(".")
        if not head or head in fields and (not rest or head not in branches):
            raise ValueError(f"{path} is named twice, or is a leaf and a branch")
        fields[head] = None if rest else leaf
        if rest:
            branches.setdefault(head, {})[rest] = leaf
    return F.struct(*((tree(branches[n]) if c is None else c).alias(n) for n, c in fields.items()))


def tree_of_map(entries: Column, paths: list[str], field: str | None = None) -> Column:
    """The entries of a map with dotted keys as a tree of these paths, whatever other keys it has; a missing key gives a null leaf. field: the field of the entries to take."""
    at = lambda p: F.try_element_at(entries, F.lit(p))
    return tree({p: at(p)[field] if field else at(p) for p in paths})


def reasons(prefix: str = "scores") -> list[str]:
    return [f"{prefix}.{axis}.reason" for axis in V.AXES]


def scores_block(scores: Column) -> Column:
    """Score and evidence of each axis, language apart."""
    return tree({f"{a}.{f}": scores[a][f] for a in V.AXES for f in ("score", "evidence")})


def english(has_tagline: Column, tagline: Column, has_scores: Column, scores: Column) -> Column:
    """struct(tagline, scores.<axis>.reason) in English: null if neither source is usable, its scores null if they aren't."""
    said = tree({f"{a}.reason": scores[a]["reason"] for a in V.AXES})
    return F.when(has_tagline | has_scores, F.struct(F.when(has_tagline, tagline).alias("tagline"), F.when(has_scores, said).alias("scores")))


def dutch(has_translations: Column, translations: Column, has_scores: Column) -> Column:
    """The same in Dutch out of a map of dotted paths to struct(nl): null if there are no translations; scores only where the English tree has them."""
    whole = tree_of_map(translations, ["tagline", *reasons()], "nl")
    return F.when(has_translations, F.struct(whole["tagline"].alias("tagline"), F.when(has_scores, whole["scores"]).alias("scores")))
