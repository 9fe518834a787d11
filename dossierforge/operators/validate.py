"""Checks of model answers, on VARIANT values: a value of another type is not coerced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vocab as V


def parse(answer: Column) -> Column:
    """The JSON of an answer, out of its fence if it has one; null if it isn't JSON."""
    return F.try_parse_json(T.strip_fence(answer))


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _kind(v: Column, path: str) -> Column:
    """The type of the value at a path, as VARIANT names it."""
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def text_at(v: Column, path: str) -> Column:
    """The trimmed text at a path; null if it isn't a string with more than blanks."""
    return F.when(_kind(v, path) == "STRING", F.nullif(F.trim(_get(v, path, "string")), F.lit("")))


def tagline(answer: Column) -> Column:
    return text_at(parse(answer), "$.en")


def axis(v: Column, name: str) -> Column:
    """struct(score, evidence, reason) of an axis, or null if it breaks a rule. A score with no_signal becomes partial, none with anything else no_signal.

    Evidence is one of a few words, which no value but a string reads as, so its type needs no look."""
    at = f"$.{name}"
    parts = F.struct(_kind(v, f"{at}.score").alias("kind"), _get(v, f"{at}.score", "double").alias("value"), F.trim(_get(v, f"{at}.evidence", "string")).alias("evidence"), text_at(v, f"{at}.reason.en").alias("reason"))

    def judged(x: Column) -> Column:
        kind, value, evidence, reason = x["kind"], x["value"], x["evidence"], x["reason"]
        number = kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
        missing = kind.isNull() | (kind == "VOID")
        fine = F.coalesce(missing | (number & (value == F.floor(value)) & value.between(0, 100)), F.lit(False)) & evidence.isin(V.EVIDENCE) & reason.isNotNull()
        fixed = F.when(missing, F.lit("no_signal")).when(evidence == "no_signal", F.lit("partial")).otherwise(evidence)
        return F.when(fine, F.struct(F.when(~missing, value.cast("int")).alias("score"), fixed.alias("evidence"), reason.alias("reason")))

    return T.bind(parts, judged)


def scores(answer: Column) -> Column:
    """A struct of all axes, bare or under scores, or null if any is missing or wrong. The answer is parsed once, its root chosen once."""
    def root(v: Column) -> Column:
        nested = F.coalesce(_kind(v, "$.scores").startswith("OBJECT"), F.lit(False))
        return F.when(nested, _get(v, "$.scores", "variant")).otherwise(v)

    def whole(x: Column) -> Column:
        return F.when(F.forall(F.array(*(x[a].isNotNull() for a in V.AXES)), lambda found: found), x)

    return T.bind(T.bind(T.bind(parse(answer), root), lambda v: F.struct(*(axis(v, a).alias(a) for a in V.AXES))), whole)


def tags(answer: Column) -> Column:
    """The list of tags, or null if one of them has another key, an unknown value, or a code that came before. An empty list is fine."""
    whole = _get(parse(answer), "$", "array<variant>")
    listed = F.transform(whole, lambda x: F.try_variant_get(x, "$", "map<string,variant>"))
    one = F.transform(whole, lambda x: F.struct(*(text_at(x, f"$.{k}").alias(k) for k in ("isco_code", "prominence", "confidence"))))
    keys = F.forall(listed, lambda m: F.coalesce(F.array_sort(F.map_keys(m)) == F.array(F.lit("confidence"), F.lit("isco_code"), F.lit("prominence")), F.lit(False)))
    values = F.forall(one, lambda x: F.coalesce(x["isco_code"].isin(V.ISCO) & x["prominence"].isin(V.PROMINENCE) & x["confidence"].isin(V.CONFIDENCE), F.lit(False)))
    codes = F.transform(one, lambda x: x["isco_code"])
    return F.when(F.coalesce(keys & values & (F.size(F.array_distinct(codes)) == F.size(codes)), F.lit(False)), one)


def translations(answer: Column, keys: Column) -> Column:
    """map of key to text for all expected keys, or null if one is missing or blank. Other keys are ignored."""
    m = F.try_variant_get(parse(answer), "$", "map<string,string>")
    texts = F.transform(keys, lambda k: F.nullif(F.trim(F.try_element_at(m, k)), F.lit("")))
    return F.when(F.coalesce(F.forall(texts, lambda x: x.isNotNull()), F.lit(False)), F.map_from_arrays(keys, texts))


def score_digest(scores: Column) -> Column:
    """Each axis's first three letters and its score in one line, as a log shows them; empty without scores."""
    said = [F.concat(F.lit(f"{a[:3]}="), F.coalesce(scores[a]["score"].cast("string"), F.lit("None"))) for a in V.AXES]
    return F.when(scores.isNull(), "").otherwise(F.concat_ws(" ", *said))
