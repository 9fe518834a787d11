"""Canonical JSON: keys in order, nothing between tokens, one spelling for each string and number; the bytes that Python's json.dumps(sort_keys=True) gives."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import bind

# fixed values: characters with an escape of their own
_SHORT = {"\\": "\\\\", '"': '\\"', "\n": "\\n", "\r": "\\r", "\t": "\\t", "\b": "\\b", "\f": "\\f"}


def _string(c: Column) -> Column:
    def replaced(c: Column, pairs) -> Column:
        for a, b in pairs:
            c = F.replace(c, F.lit(a), F.lit(b))
        return c

    rest = [(chr(i), f"\\u{i:04x}") for i in range(32) if chr(i) not in _SHORT]
    said = F.when(c.rlike('[\\\\"\\x00-\\x1f]'), replaced(replaced(c, _SHORT.items()), rest)).otherwise(c)
    return F.concat(F.lit('"'), said, F.lit('"'))


def _double(c: Column) -> Column:
    """Shortest digits, plain from 1e-4 to below 1e16, with an exponent of two digits at least beyond."""
    pattern = r"^([0-9]+)(?:\.([0-9]+))?(?:E(-?[0-9]+))?$"

    def spelled(s: Column) -> Column:
        whole, part = F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, 2)
        moved = F.coalesce(F.nullif(F.regexp_extract(s, pattern, 3), F.lit("")).cast("int"), F.lit(0))
        digits = F.concat(whole, part)
        plain = F.regexp_replace(digits, "^0+|0+$", "")
        # where the point stands, counted from the first digit that isn't 0
        point = F.length(whole) + moved - (F.length(digits) - F.length(F.regexp_replace(digits, "^0+", "")))
        return bind(F.struct(plain.alias("d"), point.alias("p")), placed)

    def placed(x: Column) -> Column:
        d, p = x["d"], x["p"]
        n, e = F.length(d), p - 1
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -p), d)
        large = F.concat(d, F.repeat(F.lit("0"), p - n), F.lit(".0"))
        between = F.concat(d.substr(F.lit(1), p), F.lit("."), d.substr(p + 1, n))
        tail = F.when(n > 1, F.concat(F.lit("."), d.substr(F.lit(2), n))).otherwise("")
        size = F.abs(e).cast("string")
        power = F.concat(F.when(e < 0, "-").otherwise("+"), F.when(F.length(size) < 2, F.concat(F.lit("0"), size)).otherwise(size))
        far = F.concat(d.substr(F.lit(1), F.lit(1)), tail, F.lit("e"), power)
        return F.when(n == 0, "0.0").when((e < -4) | (e >= 16), far).when(p <= 0, small).when(p >= n, large).otherwise(between)

    def shorter(x: Column) -> Column:
        """Older Java versions write a digit too many at times, mostly of 17 and of the least numbers: the first rounding that reads back as the number."""
        tries = F.transform(F.array(*(F.format_string(f"%.{n}e", x) for n in range(17))), lambda t: F.regexp_replace(F.regexp_replace(t, "e", "E"), r"E\+?(-?)0*([0-9])", "E$1$2"))
        return F.coalesce(F.get(F.filter(tries, lambda t: t.cast("double") == x), F.lit(0)), x.cast("string"))

    text = c.cast("string")
    odd = (F.length(text) > 17) | (F.abs(c) < 1e-300)
    absolute = bind(F.abs(c), lambda x: F.when(odd, shorter(x)).otherwise(x.cast("string")))
    signed = F.concat(F.when(text.startswith("-"), "-").otherwise(""), bind(absolute, spelled))
    return F.when(F.isnan(c), "NaN").when(text.endswith("Infinity"), text).otherwise(signed)


def canonical(c: Column, kind: T.DataType) -> Column:
    """c as canonical JSON; null as null. Fields of structs and keys of maps with string keys stand in the order of their code points; decimals, dates and such as strings."""
    if isinstance(kind, T.StructType):
        fields = sorted(kind.fields, key=lambda f: f.name)
        named = [F.concat(_string(F.lit(f.name)), F.lit(":"), canonical(c[f.name], f.dataType)) for f in fields]
        said = F.concat(F.lit("{"), F.concat_ws(",", *named), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        said = F.concat(F.lit("["), F.array_join(F.transform(c, lambda x: canonical(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entries = F.transform(F.array_sort(F.map_keys(c)), lambda k: F.concat(_string(k.cast("string")), F.lit(":"), canonical(F.element_at(c, k), kind.valueType)))
        said = F.concat(F.lit("{"), F.array_join(entries, ","), F.lit("}"))
    elif isinstance(kind, (T.FloatType, T.DoubleType)):
        said = _double(c.cast("double"))
    elif isinstance(kind, (T.BooleanType, T.IntegralType)):
        said = c.cast("string")
    elif isinstance(kind, T.NullType):
        return F.lit("null")
    else:
        said = _string(c.cast("string"))
    return F.when(c.isNull(), "null").otherwise(said)


def canonical_json(d: DataFrame, columns: list[str]) -> Column:
    """The columns of a row as one canonical object."""
    kind = T.StructType([d.schema[c] for c in columns])
    return canonical(F.struct(*columns), kind)
