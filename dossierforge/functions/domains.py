"""The registered domain of a host: what lies one label below its public suffix."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import text as T
from . import vocab as V
from .letters import literal_map

#: What a rule says of its name: a suffix; any label before it makes a suffix; it is no suffix, though such a rule says so.
SUFFIX, ANY_BELOW, EXCEPT = 1, 2, 4


def rules_of(lines: Iterable[str]) -> dict[str, int]:
    """Rules of a public suffix list: a name, *.name or !name a line; // begins a remark."""
    rules: dict[str, int] = {}
    for line in lines:
        rule = line.split("//")[0].split()
        if rule:
            name, kind = (rule[0][2:], ANY_BELOW) if rule[0].startswith("*.") else (rule[0][1:], EXCEPT) if rule[0].startswith("!") else (rule[0], SUFFIX)
            rules[name.lower()] = rules.get(name.lower(), 0) | kind
    return rules


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """rules(name, kind) of a public suffix list."""
    line = F.get(F.split(F.trim(F.regexp_replace("value", "//.*$", "")), r"\s+"), F.lit(0))
    name = F.lower(F.regexp_replace(line, r"^(\*\.|!)", ""))
    kind = F.when(line.startswith("*."), ANY_BELOW).when(line.startswith("!"), EXCEPT).otherwise(SUFFIX)
    return spark.read.text(path).where(line != "").select(name.alias("name"), kind.alias("kind")).groupBy("name").agg(F.bit_or("kind").cast("int").alias("kind"))


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user, port and a dot at its end."""
    return F.regexp_replace(F.lower(F.regexp_replace(F.regexp_replace(T.netloc(url), r"^.*@", ""), r":[0-9]*$", "")), r"\.$", "")


def _names(host: Column) -> Column:
    """The host's own endings, the whole of it first."""
    return T.bind(F.split(host, r"\."), lambda labels: F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), ".")))


def _below(host: Column, n: Column) -> Column:
    """The last n + 1 labels, if there are so many and n is one at least."""
    labels = F.split(host, r"\.")
    return F.when((n > 0) & (F.size(labels) > n), F.array_join(F.slice(labels, F.greatest(F.size(labels) - n, F.lit(1)), n + 1), "."))


def _suffix_labels(kinds: Column) -> Column:
    """kinds: (labels, kind) of the rules that name an ending of the host. How many labels its suffix has: an exception has one less than its name; else the longest rule counts."""
    exception = F.array_max(F.transform(F.filter(kinds, lambda r: r["kind"].bitwiseAND(EXCEPT) > 0), lambda r: r["labels"] - 1))
    return F.coalesce(exception, F.array_max(F.transform(kinds, lambda r: F.when(r["kind"].bitwiseAND(ANY_BELOW) > 0, r["labels"] + 1).when(r["kind"].bitwiseAND(SUFFIX) > 0, r["labels"]))), F.lit(0))


def _whole(url: Column) -> Column:
    return F.regexp_replace(F.lower(T.netloc(url)), r"^www\.", "")


def registered_domain(url: Column, rules: dict[str, int] | None = None) -> Column:
    """The host's registered domain under a list of rules that fits one expression; the host as it is, without www., if no rule names its suffix.

    A rule *.name needs a label in its place: a host that is no longer than its suffix is taken whole.
    """
    known = literal_map(rules_of(V.SUFFIX_RULES) if rules is None else rules)

    def found(host: Column) -> Column:
        rule = lambda x, i: F.struct((F.size(F.split(host, r"\.")) - i).alias("labels"), F.try_element_at(known, x).alias("kind"))
        named = F.filter(F.transform(_names(host), rule), lambda r: r["kind"].isNotNull())
        return T.bind(T.bind(named, _suffix_labels), lambda n: _below(host, n))

    return F.coalesce(T.bind(host_of(url), found), _whole(url))


def with_registered_domain(d: DataFrame, rules: DataFrame, url: str = "url", name: str = "domain", broadcast_rows: int = 100_000) -> DataFrame:
    """d with its URLs' registered domains under a table of rules(name, kind) of any size.

    Each distinct host looks up its own endings, a row for each label, so no rule is tried that doesn't name one of them.
    """
    hosts = d.select(host_of(F.col(url)).alias("__host")).where("__host IS NOT NULL").distinct()
    endings = hosts.select("__host", F.explode(_names(F.col("__host"))).alias("__ending"))
    known = rules.select(F.col("name").alias("__ending"), "kind")
    known = F.broadcast(known) if known.limit(broadcast_rows + 1).count() <= broadcast_rows else known
    kinds = F.collect_list(F.struct(F.size(F.split("__ending", r"\.")).alias("labels"), "kind"))
    found = endings.join(known, "__ending").groupBy("__host").agg(kinds.alias("k")).select("__host", _below(F.col("__host"), _suffix_labels(F.col("k"))).alias("__below"))
    out = d.withColumn("__host", host_of(F.col(url))).join(found, "__host", "left")
    return out.withColumn(name, F.coalesce("__below", _whole(F.col(url)))).drop("__host", "__below")
