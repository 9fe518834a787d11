"""Jaccard join of word n-gram sets by vertical partitioning, and the groups that its links form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import Words, rolling, text_chunks
from .components import components
from .filters import bloom

SHINGLE = 5
#: Two sets link when 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Bytes of text that are worked on at once.
CHUNK_BYTES = 1 << 18
#: Fragments of the global n-gram order; the overlap of two sets is counted in each and summed.
FRAGMENTS = 4
#: Every text votes for one in VOTES of its n-grams, drawn by a hash of text and n-gram. An n-gram with so many votes is
#: common, and common ones come last in the order. Votes only shape the order; any order gives the same links.
COMMON_VOTES, VOTES = 4, 16
#: Common n-grams that the order knows of at most, those with most votes (8 MB to broadcast).
COMMON_NGRAMS = 1_000_000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's k-word windows; of its whole word sequence if that is shorter."""
    w = Words(data, offsets, lower=True)
    at, h = w.grams(k)
    cut = np.searchsorted(at, w.bound)
    out = []
    for d in range(len(offsets) - 1):
        a, b = cut[d], cut[d + 1]
        n = int(w.bound[d + 1] - w.bound[d])
        if n >= k:
            out.append(np.unique(h[a:b]))
        else:
            out.append(rolling(w.hash[w.bound[d] : w.bound[d + 1]], n)[:1] if n else np.empty(0, np.uint64))
    return out


def _node(s: np.ndarray) -> int:
    """64 bits of a whole set."""
    return common.mix_int(int(np.bitwise_xor.reduce(common.mix(s))) + 3 * int(np.sum(s, dtype=np.uint64)) + len(s))


def _prefix(n: int, percent: int) -> int:
    """Least n-grams of a set of n, one of which it shares with any set that it links with."""
    return n - -(-percent * n // 100) + 1


def _ordered_prefix(s: np.ndarray, frequent: np.ndarray, percent: int) -> np.ndarray:
    """The first n-grams of a set in the global order: those that aren't common by hash, then the common ones by hash."""
    p = _prefix(len(s), percent)
    if not len(frequent):
        return s[:p]
    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
    hot = frequent[at] == s
    return np.concatenate([s[~hot], s[hot]])[:p]


def _nodes(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n, node, votes): each text's set size, set hash, and the n-grams that it votes for; then the further columns of docs, which are long."""
    more = [c for c in docs.columns if c not in ("doc_id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, 1, CHUNK_BYTES):
                sets = shingle_sets(data, offsets, k)
                node = [_node(s) for s in sets]
                votes = [s[common.mix(s ^ np.uint64(x)) % np.uint64(VOTES) == 0].view(np.int64) for s, x in zip(sets, node, strict=True)]
                yield pa.RecordBatch.from_arrays([common.column(batch, 0, lo, hi), pa.array([len(s) for s in sets], pa.int64()), pa.array(np.array(node, dtype=np.uint64).view(np.int64)), pa.array(votes, pa.list_(pa.int64())), *(common.column(batch, 2 + i, lo, hi) for i in range(len(more)))], names=["doc_id", "n", "node", "votes", *more])
            common.give_back()

    return docs.select("doc_id", "text", *more).mapInArrow(run, ", ".join(["doc_id bigint, n bigint, node bigint, votes array<bigint>", *(f"{c} bigint" for c in more)]))


def _verify(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (x, y, nx, ny) that link: fragment by fragment, the overlap of their sets is counted, and the counts are summed.

    After the first fragment, pairs go for which even all the rest in common would not be enough."""
    wanted = _ends(pairs)
    chosen = common.store(nodes.join(wanted, "node", "left_semi").groupBy("node").agg(F.min("doc_id").alias("o_id")).select("o_id", F.col("node").alias("o_node")), "wanted")
    few = F.broadcast(chosen) if common.small(chosen) else chosen
    names = [f"p{f}" for f in range(FRAGMENTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = (np.arange(1, FRAGMENTS, dtype=np.uint64) * np.uint64(2**64 // FRAGMENTS)).astype(np.uint64)
        for batch in batches:
            for lo, hi, data, offsets in text_chunks(batch, 1, CHUNK_BYTES):
                sets = shingle_sets(data, offsets, k)
                own = np.array([_node(s) for s in sets], dtype=np.uint64).view(np.int64)
                on = np.flatnonzero(own == np.asarray(common.column(batch, 0, lo, hi)))  # of rows that share a doc_id, those with the set
                parts = [np.split(sets[i], np.searchsorted(sets[i], edges)) for i in on]
                yield pa.RecordBatch.from_arrays([pa.array(own[on]), *(pa.array([p[f].view(np.int64) for p in parts], pa.list_(pa.int64())) for f in range(FRAGMENTS))], names=["node", *names])
            common.give_back()

    rows = docs.join(few, F.col("doc_id").eqNullSafe(F.col("o_id"))).select("o_node", "text")
    cut = common.store(rows.mapInArrow(run, f"node bigint, {', '.join(f'{p} array<bigint>' for p in names)}"), "fragments")
    if cut.groupBy("node").count().where("count > 1").limit(1).count():  # repeated rows
        cut = common.store(cut.dropDuplicates(["node"]), "fragments")

    def counted(pairs: DataFrame, parts: DataFrame, fragments: list[str]) -> DataFrame:
        """pairs with the overlap in each of these fragments, added to shared, and the rest of each set."""
        left = parts.select(F.col("node").alias("x"), *(F.col(p).alias(f"x{p}") for p in fragments))
        right = parts.select(F.col("node").alias("y"), *(F.col(p).alias(f"y{p}") for p in fragments))
        d = pairs.join(left, "x").join(right, "y")
        for p in fragments:
            d = d.withColumns({"shared": F.col("shared") + F.size(F.array_intersect(f"x{p}", f"y{p}")), "rx": F.col("rx") - F.size(f"x{p}"), "ry": F.col("ry") - F.size(f"y{p}")})
        return d.select("x", "y", "nx", "ny", "shared", "rx", "ry")

    # the first fragment alone shows that most pairs can't link
    start = pairs.select("x", "y", "nx", "ny", F.lit(0).alias("shared"), F.col("nx").alias("rx"), F.col("ny").alias("ry"))
    begun = counted(start, cut, names[:1]).where((100 + percent) * (F.col("shared") + F.least("rx", "ry")) >= percent * (F.col("nx") + F.col("ny")))
    begun = common.store(begun, "begun")
    left_over = _ends(begun)
    left_over = F.broadcast(left_over) if common.small(left_over) else left_over
    total = counted(begun, cut.join(left_over, "node", "left_semi"), names[1:])
    links = common.store(total.where(100 * F.col("shared") >= percent * (F.col("nx") + F.col("ny") - F.col("shared"))).select("x", "y"), "links")
    common.drop(chosen, cut, begun)
    return links


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).distinct()


def _may_link(percent: int, n_a: str, at_a: str, n_b: str, at_b: str):
    """Whether two sets can link whose first n-gram in common stands at at_a and at_b: the overlap is in what follows, and has to be this large."""
    over = F.least(F.col(n_a) - F.col(at_a), F.col(n_b) - F.col(at_b))
    return ((100 + percent) * over >= percent * (F.col(n_a) + F.col(n_b))) & (100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b))


def jaccard_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, n_shingles, component_id (the least doc_id that links reach).

    Equal sets are one node. Two linked sets share an n-gram among the first of each in a global order, in which those
    that very many texts have come last. Of the texts that meet at such an n-gram, each is compared with a few centres
    first, and then with every text that it meets there and is not yet in one group with; so a group of copies costs
    few comparisons, and no link between groups is lost. A comparison counts the overlap in each fragment of the order.

    Empty and null texts have no set and form a group of their own; with a null doc_id, component_id is null. Rows with one doc_id
    are one member with the links of all of them. Extra columns are ignored.
    """
    with common.small_batches(docs.sparkSession):
        return _components_of_sets(docs, k, percent)


def _linked(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The nodes of docs(doc_id, text, ...), and (x, y) of the nodes that link."""
    nodes = common.store(_nodes(docs, k), "nodes")
    spark = docs.sparkSession

    frequent = nodes.select(F.explode("votes").alias("h")).groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON_VOTES)
    frequent = frequent.orderBy(F.desc("n"), "h").limit(COMMON_NGRAMS).select("h").toPandas()["h"].to_numpy(dtype=np.int64).view(np.uint64)
    hot = spark.sparkContext.broadcast(np.sort(frequent))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch, 0, CHUNK_BYTES):
                own = [_ordered_prefix(s, hot.value, percent) for s in shingle_sets(data, offsets, k) if len(s)]
                yield pa.RecordBatch.from_arrays([pa.array((np.concatenate(own) if own else np.empty(0, np.uint64)).view(np.int64))], names=["h"])
            common.give_back()

    shared = docs.select("text").mapInArrow(prefixes, "h bigint").groupBy("h").agg(F.count("*").alias("n")).where("n > 1")
    twice = spark.sparkContext.broadcast(bloom(shared, "h"))

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in text_chunks(batch, 0, CHUNK_BYTES):
                cols = ([], [], [], [], [])
                for s in shingle_sets(data, offsets, k):
                    if not len(s):
                        continue
                    p = _ordered_prefix(s, hot.value, percent)
                    at = np.flatnonzero(twice.value.has(p))
                    if len(at):
                        for c, x in zip(cols, (p[at], np.full(len(at), _node(s), np.uint64), np.full(len(at), len(s)), at, np.full(len(at), len(p) - len(at))), strict=True):
                            c.append(x)
                h, node, n, at, alone = (np.concatenate(c) if c else np.empty(0, np.int64) for c in cols)
                yield pa.RecordBatch.from_arrays([pa.array(h.astype(np.uint64).view(np.int64)), pa.array(node.astype(np.uint64).view(np.int64)), pa.array(n.astype(np.int64)), pa.array(at.astype(np.int32)), pa.array(alone.astype(np.int32))], names=["h", "node", "n", "at", "alone"])
            common.give_back()

    # copies have the same postings, which are merged before the shuffle
    met = docs.select("text").mapInArrow(postings, "h bigint, node bigint, n bigint, at int, alone int").distinct()
    met = common.store(met, "postings")

    def orders(c: str):
        node = F.col("node")
        return {"c0": F.struct("alone", F.xxhash64(node, F.lit(0)), "node", "n", "at"), "c1": F.struct(F.xxhash64(node, F.lit(1)), "node", "n", "at"), "c2": F.struct(F.xxhash64(node, F.lit(2)), "node", "n", "at")}[c]

    centres = met.groupBy("h").agg(F.count("*").alias("size"), *(F.min(orders(c)).alias(c) for c in ("c0", "c1", "c2"))).where("size > 1")
    centres = centres.select(F.col("h").alias("ch"), F.explode(F.array_distinct(F.array(*(F.struct(f"{c}.node", f"{c}.n", f"{c}.at") for c in ("c0", "c1", "c2"))))).alias("c"))
    first = met.join(centres, F.col("h") == F.col("ch")).where("node <> c.node").withColumns({"c_n": F.col("c.n"), "c_at": F.col("c.at")}).where(_may_link(percent, "n", "at", "c_n", "c_at"))
    first = _as_pairs(first.select("node", "n", F.col("c.node").alias("other"), F.col("c.n").alias("other_n"))).distinct()
    first = common.store(first, "pairs")
    links = _verify(first, docs, nodes, k, percent)

    # what meets at an n-gram but isn't in one group yet
    group = components(links.select(F.col("x").alias("u"), F.col("y").alias("v")))
    labelled = met.join(group, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = labelled.groupBy("h").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("h")
    left = common.store(labelled.join(mixed, "h", "left_semi"), "open")
    a = left.select("h", *(F.col(c).alias(f"{c}_a") for c in ("node", "n", "at", "component")))
    b = left.select("h", *(F.col(c).alias(f"{c}_b") for c in ("node", "n", "at", "component")))
    both = a.join(b, "h").where("component_a <> component_b AND (n_a < n_b OR n_a = n_b AND node_a < node_b)")
    both = both.where(_may_link(percent, "n_a", "at_a", "n_b", "at_b"))
    rest = _as_pairs(both.select(F.col("node_a").alias("node"), F.col("n_a").alias("n"), F.col("node_b").alias("other"), F.col("n_b").alias("other_n"))).distinct()
    rest = common.store(rest.join(first.select("x", "y"), ["x", "y"], "left_anti"), "pairs")
    more = _verify(rest, docs, nodes, k, percent)

    return nodes, links.unionByName(more)


def _components_of_sets(docs: DataFrame, k: int, percent: int) -> DataFrame:
    nodes, names = _linked(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), k, percent)
    # from sets to documents: a set's least doc_id stands for it, and so do sets that share a doc_id
    sets = nodes.where("n > 0").groupBy("node").agg(F.min("doc_id").alias("doc"))
    if nodes.where("doc_id IS NULL AND n > 0").limit(1).count():  # sets without a doc_id still link those around them
        members = sets.join(components(names.select(F.col("x").alias("u"), F.col("y").alias("v"))), "node")
        by_x = members.join(members.groupBy("component").agg(F.min("doc").alias("v")), "component").where("doc IS NOT NULL").select(F.col("doc").alias("u"), "v")
    else:
        by_x = names.join(sets.select(F.col("node").alias("x"), F.col("doc").alias("u")), "x").join(sets.select(F.col("node").alias("y"), F.col("doc").alias("v")), "y").select("u", "v")
    copies = nodes.where("n > 0").join(sets, "node").where("doc_id <> doc").select(F.col("doc_id").alias("u"), F.col("doc").alias("v"))
    found = components(by_x.unionByName(copies))
    found = found.select(F.col("node").alias("o_id"), "component")
    return nodes.join(found, F.col("doc_id") == F.col("o_id"), "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))


def _as_pairs(df: DataFrame) -> DataFrame:
    swap = F.col("node") > F.col("other")
    return df.select(F.least("node", "other").alias("x"), F.greatest("node", "other").alias("y"), F.when(swap, F.col("other_n")).otherwise(F.col("n")).alias("nx"), F.when(swap, F.col("n")).otherwise(F.col("other_n")).alias("ny"))


def keep_one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of docs, with all their columns, of which one stays of each group of sets that links reach: the one with the least doc_id,
    null last, and of rows that share it the one with the least hashes of its text and of its other columns. Rows without a set (null
    and empty texts, or white space alone) stay, repeated ones too. Other columns may have any names and any values, null included."""
    names, docs = docs.columns, common.plain_names(docs, "doc_id", "text")
    if docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count():
        return _keep_one_by_row(docs, k, percent).toDF(*names)
    groups = common.store(jaccard_components(docs, k, percent), "groups")
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id"))
    gone = F.broadcast(gone) if common.small(gone) else gone
    return docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti").toDF(*names)


def _keep_one_by_row(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """As keep_one_of_each, where a doc_id doesn't tell rows apart: a row's key is its doc_id and two hashes."""
    names = docs.columns
    hashed = [c for c, kind in docs.dtypes if c not in ("doc_id", "text") and "map<" not in kind and "variant" not in kind]
    keys = ["__id", "__th", "__row"]
    docs = docs.withColumns({"__id": F.col("doc_id").cast("long"), "__th": F.xxhash64("text"), "__row": F.xxhash64(F.lit(0), *hashed)})
    with common.small_batches(docs.sparkSession):
        nodes, links = _linked(docs.select(F.col("__id").alias("doc_id"), "text", "__th", "__row"), k, percent)
        group = components(links.select(F.col("x").alias("u"), F.col("y").alias("v")))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("__id"), "__th", "__row")
    sets = nodes.where("n > 0").groupBy("node").agg(F.min(first).alias("first")).join(group, "node", "left")
    stay = sets.groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("first").alias("first")).select("first.__id", "first.__th", "first.__row", F.lit(False).alias("bare"))
    bare = nodes.where("n = 0").select(F.col("doc_id").alias("__id"), "__th", "__row", F.lit(True).alias("bare")).distinct()
    stay = common.store(stay.unionByName(bare), "stay").select(*(F.col(c).alias(f"o{c}") for c in keys), "bare")
    stay = F.broadcast(stay) if common.small(stay) else stay
    kept = docs.join(stay, F.col("__id").eqNullSafe(F.col("o__id")) & (F.col("__th") == F.col("o__th")) & (F.col("__row") == F.col("o__row")))
    # rows that are alike in every column
    return kept.where("NOT bare").dropDuplicates(keys).select(*names).unionByName(kept.where("bare").select(*names))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(common.table(spark, sf_dir, "documents"))
