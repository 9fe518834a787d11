"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Rows of a block, on average; a source has as many blocks as that takes.
BLOCK_ROWS = 64
#: Blocks, rows of a shard, equal rows or sources that are summed up together in one task.
CELL = 4096
#: Sources whose plans may be broadcast: some 700 bytes each.
FEW_SOURCES = 20_000
#: A prime above any number of blocks: multiplying by it modulo that number permutes the blocks.
PRIME = 2**31 - 1
#: Weights that sources get by turns, in code point order, null last.
WEIGHTS = (5.0, 2.0, 1.0)
TOTAL_SHARE = 1.5
MAX_REPEATS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, most: float = MAX_REPEATS) -> DataFrame:
    """sizes(source, source_size, ...) with target: total_share of all sizes, shared by weight, none above most times its own.

    Water filling in closed form: with the sources by ascending most * size / weight, those up to the last that its share
    of what is left would lift over its limit get the limit, and the rest share by weight. One row a source, so the windows over
    all of them are small; sources with no words have target 0.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    d = sizes.withColumn("weight", weight).withColumn("limit", most * F.col("source_size"))
    order = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    d = d.withColumns({
        "left": F.lit(total_share) * F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)),
        "open": F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)),
    })
    d = d.withColumn("level", F.col("left") / F.col("open"))
    # the level of the first source that stays under its limit holds for all after it
    d = d.withColumn("free", F.col("level") * F.col("weight") <= F.col("limit"))
    d = d.withColumn("water", F.min(F.when(F.col("free"), F.struct(F.col("limit") / F.col("weight"), F.col("level").alias("level")))).over(every))
    return d.withColumn("target", F.least(F.col("limit"), F.coalesce(F.col("water.level") * F.col("weight"), F.col("limit"))).cast("double")).drop("weight", "limit", "left", "open", "level", "free", "water")


def _unit(seed: int, *columns: Column) -> Column:
    """Uniform in [0, 1), from the hash of the values."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11) / F.lit(float(1 << 53))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value worked out once, however often body has it; plans would hold a copy of it for each use."""
    return F.transform(F.array(value), body)[0]


def _log_factorial(n: Column) -> Column:
    """ln n! by Stirling's series, eight places up, where its error is below 1e-10."""
    z = n + 8.0
    series = (z - 0.5) * F.ln(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * F.pow(z, 3.0)) + 1 / (1260 * F.pow(z, 5.0))
    return series - F.ln((n + 1.0) * (n + 2.0) * (n + 3.0)) - F.ln((n + 4.0) * (n + 5.0)) - F.ln((n + 6.0) * (n + 7.0))


def hypergeometric(total: Column, marked: Column, drawn: Column, unit: Column) -> Column:
    """Marked items among `drawn` of `total` without replacement: the law's inverse at `unit`, which is uniform.

    Values are met from the mode outwards, above and below by turns, until their probabilities pass `unit`; twelve deviations each way,
    so that the steps grow with the root of the counts. The result always lies in the law's range, so counts come out even.
    """

    def log_choose(a: Column, b: Column, sign: float = 1.0) -> list[Column]:
        return [F.struct(x.alias("x"), F.lit(y * sign).alias("sign")) for x, y in ((a, 1.0), (b, -1.0), (a - b, -1.0))]

    def of_range(v: Column) -> Column:
        n, k, d = v["n"], v["k"], v["d"]
        low, high = F.greatest(F.lit(0.0), d + k - n), F.least(k, d)
        mode = F.least(high, F.greatest(low, F.floor((d + 1) * (k + 1) / (n + 2)).cast("double")))
        return _let(F.struct(n.alias("n"), k.alias("k"), d.alias("d"), v["u"].alias("u"), low.alias("low"), high.alias("high"), mode.alias("mode")), of_mode)

    def of_mode(v: Column) -> Column:
        n, k, d, mode = v["n"], v["k"], v["d"], v["mode"]
        terms = F.array(*log_choose(k, mode), *log_choose(n - k, d - mode), *log_choose(n, d, -1.0))
        at_mode = F.exp(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t["sign"] * _let(t["x"], _log_factorial)))
        return _let(at_mode, lambda p: walk(v, p))

    def walk(v: Column, at_mode: Column) -> Column:
        n, k, d, low, high, mode = (v[x] for x in ("n", "k", "d", "low", "high", "mode"))
        spread = F.sqrt(d * (k / n) * (1 - k / n) * (n - d) / F.greatest(n - 1, F.lit(1.0)))
        steps = F.least(high - low, F.ceil(12 * spread) + 30).cast("int")
        start = F.struct(mode.alias("up"), mode.alias("down"), at_mode.alias("p"), at_mode.alias("q"), (v["u"] - at_mode).alias("left"), F.when(v["u"] < at_mode, mode).alias("out"))

        def outwards(acc: Column, _: Column) -> Column:
            p = acc["p"] * (k - acc["up"]) * (d - acc["up"]) / ((acc["up"] + 1) * (n - k - d + acc["up"] + 1))
            q = acc["q"] * acc["down"] * (n - k - d + acc["down"]) / ((k - acc["down"] + 1) * (d - acc["down"] + 1))
            both = F.struct(F.when(acc["up"] < high, p).otherwise(0.0).alias("p"), F.when(acc["down"] > low, q).otherwise(0.0).alias("q"))

            def step(x: Column) -> Column:
                out = F.when(acc["left"] < x["p"], acc["up"] + 1).when(acc["left"] < x["p"] + x["q"], acc["down"] - 1)
                return F.struct((acc["up"] + 1).alias("up"), (acc["down"] - 1).alias("down"), x["p"].alias("p"), x["q"].alias("q"), (acc["left"] - x["p"] - x["q"]).alias("left"), out.alias("out"))

            return F.when(acc["out"].isNotNull(), acc).otherwise(_let(both, step))

        return F.coalesce(F.aggregate(F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>")), start, outwards, lambda acc: acc["out"]), mode)

    asked = F.struct(total.cast("double").alias("n"), marked.cast("double").alias("k"), drawn.cast("double").alias("d"), unit.alias("u"))

    def answer(v: Column) -> Column:
        plain = F.when((v["k"] == 0) | (v["d"] == 0), F.lit(0.0)).when(v["d"] == v["n"], v["k"])
        return F.coalesce(plain, of_range(v)).cast("long")

    return _let(asked, answer)


def _deal(of: Column, due: Column, total: Column, seed: int, *keys: Column) -> Column:
    """How many of the `due` items each element of of(name, quota, ...) gives: one multivariate hypergeometric draw, element by element."""
    start = F.struct(total.cast("long").alias("left"), due.cast("long").alias("due"), F.array().cast("array<bigint>").alias("takes"))

    def take(acc: Column, x: Column) -> Column:
        got = hypergeometric(acc["left"], x["quota"], acc["due"], _unit(seed, *keys, x["name"].isNull(), x["name"]))
        return _let(got, lambda n: F.struct((acc["left"] - x["quota"]).alias("left"), (acc["due"] - n).alias("due"), F.concat(acc["takes"], F.array(n)).alias("takes")))

    return F.aggregate(of, start, take, lambda acc: acc["takes"])


def split_quotas(quotas: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """quotas(source, quota) to (shard, source, quota, first): a binary tree over the shards.

    A node holds exact quotas for its shards. Its left child gets the share of the node's blocks that its shards
    are due, and which sources they come from is drawn from the multivariate hypergeometric law; the right child gets the others. Leaves hold
    exact quotas for one shard. `first` is where the leaf's blocks begin in the source's permutation, so leaves hold disjoint runs.
    The draw goes over groups of sources and then inside each, which is the same law, so that no row holds all sources.
    """
    groups = max(1, -(-quotas.count() // CELL))
    nodes = quotas.select(F.lit(0).alias("lo"), F.lit(n_shards).alias("hi"), F.pmod(F.xxhash64("source"), F.lit(groups)).alias("group"), "source", "quota", F.lit(0).cast("long").alias("first"))
    width = n_shards
    while width > 1:
        item = F.struct(F.col("source").alias("name"), "quota", "first")
        packed = nodes.groupBy("lo", "hi", "group").agg(F.sort_array(F.collect_list(item)).alias("of"), F.sum("quota").alias("held"))
        mid = F.col("lo") + F.floor((F.col("hi") - F.col("lo")) / 2).cast("int")

        def share(held: str) -> Column:
            return F.floor(F.col(held) * (mid - F.col("lo")) / (F.col("hi") - F.col("lo"))).cast("long")

        if groups == 1:  # the only group gives all that is due
            packed = packed.withColumn("due", share("held"))
        else:
            whole = packed.groupBy("lo", "hi").agg(F.sort_array(F.collect_list(F.struct(F.col("group").cast("string").alias("name"), F.col("held").alias("quota"), "group"))).alias("groups"), F.sum("held").alias("all"))
            whole = whole.withColumn("takes", _deal(F.col("groups"), share("all"), F.col("all"), seed, F.col("lo"), F.col("hi")))
            dealt = whole.select("lo", "hi", F.explode(F.arrays_zip("groups", "takes")).alias("x")).select(F.col("lo").alias("d_lo"), F.col("hi").alias("d_hi"), F.col("x.groups.group").alias("d_group"), F.col("x.takes").alias("due"))
            packed = packed.join(dealt, (F.col("lo") == F.col("d_lo")) & (F.col("hi") == F.col("d_hi")) & (F.col("group") == F.col("d_group")))
        packed = packed.withColumn("takes", _deal(F.col("of"), F.col("due"), F.col("held"), seed + 1, F.col("lo"), F.col("hi")))
        rows = packed.select("lo", mid.alias("mid"), "hi", "group", F.explode(F.arrays_zip("of", "takes")).alias("x"))
        name, whose = F.col("x.of.name").alias("source"), F.col("group")
        left = F.struct(F.col("lo"), F.col("mid").alias("hi"), whose, name, F.col("x.takes").alias("quota"), F.col("x.of.first").alias("first"))
        right = F.struct(F.col("mid").alias("lo"), F.col("hi"), whose, name, (F.col("x.of.quota") - F.col("x.takes")).alias("quota"), (F.col("x.of.first") + F.col("x.takes")).alias("first"))
        same = F.struct(F.col("lo"), F.col("hi"), whose, name, F.col("x.of.quota").alias("quota"), F.col("x.of.first").alias("first"))
        nodes = rows.select(F.inline(F.when(F.col("hi") - F.col("lo") <= 1, F.array(same)).otherwise(F.array(left, right))))
        nodes = nodes if groups == 1 else common.store(nodes, "mix-nodes")
        width = (width + 1) // 2
    return nodes.select(F.col("lo").alias("shard"), "source", "quota", "first")


def _ranked(df: DataFrame, by: list[str], cell: Column, order: list[Column], name: str) -> DataFrame:
    """df with the rank, from 0, of each row among those with the same `by`: ranks in cells of at most about CELL rows, and what the cells before hold.

    Cells have to be in the order of the rows."""
    df = df.withColumn("cell", cell)
    counts = df.groupBy(*by, "cell").agg(F.count("*").alias("held"))
    before = F.sum("held").over(Window.partitionBy(*by).orderBy("cell")) - F.col("held")
    counts = counts.select(*(F.col(c).alias(f"c_{c}") for c in (*by, "cell")), before.alias("start"))
    counts = F.broadcast(counts) if common.small(counts) else counts
    inside = F.row_number().over(Window.partitionBy(*by, "cell").orderBy(*order)) - 1
    df = df.withColumn("within", inside)
    met = df.join(counts, [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in (*by, "cell")])
    return met.withColumn(name, F.col("within") + F.col("start")).drop("cell", "within", "start", *(f"c_{c}" for c in (*by, "cell")))


class Mixture:
    """The plan of a mix: `rows` has row (the kept columns), key, source, size, source_size, target and draws (array of copy, block's
    turn and shard); `leaves` has each shard's quotas."""

    def __init__(self, rows: DataFrame, leaves: DataFrame, seed: int):
        self.rows, self.leaves, self.seed = rows, leaves, seed

    def drawn(self) -> DataFrame:
        """(key, source, row, copy, turn, shard, shuffle): each draw of a row; shuffle orders a shard's rows at random."""
        d = self.rows.select("key", "source", "row", F.explode("draws").alias("d")).select("key", "source", "row", "d.copy", "d.turn", "d.shard")
        return d.withColumn("shuffle", F.shiftrightunsigned(F.xxhash64(F.lit(self.seed + 2), "key", "copy"), 1))


def _with_keys(docs: DataFrame, keep: list[str], seed: int) -> DataFrame:
    """(row, source, size, key) of docs: key is the hash of doc_id, source and text, and for rows alike in all of them of their number too."""
    source = F.col("source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in keep)).alias("row"), source.alias("source"), word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", source.isNull(), source, F.col("text").isNull(), "text").alias("key"), F.monotonically_increasing_id().alias("at"))
    base = common.store(base, "mix-rows")
    twice = base.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    if not twice.limit(1).count():
        return base.drop("at")
    # rows alike are numbered as they lie; which of them has which number makes no difference
    alike = _ranked(base.select("key", "at").join(twice, "key", "left_semi"), ["key"], F.shiftright("at", 12), [F.col("at")], "number")
    alike = common.store(alike.where("number > 0").select(F.col("at").alias("a_at"), "number"), "mix-alike")
    alike = F.broadcast(alike) if common.small(alike) else alike
    met = base.join(alike, F.col("at") == F.col("a_at"), "left")
    return met.withColumn("key", F.when(F.col("number").isNull(), F.col("key")).otherwise(F.xxhash64("key", "number"))).drop("at", "a_at", "number")


def plan_mixture(docs: DataFrame, n_shards: int = 16, seed: int = 9, weights: tuple[float, ...] = WEIGHTS, total_share: float = TOTAL_SHARE, keep: list[str] | None = None) -> Mixture:
    """Plan the mix of docs(doc_id, text, source); `keep` are the columns that rows carry along, by default doc_id.

    Each source's rows fall into blocks by hash, and its blocks stand in a random order, another one in each epoch. A target of k sizes and
    a rest takes every block k times, and once more the blocks that the rest covers, from the first on; of the block at the edge it takes,
    in random order, every row that still fits. The number of those draws is the source's quota. The splitting tree deals the
    quotas to the shards, and each shard draws its own run of the source's blocks, epoch by epoch.

    Nulls: a null source is one source, a null or empty text has size 0 and counts for nothing, a null doc_id is an id. Repeated
    rows are dealt and taken each for itself. A very long text is one row, so a target is missed by less than the size of a row
    that no longer fits. Without a column source all rows are one source; other columns are ignored, whatever their names. An empty
    table has an empty plan.
    """
    base = _with_keys(docs, keep or ["doc_id"], seed)
    sizes = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    sizes = targets(sizes, weights, total_share).withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("long")).withColumn("whole", whole)
    sizes = common.store(sizes.withColumn("rest", F.greatest(F.lit(0.0), F.col("target") - F.col("whole") * F.col("source_size"))), "mix-targets")
    few = common.small(sizes, FEW_SOURCES)

    def by_source(df: DataFrame, of: DataFrame, *cols: str) -> DataFrame:
        of = of.select(F.col("source").alias("s_source"), *cols)
        return df.join(F.broadcast(of) if few else of, F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")

    def turn(epoch: Column) -> Column:
        """Where a row's block stands in this epoch."""
        n = F.col("blocks")
        return F.pmod(F.pmod(F.col("key"), n) * F.pmod(F.lit(PRIME).cast("long"), n) + F.pmod(F.xxhash64(F.lit(seed), F.col("source"), epoch), n), n)

    # which blocks the rest covers: first the cell of blocks, then the block, then the rows
    asked = by_source(base.drop("row"), sizes.where("rest > 0"), "blocks", "whole", "rest").withColumn("last", turn(F.col("whole")))
    words = common.store(asked.groupBy("source", "last").agg(F.sum("size").alias("words"), F.first("rest").alias("rest")), "mix-blocks")
    cells = words.groupBy("source", F.shiftright("last", 12).alias("cell")).agg(F.sum("words").alias("words"), F.first("rest").alias("rest"))

    def edge(df: DataFrame, at: str) -> DataFrame:
        """The row of each source inside which the rest ends, with what is left of the rest there."""
        line = Window.partitionBy("source").orderBy(at)
        df = df.withColumn("room", F.col("rest") - (F.sum("words").over(line) - F.col("words")))
        return df.where("room >= 0 AND room < words").select("source", at, "room")

    cell = edge(cells, "cell").select(F.col("source").alias("c_source"), F.col("cell").alias("c_cell"), F.col("room").alias("c_room"))
    inner = words.join(F.broadcast(cell) if few else cell, F.col("source").eqNullSafe(F.col("c_source")) & (F.shiftright("last", 12) == F.col("c_cell")))
    edges = common.store(edge(inner.select("source", "last", "words", F.col("c_room").alias("rest")), "last"), "mix-edges").withColumnRenamed("last", "edge")
    at_edge = by_source(asked, edges, "edge", "room").where("last = edge")
    # a block's rows are dealt by hash, so this array is short; what doesn't fit once doesn't fit later
    line = at_edge.groupBy("source", "edge").agg(F.sort_array(F.collect_list(F.struct(F.xxhash64(F.lit(seed + 1), "key").alias("order"), "key", "size"))).alias("of"), F.first("room").alias("room"))
    start = F.struct(F.col("room").alias("room"), F.array().cast("array<bigint>").alias("keys"))

    def fit(acc: Column, x: Column) -> Column:
        on = x["size"] <= acc["room"]
        return F.struct((acc["room"] - F.when(on, x["size"]).otherwise(0)).alias("room"), F.when(on, F.concat(acc["keys"], F.array(x["key"]))).otherwise(acc["keys"]).alias("keys"))

    line = line.select(F.col("source").alias("e_source"), "edge", F.aggregate("of", start, fit, lambda acc: acc["keys"]).alias("some"))
    plan = sizes.join(line, F.col("source").eqNullSafe(F.col("e_source")), "left").drop("e_source")
    plan = plan.withColumns({"edge": F.coalesce("edge", F.lit(0)), "some": F.coalesce("some", F.array().cast("array<bigint>"))})
    plan = common.store(plan.withColumn("quota", F.col("whole") * F.col("blocks") + F.col("edge") + (F.size("some") > 0).cast("int")), "mix-plan")

    leaves = common.store(split_quotas(plan.select("source", "quota"), n_shards, seed), "mix-leaves")
    runs = leaves.where("quota > 0").groupBy(F.col("source").alias("r_source")).agg(F.sort_array(F.collect_list(F.struct("first", "shard"))).alias("runs"))
    plan = common.store(plan.join(runs, F.col("source").eqNullSafe(F.col("r_source")), "left").drop("r_source"), "mix-plan")

    rows = by_source(base, plan, "source_size", "target", "blocks", "whole", "edge", "some", "runs")

    def draw(epoch: Column) -> Column:
        at = turn(epoch)
        on = (epoch < F.col("whole")) | (at < F.col("edge")) | (at == F.col("edge")) & F.array_contains("some", F.col("key"))
        nth = F.size(F.filter("runs", lambda r: r["first"] <= epoch * F.col("blocks") + at))
        return F.when(on, F.struct(epoch.alias("copy"), at.alias("turn"), F.element_at("runs", nth)["shard"].alias("shard")))

    draws = F.filter(F.transform(F.sequence(F.lit(0), F.col("whole")), draw), lambda x: x.isNotNull())
    return Mixture(rows.withColumn("draws", draws).drop("blocks", "whole", "edge", "some", "runs"), leaves, seed)


def _placed(plan: Mixture, drawn: DataFrame) -> DataFrame:
    """drawn with position: the place of each draw in its shard's random order, from 0, gapless."""
    cells = max(1, -(-drawn.count() // CELL))  # of each shard, with fewer rows the more shards there are
    cell = F.floor(F.col("shuffle") / F.lit(float(1 << 63)) * cells)
    return _ranked(drawn, ["shard"], cell, [F.col("shuffle"), F.col("key"), F.col("copy")], "position")


def mix(docs: DataFrame, n_shards: int = 16, seed: int = 9, **options) -> DataFrame:
    """The mix itself: (shard, position, doc_id, source, copy), each shard's rows shuffled in it. Nulls and repeated rows as in plan_mixture."""
    plan = plan_mixture(docs, n_shards, seed, **options)
    return _placed(plan, plan.drawn()).select("shard", "position", "row.doc_id", "source", "copy")


def mixed_rows(docs: DataFrame, n_shards: int = 16, seed: int = 9, **options) -> DataFrame:
    """The rows of docs, with all their columns, as often as the mix takes them; rows that it doesn't take are gone.

    They come shard after shard, each shard's rows in its random order, dealt out by ranges so that no task has to hold a shard. Nulls in
    any column, repeated rows and long texts are carried as they are; columns may have any names.
    """
    plan = plan_mixture(docs, n_shards, seed, keep=docs.columns, **options)
    n = common.partitions(docs.sparkSession)
    return plan.drawn().repartitionByRange(n, "shard", "shuffle").sortWithinPartitions("shard", "shuffle", "key", "copy").select("row.*")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a document, with places: the shard and the position there of each time that it is taken."""
    plan = plan_mixture(common.table(spark, sf_dir, "documents"))
    drawn = common.store(plan.drawn().drop("row"), "mix-draws")
    places = _placed(plan, drawn).groupBy(F.col("key").alias("p_key")).agg(F.sort_array(F.collect_list(F.struct("shard", "position"))).alias("places"))
    rows = plan.rows.join(places, F.col("key") == F.col("p_key"), "left")
    return rows.select("row.doc_id", "size", "source_size", "target", (F.size("draws") * F.col("size")).alias("taken"), F.coalesce("places", F.array().cast("array<struct<shard:int,position:bigint>>")).alias("places"))
