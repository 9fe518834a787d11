"""Exact top-k by inner product: a dual-tree search over cover trees of queries and data."""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Rows of a data shard and of a query shard, on average; each has a cover tree.
SHARD_ROWS, QUERY_ROWS = 4096, 1024
#: What a task's queries take while they are searched for, about: their numbers and what was found so far.
BLOCK_BYTES = 64 << 20
#: Tasks of the search for each core: more of them copy more, fewer end less evenly.
CELLS_A_CORE = 4
#: Queries and points whose products are made at once, and points while a query still lacks a kth score.
TILE, FIRST = (256, 4096), 512
#: A node with so few points is a leaf; children with fewer than POOL points share one leaf at their parent.
LEAF, POOL = 256, 16
#: A level's covering radius is its parent's by this factor.
SHRINK = 1 / 1.3


class CoverTree:
    """Nodes by number: centre point, covering radius, children; leaves hold the points[lo:hi].

    Each level covers its node's points with balls of a radius smaller by SHRINK, whose centres are points farther apart than it.
    Points and ids lie in the leaves' order, so that a leaf is a slice, as whole numbers of the smallest type that holds them.
    """

    def __init__(self, points: np.ndarray, ids: np.ndarray):
        self.points = points
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.span: list[tuple[int, int]] = []
        order: list[np.ndarray] = []
        self._held = 0
        if len(points):
            far = np.linalg.norm(points - points[0], axis=1)
            self._add(0, np.arange(len(points)), far, order)
        placed = np.concatenate(order) if order else np.empty(0, np.int64)
        self.middle = points[self.centre]  # of each node, its centre's numbers
        self.norm, self.reach = np.linalg.norm(self.middle, axis=1), np.asarray(self.radius)
        self.most = int(np.abs(points).max(initial=0))
        kind = next((t for t in (np.int8, np.int16, np.int32, np.int64) if self.most <= np.iinfo(t).max), np.float64)
        self.points = self.cast = points[placed].astype(kind)
        self.ids, self.span = ids[placed], np.asarray(self.span).reshape(-1, 2)
        del self.centre, self._held

    def numbers(self, kind: type) -> np.ndarray:
        """The points as that type; the last ones are kept."""
        if self.cast.dtype != kind:
            self.cast = self.points.astype(kind)
        return self.cast

    def _node(self, centre: int, radius: float) -> int:
        self.centre.append(centre)
        self.radius.append(radius)
        self.children.append([])
        self.span.append((0, 0))
        return len(self.centre) - 1

    def _leaf(self, node: int, members: np.ndarray, order: list[np.ndarray]) -> int:
        self.span[node] = (self._held, self._held + len(members))
        self._held += len(members)
        order.append(members)
        return node

    def _add(self, centre: int, members: np.ndarray, far: np.ndarray, order: list[np.ndarray]) -> int:
        """members with their distances from the centre."""
        node = self._node(centre, float(far.max(initial=0.0)))
        if len(members) <= LEAF or self.radius[node] == 0:
            return self._leaf(node, members, order)
        reach = self.radius[node] * SHRINK
        own, left, pooled = far <= reach, None, []
        groups = [(centre, members[own], far[own])]
        left = members[~own]
        while len(left):
            new = int(left[0])
            d = np.linalg.norm(self.points[left] - self.points[new], axis=1)
            on = d <= reach
            if on.sum() < POOL:
                pooled.append(left[on])
            else:
                groups.append((new, left[on], d[on]))
            left = left[~on]
        for c, m, d in groups:
            if len(m) < POOL:
                pooled.append(m)
            else:
                self.children[node].append(self._add(c, m, d, order))
        if pooled:
            m = np.concatenate(pooled)
            d = np.linalg.norm(self.points[m] - self.points[centre], axis=1)
            self.children[node].append(self._leaf(self._node(centre, float(d.max())), m, order))
        return node


def quantise(values: np.ndarray, scale: float = 64.0) -> np.ndarray:
    return np.floor(scale * values.astype(np.float64))


class Search:
    """The best k data points of a tree's queries over any number of data trees, as (score, id) with ties to the smaller id."""

    def __init__(self, queries: CoverTree, k: int):
        self.q, self.k = queries, k
        n = len(queries.ids)
        self.score = np.full((n, k), _LEAST)  # of each query, best first; _LEAST where there is none yet
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.bound = np.full(len(queries.norm), -np.inf)  # of each query node, the least of its queries' kth scores

    def meet(self, data: CoverTree) -> None:
        """Search one more tree; what was found before bounds what can still count."""
        if not len(self.q.ids) or not len(data.ids):
            return
        q, kind = self.q, _kind(self.q, data)
        queries, points = q.numbers(kind), data.numbers(kind)
        up = self._above(data)
        alive = (~(up < self.bound[:, None])).tolist()
        pairs, leaves = [(0, 0)], {}
        while pairs:
            a, b = pairs.pop()
            if not alive[a][b]:
                continue
            qc, dc = q.children[a], data.children[b]
            if not qc and not dc:
                leaves.setdefault(a, []).append(b)
            elif dc and (not qc or data.radius[b] >= q.radius[a]):
                pairs += [(a, c) for c in dc]
            else:
                pairs += [(c, b) for c in qc]
        for a, met in leaves.items():
            self._compare(a, np.array(met), up[a], queries, points, data)
        for a in reversed(range(len(self.bound))):  # children have greater numbers
            if q.children[a]:
                self.bound[a] = self.bound[q.children[a]].min()

    def _above(self, data: CoverTree) -> np.ndarray:
        """For each pair of a query node and a data node: no product of a query and a point under them is larger."""
        ra, rb = self.q.reach[:, None], data.reach
        up = self.q.middle @ data.middle.T + self.q.norm[:, None] * rb + data.norm * ra + ra * rb
        return up + 1e-9 * (1 + (self.q.norm[:, None] + ra) * (data.norm + rb))  # what rounding may take off, however much cancels out

    def _compare(self, a: int, leaves: np.ndarray, up: np.ndarray, queries: np.ndarray, points: np.ndarray, data: CoverTree) -> None:
        """The queries of leaf a with data leaves, those first that can hold the largest products, about a tile of them at once."""
        lo, hi = self.q.span[a]
        leaves = leaves[np.argsort(-up[leaves], kind="stable")]
        while len(leaves := leaves[~(up[leaves] < self.bound[a])]):
            wide = TILE[1] if self.bound[a] > _LEAST else FIRST
            n = int(np.searchsorted(np.cumsum(np.diff(data.span[leaves])), wide)) + 1
            cols = np.concatenate([np.arange(*data.span[b]) for b in leaves[:n]])
            for c in range(0, len(cols), wide):
                at = cols[c : c + wide]
                near, ids = points[at].T, data.ids[at]
                for r in range(lo, hi, TILE[0]):
                    self._tile(slice(r, min(r + TILE[0], hi)), queries[r : min(r + TILE[0], hi)] @ near, ids)
            self.bound[a] = self.score[lo:hi, -1].min()
            leaves = leaves[n:]

    def _tile(self, rows: slice, scores: np.ndarray, data_ids: np.ndarray) -> None:
        k, floor = self.k, self.score[rows, -1]
        high = scores >= floor.astype(scores.dtype)[:, None]
        if np.count_nonzero(high) > 4 * k * len(scores) and scores.shape[1] > k + 1:  # one more than k, as a query's own row may be among them
            high &= scores >= np.partition(scores, -k - 1, axis=1)[:, -k - 1, None]
        row, col = np.divmod(np.flatnonzero(high), scores.shape[1])
        new, ids = scores[row, col].astype(np.int64), data_ids[col]
        good = ((new > floor[row]) | (ids < self.id[rows, -1][row])) & (ids != self.q.ids[rows][row])
        row, new, ids = row[good] + rows.start, new[good], ids[good]
        if not len(row):
            return
        some = np.unique(row)
        row, new, ids = np.concatenate([np.repeat(some, k), row]), np.concatenate([self.score[some].ravel(), new]), np.concatenate([self.id[some].ravel(), ids])
        order = np.lexsort((ids, ~new, row))  # ~ turns the order round, without overflow
        best = order[np.searchsorted(row[order], some)[:, None] + np.arange(k)]
        self.score[some], self.id[some] = new[best], ids[best]

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, id, score) of everything found."""
        row, place = np.nonzero(self.score > _LEAST)
        return self.q.ids[row], self.id[row, place], self.score[row, place]


#: Below every score.
_LEAST = np.iinfo(np.int64).min


def _kind(a: CoverTree, b: CoverTree) -> type:
    """What holds all inner products of whole numbers exactly: floats below 2**24 or 2**53, or else 64-bit integers."""
    most = a.most * b.most * max(1, a.points.shape[1])
    if most >= 2**63:
        raise OverflowError("inner products don't fit 64 bits")
    return np.float32 if 0 < most < 2**24 else np.float64 if most < 2**53 else np.int64


def _pack(table: pa.Table, scale: float) -> bytes:
    """The cover tree of a group's vectors; of rows that share an id, the least vector counts."""
    ids = np.asarray(table["id"])
    points = quantise(np.asarray(table["vector"].combine_chunks().flatten()).reshape(len(ids), -1), scale)
    order = np.lexsort((*points.T[::-1], ids)) if len(np.unique(ids)) < len(ids) else np.argsort(ids)
    ids, points = ids[order], points[order]
    one = np.ones(len(ids), dtype=bool)
    one[1:] = ids[1:] != ids[:-1]
    return pickle.dumps(CoverTree(points[one], ids[one]), protocol=5)


def grid(n_queries: int, query_bytes: int, n_data: int, data_bytes: int, k: int, cells: int) -> tuple[int, int]:
    """(blocks, strips): queries go to so many blocks and data to so many strips; about `cells` pairs of them, each a task's.

    data_bytes: a byte for each component, as data are sent once for each block; of each strip, k rows a query are sent on. Both
    weigh alike where blocks = sqrt(cells * rows sent on / data). A block is no larger than BLOCK_BYTES, whatever the tables' size.
    """
    found = 24 * k * n_queries  # of one strip
    even = round(math.sqrt(cells * found / max(1, data_bytes)))
    least = -(-(12 * query_bytes + 16 * k * n_queries) // BLOCK_BYTES)
    blocks = max(1, least, min(even, cells, -(-n_queries // QUERY_ROWS)))
    return blocks, max(1, min(-(-cells // blocks), -(-n_data // SHARD_ROWS)))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, scale: float = 64.0) -> DataFrame:
    """(query_id, rank, id, score): for each row of queries(id, vector), the k largest inner products with rows of vectors(id, vector).

    Components become floor(scale * x). A row is no candidate for a query with its own id; ties go to the smaller id. Rows
    with a null id or vector, or with null or non-finite components, take no part; vectors meet those of their own length.
    Of rows that share an id one counts. Extra columns are ignored; with no candidates or no queries the result is empty.
    Scores are exact whole numbers; vectors so large that a score might not fit 64 bits raise OverflowError.

    Data and queries go to shards by id, and each shard gets a cover tree. Query trees are dealt to blocks and data trees to strips
    (see grid), and each pair of a block and a strip is one task's: it holds its queries, the strip's trees go past them one by one,
    and each is searched under the bounds found so far. A query's best of all strips are ranked. Nothing is joined or broadcast.
    """
    spark = vectors.sparkSession

    def clean(df: DataFrame) -> DataFrame:
        fine = F.forall("vector", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))  # NaN is above infinity
        kind = "array<float>" if df.schema["vector"].dataType.simpleString() == "array<float>" else "array<double>"
        return df.select(F.col("id").cast("long").alias("id"), F.col("vector").cast(kind).alias("vector")).where("id IS NOT NULL AND vector IS NOT NULL").where(fine).withColumn("dim", F.size("vector")).where("dim > 0")

    def size(df: DataFrame) -> tuple[int, int]:
        return df.agg(F.count("*"), F.coalesce(F.sum("dim"), F.lit(0))).first()

    def trees(df: DataFrame, n: int, name: str) -> DataFrame:
        def build(table: pa.Table) -> pa.Table:
            return pa.table({name: table[name].slice(0, 1), "dim": table["dim"].slice(0, 1), "tree": pa.array([_pack(table, scale)], pa.binary())})

        put = df.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int"))
        return common.store(put.groupBy(name, "dim").applyInArrow(build, f"{name} int, dim int, tree binary"), f"{name}-trees")

    data, asked = clean(vectors), clean(queries)
    (n_data, data_bytes), (n_queries, query_bytes) = size(data), size(asked)
    blocks, strips = grid(n_queries, query_bytes, n_data, data_bytes, k, min(common.partitions(spark), CELLS_A_CORE * spark.sparkContext.defaultParallelism))
    shards = trees(data, max(1, -(-n_data // SHARD_ROWS)), "shard")
    asking = trees(asked, max(blocks, -(-n_queries // QUERY_ROWS)), "block")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, Search]] = []
        for batch in batches:
            for i in range(batch.num_rows):
                tree, dim = pickle.loads(batch.column("tree")[i].as_py()), batch.column("dim")[i].as_py()
                if not batch.column("data")[i].as_py():
                    held.append((dim, Search(tree, k)))
                    continue
                for own, one in held:
                    if own == dim:
                        one.meet(tree)
        for _, one in held:
            a, b, s = one.results()
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(s, pa.int64())], names=["query_id", "id", "score"])

    def dealt(df: DataFrame, first: Column, others: Column, is_data: bool) -> DataFrame:
        """df's trees, once for each cell of its row or column of the grid."""
        return df.select(F.explode(F.transform(others, lambda x: (first + x).cast("int"))).alias("cell"), F.lit(is_data).alias("data"), "dim", "tree")

    row = dealt(asking, F.col("block") % blocks * strips, F.sequence(F.lit(0), F.lit(strips - 1)), False)
    column = dealt(shards, F.col("shard") % strips, F.sequence(F.lit(0), F.lit((blocks - 1) * strips), F.lit(strips)), True)
    met = row.union(column).repartitionById(blocks * strips, "cell").sortWithinPartitions("data").select("data", "dim", "tree")
    found = met.mapInArrow(search, "query_id bigint, id bigint, score bigint")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def op3_top_k(spark: SparkSession, sf_dir: str, every: int = 20, k: int = 20) -> DataFrame:
    rows = common.table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return top_k(rows, rows.where(F.col("id") % every == 0), k).withColumnRenamed("id", "vec_id")
