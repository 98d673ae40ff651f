"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from tidegauge.llm.arrow import cut

SHARD_ROWS = 8192
LEAF_ROWS = 192


def integer_vector(vector: Column) -> Column:
    """``floor(256 x)`` of every component; null if a component is null or not finite."""
    usable = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.when(
        usable, F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("bigint"))
    )


class BallTree:
    """Balls around halves of the points, split along the widest of a few directions.

    Inner products of integers are exact: in doubles while they stay below 2**53, else as
    64-bit integers.
    """

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.points = ids[order], points[order]
        self.real = self.points.astype(np.float64)
        self.largest = float(np.abs(self.real).max(initial=0.0))
        self.rows: list[np.ndarray | None] = []
        self.children: list[tuple[int, int] | None] = []
        centers, radii = [], []
        todo = [np.arange(len(ids))]
        while todo:  # in the order of the nodes' numbers
            rows = todo.pop(0)
            part = self.real[rows]
            center = part.mean(0) if len(rows) else np.zeros(points.shape[1])
            apart = np.sqrt(((part - center) ** 2).sum(1))
            centers.append(center)
            radii.append(apart.max(initial=0.0))
            if len(rows) <= LEAF_ROWS:
                self.rows.append(rows)
                self.children.append(None)
                continue
            far = part[apart.argmax()]
            farther = part[((part - far) ** 2).sum(1).argmax()]
            along = part @ (farther - far)
            half = len(rows) // 2
            split = np.argpartition(along, half)  # halves by count, so equal points end too
            first = len(self.rows) + 1 + len(todo)
            self.rows.append(None)
            self.children.append((first, first + 1))
            todo += [rows[np.sort(split[:half])], rows[np.sort(split[half:])]]
        self.centers, self.radii = np.array(centers), np.array(radii)
        self.visited = 0

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """An upper bound of the inner product of each query with the points of each node."""
        norms = np.sqrt((queries**2).sum(1))
        upper = queries @ self.centers.T + norms[:, None] * self.radii
        return upper + 1e-6 + 1e-9 * np.abs(upper)

    def search(
        self, query: np.ndarray, upper: np.ndarray, own: int, k: int, least: float
    ) -> tuple[np.ndarray, np.ndarray]:
        """The k best ids and scores, ties to smaller ids, of those that score ``least`` or more.

        Nodes are taken by their bound, best first, until none can reach the current kth score.
        """
        exact = self.largest * float(np.abs(query).max(initial=0)) * len(query) < 2**53
        points = self.real if exact else self.points
        query = query.astype(points.dtype)
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        heap = [(-upper[0], 0)]
        while heap and -heap[0][0] >= least:
            _, node = heapq.heappop(heap)
            if self.children[node]:
                for child in self.children[node]:
                    if upper[child] >= least:
                        heapq.heappush(heap, (-upper[child], child))
                continue
            self.visited += 1
            rows = self.rows[node]
            found = points[rows] @ query
            good = np.flatnonzero((found >= least) & (self.ids[rows] != own))
            if not len(good):
                continue
            ids = np.concatenate([ids, self.ids[rows[good]]])
            scores = np.concatenate([scores, found[good].astype(np.int64)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                least = max(least, float(scores[-1]))
        return ids, scores


_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("query_id", "query_no", "vec_id", "score")]
)


def _search(dealt: DataFrame, k: int) -> DataFrame:
    """Search each shard's tree with the queries that were sent to it.

    Within a task a shard's points come before its queries; only one tree is held at a time.
    """
    arrow_schema = to_arrow_schema(_SCHEMA)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, tree, points, ids = None, None, [], []
        for batch in batches:
            out: list[tuple] = []
            rows = batch.to_pydict()
            numbers = list(zip(rows["shard"], rows["dims"], strict=True))
            at = 0
            while at < len(numbers):
                end = at
                kind = rows["kind"][at]
                while (
                    end < len(numbers) and numbers[end] == numbers[at] and rows["kind"][end] == kind
                ):
                    end += 1
                if numbers[at] != shard:
                    shard, tree, points, ids = numbers[at], None, [], []
                part = np.array(rows["q"][at:end], np.int64).reshape(end - at, -1)
                if kind == 0:
                    points.append(part)
                    ids += rows["vec_id"][at:end]
                elif points:
                    tree = tree or BallTree(np.array(ids, np.int64), np.concatenate(points))
                    upper = tree.bounds(part.astype(np.float64))
                    for i in range(at, end):
                        least = rows["least"][i]
                        found = tree.search(
                            part[i - at], upper[i - at], rows["vec_id"][i], k,
                            -np.inf if least is None else least,
                        )
                        out += [
                            (rows["vec_id"][i], rows["query_no"][i], int(v), int(s))
                            for v, s in zip(*found, strict=True)
                        ]
                at = end
            columns = list(zip(*out, strict=True)) if out else [[]] * 4
            arrays = [pa.array(c, pa.int64()) for c in columns]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow_schema)

    deal = dealt.repartition("shard", "dims").sortWithinPartitions("shard", "dims", "kind")
    return deal.mapInArrow(run, _SCHEMA)


def top_k(frame: DataFrame, queries: Column, k: int = 5) -> DataFrame:
    """Rows of ``(query_id, rank, vec_id, score)`` from rows of ``(vec_id, embedding)``.

    The k highest inner products of each query row with all rows of another id, ties to the
    smaller id; fewer if there are fewer. Vectors are compared as ``floor(256 x)``. Rows without
    an id or a usable vector take no part; vectors of different lengths never meet. A repeated
    row counts once; a repeated id with different vectors counts by each. Other columns are left
    behind.

    Every row lies in one shard of a bounded size, dealt by a hash. A query first searches one
    shard; its kth score there is the least it looks for in all others.
    """
    vectors = cut(
        frame.select(F.col("vec_id").cast("bigint"), integer_vector(F.col("embedding")).alias("q"))
        .where("vec_id is not null and q is not null")
        .distinct()
    )
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    no = F.xxhash64("q")
    points = vectors.select(
        F.pmod(F.xxhash64("vec_id", "q"), F.lit(shards)).cast("int").alias("shard"),
        F.size("q").alias("dims"), F.lit(0).alias("kind"), "vec_id", no.alias("query_no"), "q",
        F.lit(None).cast("bigint").alias("least"),
    )
    asked = vectors.where(queries)
    first = points.where(queries).withColumn("kind", F.lit(1))
    home = cut(_search(points.union(first), k))
    kth = (
        home.groupBy("query_id", "query_no")
        .agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= k)
        .select(F.col("query_id").alias("vec_id"), "query_no", "least")
    )
    shard = F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    rest = (
        asked.withColumn("query_no", no)
        .join(kth, ["vec_id", "query_no"], "left")
        .select(shard, F.size("q").alias("dims"), F.lit(1).alias("kind"),
                "vec_id", "query_no", "q", "least")
        .where(F.col("shard") != F.pmod(F.xxhash64("vec_id", "q"), F.lit(shards)))
    )
    found = home if shards == 1 else home.union(_search(points.union(rest), k))
    order = Window.partitionBy("query_id", "query_no").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
