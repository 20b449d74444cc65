"""Centroid clustering (k-means on whole numbers) with a vantage-point tree over the centroids.

Each round builds a vantage-point tree of the centroids on the driver and
broadcasts it; both are bounded by the number of centroids and of components.
A vector searches the tree best-first: the open node whose lower bound is least
comes next, and the search ends when that bound is beyond the best distance
found. All vectors of a batch search at once, each on its own way, so that the
distances are numpy products. The pruning radius is inclusive: a node whose bound
equals the best distance is still opened, since a centroid there may tie, and
ties go to the smaller number. Bounds are doubles from the triangle inequality,
widened by more than their rounding; distances at the nodes are exact integers.

The new centroids are exact floors of sums over counts. A task returns one row
of sums for each centroid it has seen; what reaches the driver each round is one
row per centroid. The vectors are written once as whole numbers and read again
each round; the rounds hand on nothing but the centroids.

Defined results: vectors that are null, have another number of components, or a
null or non-finite one, are left out. A null id counts as no digits. Of equal
hashes (repeated ids) the lesser vector comes first. With fewer vectors than
centroids there are as many centroids as vectors; without any, no rows. Repeated
rows each count and come out each for itself. Components so large that a squared
distance could pass 62 bits stop the query with an error. Columns other
than id and vector are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from freshet.llm.common import keep, received, send
from freshet.session import shared_dir

FACTOR = 1024
WIDTH = 64
CENTROIDS = 8
ROUNDS = 10
SEED = "3:"
LEAF = 2
BATCH = 4_096
# Open nodes of a batch: it has fewer vectors where there are many centroids.
BOUNDS = 2**22


class VantageTree:
    """Nodes in arrays: a vantage centroid, the radius that parts the others, and inner and outer child; leaves hold up to LEAF centroids."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.members: list[list[int]] = []  # centroids whose distance is taken at the node
        self.children: list[tuple[int, int] | None] = []
        self.spans: list[tuple[float, float, float, float]] = []  # least and greatest distance from the vantage point, inside and outside
        self._grow(list(range(len(centroids))))

    def _grow(self, numbers: list[int]) -> int:
        node = len(self.members)
        self.children.append(None)
        self.spans.append((0.0, 0.0, 0.0, 0.0))
        if len(numbers) <= LEAF:
            self.members.append(numbers)
            return node
        vantage = numbers[0]
        self.members.append([vantage])
        far = {i: float(np.sqrt(float(squared(self.centroids[i : i + 1], self.centroids[vantage])[0]))) for i in numbers[1:]}
        rest = sorted(numbers[1:], key=lambda i: (far[i], i))
        half = (len(rest) + 1) // 2
        inner, outer = rest[:half], rest[half:]
        # Numbers in order, so that of equal centroids the first is the vantage point.
        left, right = self._grow(sorted(inner)), self._grow(sorted(outer))
        self.children[node] = (left, right)
        self.spans[node] = (far[inner[0]], far[inner[-1]], far[outer[0]], far[outer[-1]])
        return node

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each vector's nearest centroid."""
        n = len(vectors)
        best = np.full(n, np.iinfo(np.int64).max)
        number = np.full(n, len(self.centroids))
        bounds = np.full((n, len(self.members)), np.inf)
        bounds[:, 0] = 0.0
        alive = np.arange(n)
        while len(alive):
            chosen = np.argmin(bounds[alive], axis=1)
            least = bounds[alive, chosen]
            # Inclusive radius: only a bound beyond the best distance ends a search.
            going = least <= np.sqrt(best[alive].astype(np.float64)) * (1 + 1e-12) + 1e-9
            alive, chosen = alive[going], chosen[going]
            for node in np.unique(chosen).tolist():
                here = alive[chosen == node]
                bound = bounds[here, node]
                bounds[here, node] = np.inf
                for centroid in self.members[node]:
                    found = squared(vectors[here], self.centroids[centroid])
                    better = (found < best[here]) | ((found == best[here]) & (centroid < number[here]))
                    best[here[better]], number[here[better]] = found[better], centroid
                if self.children[node]:
                    away = np.sqrt(found.astype(np.float64))
                    spans = self.spans[node]
                    for child, low, high in zip(self.children[node], spans[::2], spans[1::2], strict=True):
                        slack = 1e-9 + 1e-12 * (away + high)
                        bounds[here, child] = np.maximum(bound, np.maximum(low - away, away - high) - slack)
            alive = alive[np.isfinite(bounds[alive]).any(axis=1)]
        return number, best


def squared(vectors: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = vectors - centroid
    return np.einsum("ij,ij->i", apart, apart)


def usable(vector: Column, width: int) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce((F.size(vector) == width) & ~bad, F.lit(False))


def whole_numbers(vectors: DataFrame, width: int, factor: int, id_col: str, vector_col: str) -> DataFrame:
    """id and v (long components) of the vectors that are kept, written to the shared folder; stops on components too large."""
    kept = vectors.where(usable(F.col(vector_col), width))
    limit = float(int((2**62 / (4 * width)) ** 0.5))
    v = F.transform(F.col(vector_col), lambda x: F.floor(_within(x.cast("double") * factor, limit)))
    path = f"{shared_dir(vectors.sparkSession)}/whole-{uuid.uuid4().hex}"
    kept.select(F.col(id_col).alias("id"), v.alias("v")).write.parquet(path)
    return vectors.sparkSession.read.parquet(path)


def _within(x: Column, limit: float) -> Column:
    return F.when(F.abs(x) < limit, x).otherwise(F.raise_error(F.lit("a vector's component is too large for exact distances")).cast("double"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def first_centroids(rows: DataFrame, k: int, seed: str) -> np.ndarray:
    """The k vectors whose ids have the least hashes."""
    chosen = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    found = rows.select(chosen.alias("hash"), "v").orderBy("hash", "v").limit(k).collect()
    return np.array([r["v"] for r in found], dtype=np.int64)


def _searching(rows: DataFrame, centroids: np.ndarray, schema: StructType, out: Callable) -> DataFrame:
    """``out(batch, vectors, numbers, distances)`` over all batches; ``out()`` once at the end of a task, for what is left."""
    sent = send(rows.sparkSession, VantageTree(centroids))
    width = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = received(sent)
        give, end = out()
        size = max(1, min(BATCH, BOUNDS // len(tree.members)))
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                vectors = matrix(part.column("v"), width)
                yield from give(part, vectors, *tree.nearest(vectors))
        yield from end()

    return rows.mapInArrow(run, schema)


def next_centroids(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floors of the means of the vectors nearest to each centroid; those without any stay."""
    k, width = centroids.shape
    schema = StructType([StructField("cluster", IntegerType()), StructField("n", LongType()), StructField("total", ArrayType(LongType()))])

    def sums():
        n, total = np.zeros(k, dtype=np.int64), [[0] * width for _ in range(k)]

        def give(part, vectors, numbers, distances):
            n[:] += np.bincount(numbers, minlength=k)
            for c in np.unique(numbers).tolist():
                total[c] = [a + b for a, b in zip(total[c], vectors[numbers == c].sum(axis=0).tolist(), strict=True)]
            return ()

        def end():
            seen = np.flatnonzero(n)
            columns = [pa.array(seen, pa.int32()), pa.array(n[seen]), pa.array([total[c] for c in seen], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["cluster", "n", "total"])

        return give, end

    found = _searching(rows.select("v"), centroids, schema, sums).groupBy("cluster")
    exact = [F.sum(F.col("total")[i].cast("decimal(38,0)")) for i in range(width)]
    out = centroids.copy()
    for row in found.agg(F.sum("n").alias("n"), F.array(*exact).alias("total")).collect():
        out[row["cluster"]] = [int(t) // row["n"] for t in row["total"]]
    return out


def cluster(
    vectors: DataFrame,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    width: int = WIDTH,
    factor: int = FACTOR,
    seed: str = SEED,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """(id_col, cluster, distance) per kept vector, and the final centroids."""
    rows = whole_numbers(vectors, width, factor, id_col, vector_col)
    schema = StructType([StructField(id_col, vectors.schema[id_col].dataType), StructField("cluster", IntegerType()), StructField("distance", LongType())])
    centroids = first_centroids(rows, k, seed)
    if not len(centroids):
        return vectors.sparkSession.createDataFrame([], schema), centroids
    for _ in range(rounds):
        centroids = next_centroids(rows, centroids)

    def assigned():
        def give(part, vectors, numbers, distances):
            columns = [part.column("id"), pa.array(numbers, pa.int32()), pa.array(distances, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "cluster", "distance"])

        return give, lambda: ()

    return keep(_searching(rows, centroids, schema, assigned)), centroids


def with_totals(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The rows of ``cluster`` with cluster_inertia, inertia and centroid_sha256; one joined row per centroid."""
    sums = found.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia")).collect()
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    total = sum(r["cluster_inertia"] for r in sums)
    rows = [(r["cluster"], r["cluster_inertia"], total, digests[r["cluster"]]) for r in sums]
    known = found.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(known), "cluster")
