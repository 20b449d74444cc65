"""Exact top-k by inner product with MaxScore.

The terms of a query are its components, and a vector's posting in a term is
its own component there. Within a chunk of candidates a term contributes
between a least and a greatest amount; the difference is its score bound.
Terms are put in order of their bounds. Those of least bound, which together
can't lift a candidate from the least total over the query's k-th best score
so far, are non-essential. The postings of the essential terms are traversed
for the whole chunk; the other terms are probed, those with large bounds
first, and only for candidates that can still reach the k-th best score.

Queries and candidates are dealt out in a grid of blocks of bounded size.
Each cell gives k rows per query, which a window merges by query. Rows are
dealt by position, so that neither a common vector nor a common id is hot.

All arithmetic is on whole numbers. Those that doubles hold exactly are
computed in doubles; larger ones in integers of any size.

Defined results: rows whose id or vector is null, or whose vector has a null
or non-finite component, take no part. Missing components of a shorter vector
count as zero. A candidate row with the query's id is the query's own. If
several rows have a query's id, the least vector is the query; candidates that
repeat are found repeatedly. A score beyond 64 bits is an error.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

SHARD_ROWS = 16_384
BLOCK_QUERIES = 1_024
CHUNK = 2_048
PROBED_AT_ONCE = 8


def whole_components(vector: Column, factor: float = 256.0) -> Column:
    """floor(factor * x) of each component, as doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("double"))


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


class Best:
    """k best (score, id) of each query, ties to the smaller id."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.found: list[list[tuple]] = [[] for _ in range(queries)]

    def bar(self, i: int):
        return -self.found[i][-1][0] if len(self.found[i]) == self.k else None

    def add(self, i: int, scores: list, ids: list) -> None:
        new = sorted([*self.found[i], *zip([-s for s in scores], ids, strict=True)])
        self.found[i] = new[: self.k]


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, chunk: int = CHUNK) -> Best:
    """MaxScore of a block of queries over a shard; rows of whole numbers, all of equal width."""
    best = Best(len(queries), k)
    for at in range(0, len(vectors), chunk):
        part, part_ids = np.ascontiguousarray(vectors[at : at + chunk].T), ids[at : at + chunk]
        low, high = part.min(axis=1), part.max(axis=1)
        for i, q in enumerate(queries):
            bar = best.bar(i)
            ends = np.stack([q * low, q * high])
            least, most = ends.min(axis=0), ends.max(axis=0)
            bounds = most - least
            order = np.argsort(bounds, kind="stable")
            first = 0
            if bar is not None:
                # Terms order[:first] are non-essential: with the least total they stay below the bar.
                first = int(np.searchsorted(np.cumsum(bounds[order]), bar - least.sum(), side="left"))
                if first == len(order):
                    continue
            essential, rest = order[first:], order[:first][::-1]
            scores = q[essential] @ part[essential]
            alive = np.flatnonzero(part_ids != query_ids[i])
            scores = scores[alive]
            for j in range(0, len(rest) + 1, PROBED_AT_ONCE):
                if bar is not None:
                    competitive = scores + most[rest[j:]].sum() >= bar
                    alive, scores = alive[competitive], scores[competitive]
                probe = rest[j : j + PROBED_AT_ONCE]
                if len(probe) and len(alive):
                    scores = scores + q[probe] @ part[np.ix_(probe, alive)]
            if len(alive) > k:
                cut = np.partition(scores, len(scores) - k)[len(scores) - k]
                alive, scores = alive[scores >= cut], scores[scores >= cut]
            if len(alive):
                best.add(i, scores.tolist(), part_ids[alive].tolist())
    return best


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    rows = column.combine_chunks()
    sizes = rows.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(rows), width))
    out[np.repeat(np.arange(len(rows)), sizes), np.concatenate([np.arange(n) for n in sizes] or [np.zeros(0, int)]).astype(int)] = (
        rows.flatten().to_numpy(zero_copy_only=False)
    )
    return out


def _exact(*matrices: np.ndarray) -> tuple[np.ndarray, ...]:
    """As they are if doubles hold every partial sum exactly, else as integers of any size."""
    largest = [float(np.abs(m).max(initial=0)) for m in matrices]
    if math.prod(largest) * 4 * max(1, matrices[0].shape[1]) < 2**53 and max(largest) < 2**53:
        return matrices
    return tuple(np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in matrices)


def top_k(vectors: DataFrame, query: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for every row for which ``query`` holds."""
    taking_part = vectors.where(F.col(id_col).isNotNull() & usable(F.col(vector_col)))
    rows = taking_part.select(F.col(id_col).cast("long").alias("id"), whole_components(F.col(vector_col)).alias("v"))
    queries = taking_part.where(query).groupBy(F.col(id_col).cast("long").alias("id"))
    queries = queries.agg(F.min(whole_components(F.col(vector_col))).alias("v"))
    counts = taking_part.agg(F.count("*").alias("n"), F.count_if(query).alias("q")).first()
    shards, blocks = max(1, math.ceil(counts["n"] / SHARD_ROWS)), max(1, math.ceil(counts["q"] / BLOCK_QUERIES))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    dealt = rows.select("id", "v", F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int").alias("shard"))
    dealt = dealt.select("id", "v", "shard", each(blocks).alias("block"))
    asked = queries.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.select("id", "v", "block", each(shards).alias("shard"))
    schema = StructType([StructField(c, LongType()) for c in ("query_id", "vec_id", "score")])

    def cell(asked: pa.Table, dealt: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if len(asked) and len(dealt):
            width = max(t["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False).max() for t in (asked, dealt))
            qs, vs = _exact(_matrix(asked["v"], width), _matrix(dealt["v"], width))
            query_ids = asked["id"].to_numpy()
            best = search(query_ids, qs, dealt["id"].to_numpy(), vs, k)
            out = [(int(q), i, -int(s)) for q, found in zip(query_ids, best.found, strict=True) for s, i in found]
        columns = list(zip(*out, strict=True)) if out else [[], [], []]
        return pa.table({c: pa.array(list(x), pa.int64()) for c, x in zip(schema.names, columns, strict=True)})

    found = asked.groupBy("block", "shard").cogroup(dealt.groupBy("block", "shard")).applyInArrow(cell, schema)
    place = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
