"""SimHash near-duplicates through an inverted index of byte positions.

A fingerprint has eight bytes, and two fingerprints that differ in at most
``MAX_BITS`` = 4 bits share at least four of them in place. That is the
guaranteed minimum of the count filter: pairs that share fewer positional
bytes can't be links.

Tallying single bytes would bring together one fingerprint in 256, so the
postings are kept for *triples* of positions: the smallest family of triples
of which one lies in every set of four positions (``covering_triples``, 20 of
56). A pair with four shared bytes meets in some posting; a chance meeting
needs 24 equal bits. Of the pairs that meet, the shared positional bytes are
tallied, those below the minimum go, and the rest are verified bit by bit.

Work is on distinct fingerprints, so exact copies cost nothing. A posting of
up to ``SMALL`` fingerprints is paired by a join. Longer ones, made by large
groups of near copies, are never expanded: they are cut into blocks of
``BLOCK``, each pair of blocks is one group of at most ``2 * BLOCK``
fingerprints, and a task tallies and verifies there in numpy and returns a
spanning forest of the links, which has fewer rows than the group. No link
between components is lost, and no task holds an unbounded posting.

Defined results: null and wordless texts have fingerprint zero and are linked
like others. ``component_id`` is the smallest non-null id of the component,
null if there is none. Repeated rows stay repeated.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from freshet.llm.common import keep, map_rows
from freshet.llm.components import components

MAX_BITS = 4
LEAST_BYTES = 8 - MAX_BITS
SMALL = 24
BLOCK = 2048


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Unsigned 64-bit SimHash of the word shingles; zero without words."""
    return fingerprint_of_words(text.encode("utf-8", "surrogatepass").lower().split() if text else [], shingle)


def fingerprint_of_words(low: list[bytes], shingle: int = 4) -> int:
    if not low:
        return 0
    if len(low) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(low), seed=42)
    joined = b" ".join(low)
    sizes = np.fromiter(map(len, low), dtype=np.int64, count=len(low)) + 1
    starts = np.concatenate(([0], np.cumsum(sizes[:-1])))
    ends = (starts + sizes - 1)[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], 42) for a, b in zip(starts.tolist(), ends, strict=False)], dtype=">u8")
    half = len(hashes)
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, half, 65536):
        counts += np.unpackbits(hashes[at : at + 65536].view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > half).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(id_col, fp) per row; fp holds the 64 bits as a signed long."""
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("fp", LongType())])

    def start():
        def work(ids, texts):
            values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64)
            return {id_col: ids, "fp": pa.array(values.view(np.int64))}

        return work

    return map_rows(docs.select(F.col(id_col), F.col(text_col)), schema, start)


def covering_triples(positions: int = 8, shared: int = LEAST_BYTES) -> list[tuple[int, int, int]]:
    """A smallest family of triples with one in every ``shared`` = 4 positions.

    The positions are split into three circles; taken are the triples within
    a circle, and those with two in one circle and one in the next.
    """
    part = [p * 3 // positions for p in range(positions)]
    chosen = []
    for triple in combinations(range(positions), 3):
        sizes = [sum(part[p] == g for p in triple) for g in range(3)]
        if 3 in sizes or any(sizes[g] == 2 and sizes[(g + 1) % 3] == 1 for g in range(3)):
            chosen.append(triple)
    assert all(any(set(t) <= set(four) for t in chosen) for four in combinations(range(positions), shared))
    return chosen


def posting_keys(fp: Column) -> Column:
    """One long per triple: its number, and the three bytes."""
    keys = []
    for number, triple in enumerate(covering_triples()):
        key = F.lit(number).cast("long")
        for p in triple:
            key = F.shiftleft(key, 8).bitwiseOR(F.shiftrightunsigned(fp, 56 - 8 * p).bitwiseAND(F.lit(255)))
        keys.append(key)
    return F.array(*keys)


def byte_tally(x: Column) -> Column:
    """Number of zero bytes of an exclusive or."""
    return sum(
        (F.when(F.shiftrightunsigned(x, 8 * p).bitwiseAND(F.lit(255)) == 0, 1).otherwise(0) for p in range(8)), F.lit(0)
    )


def shared_bytes(x: np.ndarray) -> np.ndarray:
    """Number of zero bytes of each exclusive or."""
    for shift in (4, 2, 1):
        x = x | (x >> np.uint64(shift))
    return 8 - np.bitwise_count(x & np.uint64(0x0101010101010101)).astype(np.int64)


def block_forest(one: np.ndarray, two: np.ndarray | None, max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Spanning forest of the links within ``one``, or between ``one`` and ``two``; distinct uint64 values."""
    values = one if two is None else np.concatenate([one, two])
    offset = 0 if two is None else len(one)
    right = values[offset:]
    root = np.arange(len(values))
    forest = []
    for i in range(len(one)):
        differing = right ^ values[i]
        near = np.flatnonzero(shared_bytes(differing) >= 8 - max_bits)
        near = near[np.bitwise_count(differing[near]) <= max_bits] + offset
        others, first = np.unique(root[near], return_index=True)
        for other, j in zip(others.tolist(), near[first].tolist(), strict=True):
            if other != root[i]:
                forest.append((i, j))
                root[root == other] = root[i]
    signed = values.view(np.int64)
    return [(int(signed[i]), int(signed[j])) for i, j in forest]


def links(nodes: DataFrame) -> DataFrame:
    """(a, b) edges whose components are those of all pairs within MAX_BITS; ``nodes`` has distinct fp."""
    posted = nodes.select("fp", F.explode(posting_keys(F.col("fp"))).alias("key"))
    sizes = posted.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = keep(posted.join(sizes, "key"))

    small = met.where(F.col("n") <= SMALL).select("key", "fp")
    x = F.col("a").bitwiseXOR(F.col("b"))
    paired = (
        small.withColumnRenamed("fp", "a")
        .join(small.withColumnRenamed("fp", "b"), "key")
        .where((F.col("a") < F.col("b")) & (byte_tally(x) >= LEAST_BYTES) & (F.bit_count(x) <= MAX_BITS))
        .select("a", "b")
    )

    blocks = F.ceil(F.col("n") / BLOCK)
    block = F.pmod(F.xxhash64("fp"), blocks)
    others = F.sequence(F.lit(0).cast("long"), blocks - 1)
    large = met.where(F.col("n") > SMALL).select("key", "fp", block.alias("block"), F.explode(others).alias("other"))
    grid = large.select("key", "fp", "block", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def forest(group: pa.Table) -> pa.Table:
        fp = group["fp"].to_numpy().view(np.uint64)
        low, high = group["i"][0].as_py(), group["j"][0].as_py()
        if low == high:
            found = block_forest(fp, None)
        else:
            mine = group["block"].to_numpy() == low
            found = block_forest(fp[mine], fp[~mine])
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    dense = grid.groupBy("key", "i", "j").applyInArrow(forest, schema)
    return paired.unionByName(dense)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """Per row: id_col, fingerprint (16 hex digits), component_id, and its number of direct copies."""
    marked = keep(fingerprints(docs, id_col, text_col, shingle))
    nodes = keep(marked.groupBy("fp").agg(F.min(id_col).alias("least"), F.count("*").alias("n_same")))
    found = components(links(nodes.select("fp")))
    rooted = nodes.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labelled = rooted.join(named, "root").select("fp", "component_id", "n_same")
    return marked.join(labelled, "fp").select(
        id_col, F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_same"
    )


def one_of_each(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component of ``found``: the one whose id is the component's.

    Of several rows with that id one stays. Rows without an id take no part
    in the choice: of those with equal text one stays. All columns stay.
    """
    chosen = keep(found.where(F.col(id_col) == F.col("component_id")).groupBy(id_col).agg(F.count("*").alias("n_rows")))
    staying = docs.join(chosen.where("n_rows = 1").select(id_col), id_col, "left_semi")
    if not chosen.where("n_rows > 1").isEmpty():
        repeated = docs.join(chosen.where("n_rows > 1").select(id_col), id_col, "left_semi")
        staying = staying.unionByName(repeated.dropDuplicates([id_col]).select(staying.columns))
    if not docs.where(F.col(id_col).isNull()).isEmpty():
        staying = staying.unionByName(docs.where(F.col(id_col).isNull()).dropDuplicates([text_col]))
    return staying.select(docs.columns)

