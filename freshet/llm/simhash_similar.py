"""Near-duplicates by SimHash, and by similarity of word shingles for what 64 bits miss.

Documents are linked if their fingerprints differ in at most ``simhash.MAX_BITS``
bits: postings by byte positions, count filter, verification, all as ``simhash.links``
does them. A few changed words can turn more bits than that. So documents are also linked
if the sets of their five-word shingles have a Jaccard similarity of ``SIMILARITY`` or
more, found through an exact prefix index. Fingerprints come from the words of the pass that posts prefixes.

All shingles have one order, from rare to
frequent by the number of texts that hold them, then by hash. Of two sets with
similarity s each has one of the other's shingles among its first
``size - ceil(s * size) + 1``, its prefix, whatever the order is; so only
prefixes are posted, and no link is lost.

1. All shingles of all texts are counted by ``KEY_BITS`` of their hashes. A task
   counts its own, and sends sorted keys as compressed columns, one row per
   bucket. The ``MOST_COMMON`` most frequent keys are broadcast; the others
   share the first place. The bound decides on the order, so on cost, not on results.
2. Prefixes are posted the same way: a row holds a task's postings of one bucket.
   A key of a single text never becomes a row. Postings of up to ``SMALL`` texts
   become pairs where the sizes allow a link, once each.
3. Pairs that fingerprints link need no more work. Each set has a sketch, the parities of its hashes in ``64 * SKETCH`` cells:
   two sets differ in at least as many shingles as their sketches in bits. Pairs
   that this rules out go. Those with the first text of a posting are verified by the
   shingles of their whole texts; the others only if that, or the fingerprints, have not joined them yet.
4. Keys that the count shows to be in more than ``SMALL`` texts are posted as rows.
   There each text is first paired with one of them. Postings that hold nearly the
   same texts are made one. Where a posting is still in several parts, it is cut into blocks. A task gets the sketches of
   two blocks and returns the texts that may have a link to another part; a
   task that gets their shingles compares them and returns a forest of the links.

The relation is the same for postings of any size. Work is on distinct word
sequences, so exact copies cost nothing.

Defined results: texts without words are copies of each other. Rows without an
id are not in the result; rows of one id with several texts have a row each.
``component_id`` is the smallest id of the component. An empty table gives no
rows. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    IntegerType,
    IntegralType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from freshet.llm.common import keep, map_rows, partitions_by_text, received, send
from freshet.llm.components import components
from freshet.llm.simhash import MAX_BITS, fingerprint_of_words
from freshet.llm.simhash import links as links_of_fingerprints
from freshet.operators.joins import dimension

SIMILARITY = 0.8
SHINGLE = 5
SMALL = 128
BLOCK = 512
SKETCH = 16
KEY_BITS = 40
MOST_COMMON = 1 << 20
# Characters whose keys make a bucket.
BUCKET = 16_000_000
# Keys a task counts or posts before it sends them on.
FLUSH = 1 << 21
ROWS_PER_CALL = 1000
CACHED_WORDS = 200_000
# Frequencies are told apart by eighths of a power of two.
STEPS = 8


class Shingler:
    """Distinct hashed shingles of word sequences; words keep their hashes while there is room."""

    def __init__(self, size: int):
        self.size = size
        self.known: dict[bytes, int] = {}
        self.factors = np.cumprod(np.full(size, 0x9E3779B97F4A7C15, dtype=np.uint64)).tolist()

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """Sorted; of fewer words than a shingle has, the hash of all of them."""
        if not words:
            return np.zeros(0, dtype=np.uint64)
        if len(words) < self.size:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), len(words))], dtype=np.uint64)
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        for word in set(words).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        own = np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))
        count = len(words) - self.size + 1
        total = np.zeros(count, dtype=np.uint64)
        for at, factor in enumerate(self.factors):
            total += own[at : at + count] * np.uint64(factor)
        total ^= total >> np.uint64(31)
        total *= np.uint64(0xD6E8FEB86659FD93)
        total ^= total >> np.uint64(29)
        return np.unique(total)


def node_of(id_: Column, kind: DataType, digest_: Column) -> Column:
    """Text that stands for a word sequence and sorts by the id: whole numbers by value, other ids as text."""
    if isinstance(kind, IntegralType):
        own = F.lpad(F.hex(id_.cast("long").bitwiseXOR(F.lit(-(2**63)))), 16, "0")
    else:
        own = F.hex(id_.cast("string"))
    return F.concat(own, F.lit(" "), digest_)


def id_of(node: Column, kind: DataType) -> Column:
    own = F.substring_index(node, " ", 1)
    if isinstance(kind, IntegralType):
        return F.conv(own, 16, -10).cast("long").bitwiseXOR(F.lit(-(2**63))).cast(kind)
    return F.decode(F.unhex(own), "utf-8").cast(kind)


def digest_of(node: Column) -> Column:
    return F.substring_index(node, " ", -1)


def lower_words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def digest(words: list[bytes]) -> str:
    return xxhash.xxh3_128_hexdigest(b" ".join(words))


def keys_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - KEY_BITS)


def prefix(hashes: np.ndarray, places: np.ndarray, similarity: float) -> np.ndarray:
    """Positions of the first hashes by (place, hash), one of which every set of that similarity has in its own prefix."""
    size = len(hashes)
    many = size - math.ceil(similarity * size - 1e-9) + 1
    return np.lexsort((hashes, places))[:many] if size else np.zeros(0, dtype=np.int64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Parities of the number of hashes in each cell, as SKETCH words."""
    cells = np.bincount((hashes & np.uint64(64 * SKETCH - 1)).astype(np.int64), minlength=64 * SKETCH) & 1
    return np.packbits(cells.astype(np.uint8)).view(np.int64)


def packed(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Columns of equal length, byte by byte, compressed; the first is sorted."""
    gaps = np.diff(keys.astype(np.uint64), prepend=np.uint64(0))
    bytes_ = [c.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8).T.tobytes() for c in (gaps, *columns)]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(bytes_))


def unpacked(body: bytes, columns: int) -> np.ndarray:
    """(columns, n) whole numbers of ``packed``."""
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), dtype=np.uint8).reshape(columns, 8, -1)
    out = np.ascontiguousarray(raw.transpose(0, 2, 1)).view("<u8")[..., 0].astype(np.uint64)
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out


def dealt(keys: np.ndarray, buckets: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """(bucket, body) of sorted keys, by ranges of keys."""
    ends = [-(-(b << KEY_BITS) // buckets) for b in range(1, buckets)]
    cuts = [0, *np.searchsorted(keys, np.array(ends, dtype=np.uint64)).tolist(), len(keys)]
    for bucket, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if start < end:
            yield bucket, packed(keys[start:end], *(c[start:end] for c in columns))


def frequency_class(n: np.ndarray) -> np.ndarray:
    return np.floor(STEPS * np.log2(n)).astype(np.int64)


class Order:
    """Places of keys: the class of their frequency if they are among the frequent, else zero."""

    def __init__(self, keys: np.ndarray, classes: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.classes = keys[order].astype(np.uint64), classes[order].astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.classes[at], 0)


def frequent(docs: DataFrame, shingle: int, text_col: str, buckets: int) -> Order:
    """The order of keys by the number of texts that hold them; a text that repeats within a task counts once there."""
    schema = pa.schema([("bucket", pa.int32()), ("body", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, found, seen, many = Shingler(shingle), [], set(), 0

        def flush() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            rows = list(zip(*dealt(keys, buckets, counts), strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

        for batch in batches:
            for text in batch.column(0):
                words = lower_words(text.as_py())
                name = xxhash.xxh3_64_intdigest(b" ".join(words))
                if not words or name in seen:
                    continue
                seen.add(name)
                found.append(np.unique(keys_of(shingles(words))))
                many += len(found[-1])
                if many >= FLUSH:
                    yield flush()
                    found, many = [], 0
                    seen.clear()
        if found:
            yield flush()

    def total(group: pa.Table) -> pa.Table:
        keys, counts = np.concatenate([unpacked(b, 2) for b in group["body"].to_pylist()], axis=1)
        keys, inverse = np.unique(keys, return_inverse=True)
        n = np.bincount(inverse, weights=counts)
        often = n > 1
        return pa.table({"key": pa.array(keys[often].astype(np.int64)), "place": pa.array(frequency_class(n[often]))})

    counted = docs.select(F.col(text_col)).mapInArrow(run, "bucket int, body binary").groupBy("bucket")
    counted = keep(counted.applyInArrow(total, "key long, place long"))
    # As many classes as fit, the most frequent first; a class is taken or left as a whole.
    room, least = MOST_COMMON, None
    for row in sorted(counted.groupBy("place").agg(F.count("*").alias("n")).collect(), reverse=True):
        room -= row["n"]
        if room < 0:
            break
        least = row["place"]
    if least is None:
        return Order(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    table = counted.where(F.col("place") >= least).toArrow()
    return Order(table["key"].to_numpy().astype(np.uint64), table["place"].to_numpy())


def posted(docs: DataFrame, order: Order, id_col: str, text_col: str, similarity: float, shingle: int, buckets: int) -> DataFrame:
    """Rows of three kinds: documents (id, digest, size, sketch, fingerprint), bodies of postings by bucket, and postings of keys in many texts."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = [
        ("id", docs.schema[id_col].dataType),
        ("digest", StringType()),
        ("size", LongType()),
        ("sketch", ArrayType(LongType())),
        ("fp", LongType()),
        ("bucket", IntegerType()),
        ("body", BinaryType()),
        ("key", LongType()),
        ("name", LongType()),
    ]
    schema = StructType([StructField(c, kind) for c, kind in kinds])
    arrow = to_arrow_schema(schema)
    sent = send(docs.sparkSession, order)
    long_place = int(frequency_class(np.array([SMALL + 1.0]))[0])

    def rows(**columns) -> pa.RecordBatch:
        n = len(next(iter(columns.values())))
        return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, shingles = received(sent), Shingler(shingle)
        seen, found, many = {}, [], 0

        def flush() -> pa.RecordBatch:
            keys, names, sizes = np.concatenate(found, axis=1)
            by_key = np.argsort(keys, kind="stable")
            bucket, body = zip(*dealt(keys[by_key], buckets, names[by_key], sizes[by_key]), strict=True)
            return rows(bucket=bucket, body=body)

        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_CALL):
                part = batch.slice(at, ROWS_PER_CALL)
                digests, sizes, sketches, prints = [], [], [], []
                long_keys, long_names = [], []
                for text in part.column(1).to_pylist():
                    words = lower_words(text)
                    digests.append(digest(words))
                    if digests[-1] in seen:
                        sizes.append(seen[digests[-1]])
                        sketches.append(None)
                        prints.append(None)
                        continue
                    hashes = shingles(words)
                    seen[digests[-1]] = len(hashes)
                    sizes.append(len(hashes))
                    sketches.append(sketch(hashes))
                    prints.append(np.uint64(fingerprint_of_words(words)).view(np.int64))
                    keys = keys_of(hashes)
                    place = places(keys)
                    first = prefix(hashes, place, similarity)
                    name = np.uint64(int(digests[-1][:16], 16))
                    often = place[first] >= long_place
                    long_keys.append(keys[first[often]])
                    long_names.append(np.full(len(long_keys[-1]), name))
                    rare = keys[first[~often]]
                    found.append(np.stack([rare, np.full(len(rare), name), np.full(len(rare), len(hashes), dtype=np.uint64)]))
                    many += len(rare)
                yield rows(id=part.column(0), digest=digests, size=sizes, sketch=sketches, fp=prints)
                if any(map(len, long_keys)):
                    yield rows(key=np.concatenate(long_keys).astype(np.int64), name=np.concatenate(long_names).view(np.int64))
                if many >= FLUSH:
                    yield flush()
                    found, many = [], 0
                if len(seen) >= FLUSH:
                    seen.clear()
        if many:
            yield flush()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def most_apart(size_a, size_b, similarity: float):
    """Sets of these sizes with that similarity differ in so many shingles at most."""
    return (size_a + size_b) * ((1 - similarity) / (1 + similarity)) + 1e-6


def pairs_of_bucket(keys: np.ndarray, names: np.ndarray, sizes: np.ndarray, similarity: float, small: int):
    """((a, b, star) of postings up to ``small`` whose sizes allow a link, each pair once; (key, name) of longer ones)."""
    order = np.lexsort((names, keys))
    keys, names, sizes = keys[order], names[order], sizes[order].astype(np.int64)
    if len(keys):
        once = np.concatenate(([True], (keys[1:] != keys[:-1]) | (names[1:] != names[:-1])))
        keys, names, sizes = keys[once], names[once], sizes[once]
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    n = counts[inverse] if len(keys) else np.zeros(0, dtype=np.int64)
    long = n > small
    out_long = (keys[long], names[long])
    short = (n > 1) & ~long
    keys, names, sizes = keys[short], names[short], sizes[short]
    first = np.concatenate(([True], keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, dtype=bool)
    found = np.zeros((3, 0), dtype=np.uint64)
    waiting, many = [], 0

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        a, b, star = np.concatenate(parts, axis=1)
        by_pair = np.lexsort((~star.astype(bool), b, a))
        a, b, star = a[by_pair], b[by_pair], star[by_pair]
        keep_ = np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))) if len(a) else np.zeros(0, dtype=bool)
        return np.stack([a[keep_], b[keep_], star[keep_]])

    for apart in range(1, small):
        same = np.flatnonzero(keys[apart:] == keys[:-apart]) if apart < len(keys) else ()
        if not len(same):
            break
        m, k = sizes[same], sizes[same + apart]
        same = same[np.abs(m - k) <= most_apart(m, k, similarity)]
        waiting.append(np.stack([names[same], names[same + apart], first[same].astype(np.uint64)]))
        many += len(same)
        if many > FLUSH:
            found, waiting, many = merged([found, *waiting]), [], 0
    return merged([found, *waiting]), out_long


def met_in_postings(rows: DataFrame, similarity: float) -> DataFrame:
    """(a, b, star) pairs of names from short postings; (key, a) of long ones."""
    small = SMALL
    schema = StructType([StructField(c, LongType()) for c in ("key", "a", "b")] + [StructField("star", BooleanType())])

    def run(group: pa.Table) -> pa.Table:
        keys, names, sizes = np.concatenate([unpacked(b, 3) for b in group["body"].to_pylist()], axis=1)
        (a, b, star), (long_keys, long_names) = pairs_of_bucket(keys, names, sizes, similarity, small)
        n, m = len(a), len(long_keys)
        return pa.table(
            {
                "key": pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(long_keys.astype(np.int64))]),
                "a": pa.array(np.concatenate([a, long_names]).view(np.int64)),
                "b": pa.concat_arrays([pa.array(b.view(np.int64)), pa.nulls(m, pa.int64())]),
                "star": pa.concat_arrays([pa.array(star.astype(bool)), pa.nulls(m, pa.bool_())]),
            }
        )

    return rows.where("body IS NOT NULL").select("bucket", "body").groupBy("bucket").applyInArrow(run, schema)


def dense_forest(sets: list[np.ndarray], roots: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """Positions of links that, with those of equal ``roots``, join what all pairs of that similarity join."""
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets) if sets else np.zeros(0, dtype=np.int64)
    _, column, counts = np.unique(flat, return_inverse=True, return_counts=True)
    # Shingles of one document only are in no intersection.
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = counts[column] > 1
    owner, column = owner[shared], column[shared]
    mine = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(sets)))))
    by_column = owner[np.argsort(column, kind="stable")]
    starts = np.concatenate(([0], np.cumsum(np.bincount(column, minlength=len(counts)))))
    _, root = np.unique(roots, return_inverse=True)
    largest = int(np.argmax(np.bincount(root))) if len(root) else 0
    forest = []
    # Of two documents that aren't joined, one is outside the largest part; its turn sees the other.
    for i in range(len(sets)):
        if root[i] == largest or mine[i] == mine[i + 1]:
            continue
        met = [by_column[starts[c] : starts[c + 1]] for c in column[mine[i] : mine[i + 1]]]
        n = np.bincount(np.concatenate(met), minlength=len(sets))
        near = np.flatnonzero((n > 0) & (n >= similarity * (sizes + sizes[i] - n)) & (root != root[i]))
        others, first = np.unique(root[near], return_index=True)
        for other, j in zip(others.tolist(), near[first].tolist(), strict=True):
            forest.append((i, j))
            old, new = (root[i], other) if other == largest else (other, root[i])
            root[root == old] = new
    return forest


def possible(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b, star) nodes of the pairs of names whose sketches and sizes leave that similarity possible, without those that fingerprints link."""
    for c in "ab":
        pairs = pairs.join(nodes.select(F.col("name").alias(c), F.col("node").alias(f"node_{c}"), F.col("size").alias(f"n{c}"), F.col("sketch").alias(f"s{c}"), F.col("fp").alias(f"f{c}")), c)
    differing = F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    bits = F.aggregate(differing, F.lit(0), lambda n, x: n + x)
    most = most_apart(F.col("na"), F.col("nb"), similarity)
    near = pairs.where((F.col("node_a") != F.col("node_b")) & (bits <= most) & (F.abs(F.col("na") - F.col("nb")) <= most))
    near = near.where(F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) > MAX_BITS)
    return near.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), "star")


def stars(long: DataFrame) -> DataFrame:
    """(a, b, star) pairs of each member of a long posting with one of them, the same one where members are the same."""
    centres = long.groupBy("key").agg(F.min("name").alias("centre"))
    met = long.join(centres, "key").where("name <> centre")
    return met.select(F.col("centre").alias("a"), F.col("name").alias("b"), F.lit(True).alias("star")).distinct()


def shingle_sets(wanted: DataFrame, docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """(digest, s) of the nodes in ``wanted``, written once; s has the hashes of the shingles."""
    schema = StructType([StructField("digest", StringType()), StructField("s", ArrayType(LongType()))])

    def start():
        shingles = Shingler(shingle)

        def work(texts):
            found = [lower_words(t) for t in texts]
            return {"digest": [digest(w) for w in found], "s": [shingles(w).view(np.int64) for w in found]}

        return work

    # Texts move only where the ids wanted are too many to be sent to all tasks.
    ids = dimension(wanted.select(id_of(F.col("node"), docs.schema[id_col].dataType).alias(id_col)).distinct(), max_rows=1_000_000)
    texts = docs.select(F.col(id_col), F.col(text_col)).join(ids, id_col, "left_semi").select(F.col(text_col))
    named = map_rows(texts, schema, start).join(wanted.select(digest_of(F.col("node")).alias("digest")).distinct(), "digest", "left_semi")
    return keep(named.dropDuplicates(["digest"]))


def may_link(sketches: np.ndarray, sizes: np.ndarray, roots: np.ndarray, similarity: float) -> np.ndarray:
    """Whether each document may have a link to one of another root."""
    _, root = np.unique(roots, return_inverse=True)
    largest = int(np.argmax(np.bincount(root)))
    out = np.zeros(len(sizes), dtype=bool)
    for i in np.flatnonzero(root != largest):
        bits = np.bitwise_count(sketches ^ sketches[i]).sum(axis=1)
        most = (sizes + sizes[i]) * ((1 - similarity) / (1 + similarity)) + 1e-6
        near = (bits <= most) & (np.abs(sizes - sizes[i]) <= most) & (root != root[i])
        out |= near
        out[i] |= near.any()
    return out


def fewer_blocks(long: DataFrame) -> DataFrame:
    """(key, name) rows in which the same texts meet, in fewer blocks where postings overlap.

    A group of near copies has many long postings of nearly the same texts, which have
    the same first text. Postings with one first text become one if that
    makes fewer rows of blocks.
    """

    def rows(n: Column) -> Column:
        return n * F.ceil(n / BLOCK)

    postings = long.groupBy("key").agg(F.min("name").alias("centre"), F.count("*").alias("n"))
    placed = keep(long.join(postings, "key"))
    texts = placed.groupBy("centre", "name").agg(F.sum(F.ceil(F.col("n") / BLOCK)).alias("apart"))
    together = texts.groupBy("centre").agg(F.count("*").alias("n"), F.sum("apart").alias("apart"))
    joined = together.select("centre", (rows(F.col("n")) <= F.col("apart")).alias("is_one"))
    marked = placed.join(joined, "centre")
    # Keys have KEY_BITS bits; that of a centre has a bit beyond them.
    key = F.when(F.col("is_one"), F.col("centre").bitwiseOR(F.lit(1 << 62))).otherwise(F.col("key"))
    return marked.select(key.alias("key"), "name").distinct()


def dense_links(
    long: DataFrame, linked: DataFrame, nodes: DataFrame, docs: DataFrame, similarity: float, shingle: int, id_col: str, text_col: str
) -> DataFrame:
    """(a, b) links of long postings by the same relation; ``linked`` has (node, root) of what is joined already."""
    named = long.join(nodes.select("name", "node", "size", "sketch"), "name").join(linked, "node", "left")
    named = keep(named.select("key", "node", "size", "sketch", F.coalesce("root", "node").alias("root")))
    mixed = named.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    blocks = F.ceil(F.col("n") / BLOCK)
    others = F.sequence(F.lit(0).cast("long"), blocks - 1)
    mine = named.join(mixed.where("low <> high").select("key", "n"), "key").withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    grid = mine.select("*", F.explode(others).alias("other")).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    place = ["key", "node", "root", "i", "j"]

    def numbered(roots: pa.ChunkedArray) -> np.ndarray:
        return roots.combine_chunks().dictionary_encode().indices.to_numpy()

    def narrow(group: pa.Table) -> pa.Table:
        sketches = group["sketch"].combine_chunks().flatten().to_numpy().view(np.uint64).reshape(-1, SKETCH)
        keeps = may_link(sketches, group["size"].to_numpy(), numbered(group["root"]), similarity)
        return group.select(place).filter(pa.array(keeps))

    def forest(group: pa.Table) -> pa.Table:
        ids, s = group["node"].combine_chunks(), group["s"].combine_chunks()
        ends = np.cumsum(s.value_lengths().to_numpy())
        found = dense_forest(np.split(s.flatten().to_numpy(), ends[:-1]), numbered(group["root"]), similarity)
        return pa.table({c: ids.take(pa.array([f[k] for f in found], pa.int64())) for k, c in enumerate(("a", "b"))})

    sketched = grid.select(*place, "size", "sketch")
    open_ = keep(sketched.groupBy("key", "i", "j").applyInArrow(narrow, sketched.select(*place).schema))
    sets = shingle_sets(open_.select("node"), docs, shingle, id_col, text_col)
    schema = StructType([StructField(c, StringType()) for c in "ab"])
    with_sets = open_.withColumn("digest", digest_of(F.col("node"))).join(sets, "digest").drop("digest")
    return with_sets.groupBy("key", "i", "j").applyInArrow(forest, schema)


def verified(pairs: DataFrame, docs: DataFrame, similarity: float, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """The pairs of nodes whose whole texts have that Jaccard similarity of word shingles."""
    sets = shingle_sets(pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))), docs, shingle, id_col, text_col)
    both = pairs.select("a", "b", digest_of(F.col("a")).alias("da"), digest_of(F.col("b")).alias("db"))
    both = both.join(sets.select(F.col("digest").alias("da"), F.col("s").alias("sa")), "da")
    both = both.join(sets.select(F.col("digest").alias("db"), F.col("s").alias("sb")), "db")
    both = both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), F.size(F.array_intersect("sa", "sb")).alias("n"))
    return both.where(F.col("n") >= similarity * (F.col("na") + F.col("nb") - F.col("n"))).select("a", "b")


def rooted(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs that ``found`` (node, root) doesn't join."""
    for c in "ab":
        pairs = pairs.join(found.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}")), c, "left")
    return pairs.where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).drop("root_a", "root_b")


def fingerprint_links(nodes: DataFrame) -> DataFrame:
    """(a, b) links of nodes whose fingerprints differ in at most MAX_BITS; those of equal ones lead to the first node."""
    firsts = keep(nodes.groupBy("fp").agg(F.min("node").alias("first"), F.count("*").alias("n")))
    found = keep(links_of_fingerprints(firsts.select("fp")))
    # Few fingerprints have links; where they are too many to be sent to all tasks, both sides move.
    for c in "ab":
        found = firsts.select(F.col("fp").alias(c), F.col("first").alias(f"first_{c}")).join(dimension(found), c).drop(c)
    equal = nodes.join(dimension(firsts.where("n > 1").select("fp", "first")), "fp").where("node <> first")
    return found.select(F.col("first_a").alias("a"), F.col("first_b").alias("b")).unionByName(equal.select(F.col("first").alias("a"), F.col("node").alias("b")))


def similar_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY, shingle: int = SHINGLE
) -> DataFrame:
    """(id_col, component_id) of every row with an id."""
    docs = docs.where(F.col(id_col).isNotNull())
    buckets = partitions_by_text(docs, text_col, BUCKET)
    order = frequent(docs, shingle, text_col, buckets)
    rows = keep(posted(docs, order, id_col, text_col, similarity, shingle, buckets))
    marked = rows.where("digest IS NOT NULL")
    # A node is a word sequence; its name is what postings call it, and its least id comes first where nodes are ordered.
    nodes = marked.groupBy("digest").agg(F.min("id").alias("id"), *(F.first(c, ignorenulls=True).alias(c) for c in ("size", "sketch", "fp")))
    name = F.conv(F.substring("digest", 1, 16), 16, -10).cast("long")
    kind = docs.schema[id_col].dataType
    nodes = keep(nodes.select(node_of(F.col("id"), kind, F.col("digest")).alias("node"), name.alias("name"), "size", "sketch", "fp"))
    met = keep(met_in_postings(rows, similarity))
    long = rows.where("key IS NOT NULL").select("key", "name").unionByName(met.where("key IS NOT NULL").select("key", F.col("a").alias("name")))
    long = keep(long.distinct())
    pairs = met.where("b IS NOT NULL").groupBy("a", "b").agg(F.max("star").alias("star"))
    pairs = keep(possible(pairs.unionByName(stars(long)), nodes, similarity))
    check = (docs, similarity, shingle, id_col, text_col)
    by_shingles = verified(pairs.where("star").select("a", "b").distinct(), *check)
    linked = components(fingerprint_links(nodes.select("node", "fp")).unionByName(by_shingles))
    rest = keep(rooted(pairs.where("NOT star").select("a", "b"), linked))
    # What is joined goes on as its roots.
    links = [linked.select(F.col("node").alias("a"), F.col("root").alias("b")), keep(verified(rest, *check))]
    if not long.isEmpty():
        links.append(dense_links(fewer_blocks(long), linked, nodes, *check))
    found = components(reduce(DataFrame.unionByName, links))
    roots = nodes.select("node").join(found, "node", "left").select(digest_of(F.col("node")).alias("digest"), F.coalesce("root", "node").alias("root"))
    labels = roots.select("digest", id_of(F.col("root"), kind).alias("component_id"))
    return marked.select(F.col("id").alias(id_col), "digest").join(labels, "digest").select(id_col, "component_id")
