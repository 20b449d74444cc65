"""Fill-in-the-middle transformation by secondary sort.

A document is cut at two places into prefix, middle and suffix, which are put
out in another order behind marks. The text is cut into chunks of at most
``CHUNK`` units (code points); a piece is a chunk or a mark, keyed by document
and place in the output. ``repartitionAndSortWithinPartitions`` deals the pieces
out by document and sorts by place, so each task streams outputs piece by
piece into an incremental digest and holds one piece at a time, however long
a document is; its sort goes to disk beyond the worker's memory.

The same stream is read back as a reader of the output would: a mark tells which
part follows. That gives each chunk its place in the text, and a second
``repartitionAndSortWithinPartitions`` by that place streams the restored text into
its own digest. Partitions stay as they are, so it sorts again without a shuffle.
Chunks travel compressed.

Places and form come from digests of the id alone, so a task that runs again
makes the same pieces. Documents are told apart by their place in ``docs``; a
frame whose rows come in another order each time should be written first.

Defined results: a null text is an empty one, which is plain. A null id counts
as no digits. Repeated rows come out each for itself. An empty table gives no
rows. Columns of ``docs`` other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from freshet.llm.common import partitions_by_text

CHUNK = 65_536
# Code points of a partition.
PARTITION = 64_000_000
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Shares in per cent: documents that are transformed, and of those the ones with the suffix first.
TRANSFORMED = 90
SUFFIX_FIRST = 20
# Which part follows a mark; parts are numbered as they stand in the text.
PART = {PREFIX: 0, MIDDLE: 1, SUFFIX: 2}


class Cut(NamedTuple):
    """Form of a document, and the ends of its prefix and middle in code points."""

    form: str
    first: int
    second: int


def choose(doc_id: int | None, text: str) -> Cut:
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[at : at + 8], 16) for at in range(0, 32, 8)]
    n = len(text)
    if not text or any(mark in text for mark in PART) or h[2] % 100 >= TRANSFORMED:
        return Cut(PLAIN, 0, n)
    first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    return Cut(SPM if h[3] % 100 < SUFFIX_FIRST else PSM, first, second)


def output_pieces(text: str, cut: Cut, chunk: int = CHUNK) -> Iterator[str]:
    """Marks and chunks in the order of the output."""

    def chunks(start: int, end: int) -> Iterator[str]:
        for at in range(start, end, chunk):
            yield text[at : min(at + chunk, end)]

    if cut.form == PLAIN:
        yield from chunks(0, len(text))
        return
    spans = {PREFIX: (0, cut.first), MIDDLE: (cut.first, cut.second), SUFFIX: (cut.second, len(text))}
    for mark in (PREFIX, SUFFIX, MIDDLE) if cut.form == PSM else (SUFFIX, PREFIX, MIDDLE):
        yield mark
        yield from chunks(*spans[mark])


def restore(output: str, form: str) -> str:
    """The text of a whole output."""
    if form == PLAIN:
        return output
    starts = sorted((output.index(mark), mark) for mark in PART)
    ends = [at for at, _ in starts[1:]] + [len(output)]
    parts = {PART[mark]: output[at + len(mark) : end] for (at, mark), end in zip(starts, ends, strict=True)}
    return parts[0] + parts[1] + parts[2]


def _cut_up(docs: DataFrame, chunk: int) -> DataFrame:
    """row, doc_id, n, form, prefix_chars, middle_chars, place, body: a row for each piece, and a last one of each document without body."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kinds = [
        ("row", LongType()),
        ("doc_id", docs.schema["doc_id"].dataType),
        ("n", LongType()),
        ("form", StringType()),
        ("prefix_chars", LongType()),
        ("middle_chars", LongType()),
        ("place", IntegerType()),
        ("body", BinaryType()),
    ]
    schema = StructType([StructField(name, kind) for name, kind in kinds])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                text = text or ""
                cut = choose(doc_id, text)
                sizes = (None, None) if cut.form == PLAIN else (cut.first, cut.second - cut.first)
                bodies = [pack(piece.encode("utf-8", "surrogatepass")) for piece in output_pieces(text, cut, chunk)]
                # What is known of the document comes once, at its end.
                rows = [(row, None, None, cut.form, None, None, place, body) for place, body in enumerate(bodies)]
                rows.append((row, doc_id, len(text), cut.form, *sizes, len(bodies), None))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return docs.mapInArrow(run, schema)


def _read_output(with_text: bool) -> Callable[[Iterator], Iterator]:
    """Streams pieces sorted by (row, place) into digests of the outputs; gives them back keyed by (row, part, place)."""

    def run(found: Iterator) -> Iterator:
        unpack = zstandard.ZstdDecompressor().decompress
        for row, pieces in groupby(found, key=lambda piece: piece[0][0]):
            digest, part, shown = hashlib.sha256(), 0, []
            for (_, place), (form, body, told) in pieces:
                if body is None:
                    known = (*told, digest.hexdigest(), "".join(shown) if with_text else None)
                    yield (row, len(PART), 0), (None, known)
                    break
                piece = unpack(body)
                digest.update(piece)
                if with_text:
                    shown.append(piece.decode("utf-8", "surrogatepass"))
                # A text with a mark in it is plain, so elsewhere a mark is a mark.
                if form != PLAIN and len(piece) == len(PREFIX) and piece.decode("utf-8", "replace") in PART:
                    part = PART[piece.decode()]
                else:
                    yield (row, part, place), (body, None)

    return run


def _read_restored(found: Iterator) -> Iterator:
    """Streams pieces sorted by (row, part, place) into digests of the restored texts; one row per document."""
    unpack = zstandard.ZstdDecompressor().decompress
    for _, pieces in groupby(found, key=lambda piece: piece[0][0]):
        digest = hashlib.sha256()
        for _, (body, known) in pieces:
            if known is None:
                digest.update(unpack(body))
            else:
                yield (*known, digest.hexdigest())


def _by_row(key: tuple) -> int:
    return hash(key[0])


def fill_middle(docs: DataFrame, chunk: int = CHUNK, with_text: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256; ``output`` too with ``with_text``.

    Only ``with_text`` puts a whole output together, in a worker that holds that one document.
    """
    spark = docs.sparkSession
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    cut_up = _cut_up(rows, chunk)

    def keyed(piece) -> tuple:
        row, doc_id, n, form, prefix_chars, middle_chars, place, body = piece
        return (row, place), (form, None if body is None else bytes(body), (doc_id, n, form, prefix_chars, middle_chars) if body is None else None)

    # Adaptive execution doesn't see this shuffle, so its partitions are sized here, from all texts.
    sort = {"numPartitions": partitions_by_text(docs, text_col, PARTITION), "partitionFunc": _by_row}
    dealt = cut_up.rdd.map(keyed).repartitionAndSortWithinPartitions(**sort)
    outputs = dealt.mapPartitions(_read_output(with_text), preservesPartitioning=True)
    restored = outputs.repartitionAndSortWithinPartitions(**sort).mapPartitions(_read_restored)
    known = [StructField("doc_id", docs.schema[id_col].dataType), StructField("n", LongType()), StructField("form", StringType())]
    known += [StructField(c, LongType()) for c in ("prefix_chars", "middle_chars")]
    known += [StructField(c, StringType()) for c in ("output_sha256", "output", "restored_sha256")]
    found = spark.createDataFrame(restored, StructType(known), verifySchema=False)
    found = found.withColumnRenamed("doc_id", id_col)
    return found if with_text else found.drop("output")
