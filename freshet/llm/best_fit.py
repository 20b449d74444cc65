"""Packing of tokenized documents into sequences, planned on the histogram of lengths.

1. Each text becomes token ids and an end id. Only what is longer than
   ``capacity`` is cut: all pieces but the first have ``capacity`` ids. A task
   numbers its pieces of each length.
2. Pieces are counted by (length, task); running sums of the counts turn the
   task's numbers into ranks within a length over all documents.
3. The plan is made on the histogram alone, at most ``capacity`` numbers, by
   best-fit from the longest length down: a piece goes where the least room is
   left. Sequences of equal room are one run of numbers, so a plan row places
   any number of pieces. A length splits one run at most and opens two, so
   the plan's size is bounded by ``capacity`` and not by the documents.
4. Pieces take their slots by a join on length and rank.

No task holds more than its own slice of documents and no group is ever sorted
or gathered: a length that a third of all pieces have is only a large number.

Ids are those of the ``tokenizers`` file. The same vocabulary as ranks, if given,
gives the same ids in a fraction of the time; texts in which a special token is
spelt out, and any the faster library refuses, go to ``tokenizers`` itself.

Defined results: a null or empty text has the end id alone. Repeated rows are
packed each for itself, rows without an id as well. An empty table gives no rows.
Columns of ``docs`` other than id and text are not read, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from freshet.llm.common import keep

ROWS_PER_CALL = 256


@dataclass(frozen=True)
class Placement:
    """Pieces of ``length`` with ranks from ``first`` on, ``per`` in each sequence from ``sequence`` on, from ``offset`` on."""

    length: int
    first: int
    last: int
    per: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int) -> tuple[list[Placement], int]:
    """Placements of all pieces, and the number of sequences; best-fit, longest first."""
    rows: list[Placement] = []
    room: dict[int, list[tuple[int, int]]] = {}  # room left -> runs (first sequence, number of them)
    opened = 0
    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0

        def fill(sequence: int, many: int, space: int, rank: int, left: int, length: int = length) -> int:
            """Place up to ``left`` pieces in sequences of equal room, each one filled before the next; how many went in."""
            per = space // length
            whole, rest = min(many, left // per), 0
            if whole:
                rows.append(Placement(length, rank, rank + whole * per, per, sequence, capacity - space))
                room.setdefault(space - per * length, []).append((sequence, whole))
            if whole < many:
                rest = left - whole * per
                if rest:
                    at = rank + whole * per
                    rows.append(Placement(length, at, at + rest, rest, sequence + whole, capacity - space))
                    room.setdefault(space - rest * length, []).append((sequence + whole, 1))
                if many - whole - bool(rest):
                    room.setdefault(space, []).append((sequence + whole + bool(rest), many - whole - bool(rest)))
            return whole * per + rest

        for space in sorted(s for s in room if s >= length):
            for sequence, many in room.pop(space):
                if left:
                    placed = fill(sequence, many, space, rank, left)
                    rank, left = rank + placed, left - placed
                else:
                    room.setdefault(space, []).append((sequence, many))
            if not left:
                break
        if left:
            many = -(-left // (capacity // length))
            fill(opened, many, capacity, rank, left)
            opened += many
        room.pop(0, None)
    return rows, opened


class Encoder:
    """Token ids as by the file ``tokenizer``, with ``ranks`` (the same vocabulary) for speed."""

    def __init__(self, tokenizer: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.plain = Tokenizer.from_file(tokenizer)
        self.special = [t.content for t in self.plain.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks and pattern:
            import base64

            import tiktoken

            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and not any(s in text for s in self.special):
            try:
                return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False)
            except Exception:  # a text it can't split
                pass
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, dtype="<u4")


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n > 0 ids; the first takes what is left over."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))]


def pieces(
    docs: DataFrame, encoder: Callable[[], Callable[[str], np.ndarray]], capacity: int, end_id: int, with_ids: bool, id_col: str, text_col: str
) -> DataFrame:
    """id_col, piece, start, length, ids_crc32, task and number (place among the task's pieces of that length); ids if asked for."""
    from pyspark.sql.pandas.types import to_arrow_schema

    names = ("piece", "start", "length", "ids_crc32", "task", "number")
    fields = [StructField(id_col, docs.schema[id_col].dataType), *(StructField(c, IntegerType() if c == "piece" else LongType()) for c in names)]
    schema = StructType([*fields, *([StructField("ids", ArrayType(IntegerType()))] if with_ids else [])])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        task = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_PER_CALL):
                part = batch.slice(at, ROWS_PER_CALL)
                owner, rows, found = [], [], []
                for place, text in enumerate(part.column(1).to_pylist()):
                    ids = np.concatenate([encode(text), end]) if text else end
                    for number, (start, length) in enumerate(cut(len(ids), capacity)):
                        own = ids[start : start + length]
                        owner.append(place)
                        rows.append((number, start, length, zlib.crc32(own.tobytes()), task, int(seen[length])))
                        seen[length] += 1
                        if with_ids:
                            found.append(own.astype(np.int32))
                columns = [part.column(0).take(pa.array(owner, pa.int64()))]
                columns += [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), list(arrow)[1:7], strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, *([pa.array(found, arrow.field("ids").type)] if with_ids else [])], schema=arrow)

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    pattern: str | None = None,
    capacity: int = 1024,
    end_id: int = 2,
    with_ids: bool = False,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per piece: id_col, piece, start, length, ids_crc32, sequence_id, offset; with its ids if ``with_ids``."""
    cut_up = keep(pieces(docs, lambda: Encoder(tokenizer, ranks, pattern), capacity, end_id, with_ids, id_col, text_col))
    # A task numbers its pieces of a length from zero, so counts are sums over few rows.
    counts = keep(cut_up.groupBy("length", "task").agg(F.count("*").alias("n")))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    placed, _ = plan(histogram, capacity)

    before = F.expr("sum(n) OVER (PARTITION BY length ORDER BY task) - n")
    ranked = cut_up.join(counts.select("length", "task", before.alias("before")), ["length", "task"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("number")).drop("before", "number", "task")

    columns = ["length", "first", "last", "per", "sequence", "offset"]
    rows = [tuple(getattr(p, c) for c in columns) for p in placed]
    slots = docs.sparkSession.createDataFrame(rows, StructType([StructField(c, LongType()) for c in columns]))
    # Bounded by the capacity, see above; ranges of one length don't overlap, so each piece meets one row.
    slots = F.broadcast(slots.withColumnRenamed("length", "size"))
    met = ranked.join(slots, (F.col("length") == F.col("size")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last")))
    turn = F.col("rank") - F.col("first")
    out = met.withColumn("sequence_id", F.col("sequence") + F.expr("(rank - first) div per"))
    out = out.withColumn("offset", F.col("offset") + turn % F.col("per") * F.col("length"))
    return out.select(id_col, "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if with_ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and the ids of each packed sequence, from ``pack`` with ids; a group is one sequence, at most the capacity."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
