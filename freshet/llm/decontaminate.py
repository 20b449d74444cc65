"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items form one automaton: its states stand for the
distinct word sequences that occur in an item. Each document's words are
streamed through it, tracking the length of the longest suffix that occurs in
some item. Where that length reaches the window, the last ``window`` words are
hit; an item shorter than the window must occur whole.

Most words of a document can't be part of a window. A table of the word
triples (pairs, words) of the items finds the runs in which every triple
occurs somewhere in an item; all other positions have a matching length below
three and are passed over without a step of the automaton. That changes no
result, since every triple of an occurring window lies in such a run.

Items are dealt into blocks of at most ``BLOCK_WORDS`` words; tasks build the
automaton of each block. A longer item is first cut into pieces that overlap
by ``window - 1`` words, so every window lies whole in one of them. Each block
is sent to the tasks in turn and is one pass over the documents. So what is
sent has a bound, and a benchmark of any size gives whole results.

Defined results: null or wordless texts have no words and no hits. Items that
are null or wordless match nothing; items of equal id count once; an item
whose id is null hits words but isn't named. Repeated documents give repeated
rows. Empty tables of documents give no rows, of items no hits; other columns,
whatever their names, are ignored (``remove_contaminated`` keeps them).
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from freshet.llm.common import keep, map_rows, received

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_LOWER = {c: c + 32 for c in range(65, 91)}
BLOCK_WORDS = 200_000
TABLE_BITS = 22
_MIX = (np.int64(1_000_003), np.int64(611_953), np.int64(7_919))


def words(text: str | None) -> list[bytes]:
    """Lower-cased (A-Z) words of a text, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


class ItemAutomaton:
    """Suffix automaton of several word sequences, with the items at its states."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.codes: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(name, [self.codes.setdefault(w, len(self.codes)) for w in seq]) for name, seq in items if seq]
        for _, seq in coded:
            last = 0
            for code in seq:
                last = self._extend(last, code)
        self.least = min([window, *(len(seq) for _, seq in coded)])
        self.gram = min(3, self.least)
        self._mark(coded)

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.length) - 1

    def _split(self, parent: int, child: int, code: int) -> int:
        """The state of the shorter sequences of ``child``, reached from ``parent``."""
        if self.length[parent] + 1 == self.length[child]:
            return child
        copy = self._state(self.length[parent] + 1, self.link[child], dict(self.next[child]))
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(code) == child:
            self.next[parent][code] = copy
            parent = self.link[parent]
        return copy

    def _extend(self, last: int, code: int) -> int:
        if code in self.next[last]:
            return self._split(last, self.next[last][code], code)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and code not in self.next[at]:
            self.next[at][code] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, self.next[at][code], code)
        return new

    def _suffix(self, state: int, length: int) -> int:
        """The state of the last ``length`` words of what ``state`` stands for."""
        while self.length[self.link[state]] >= length and state:
            state = self.link[state]
        return state

    def _mark(self, coded: list[tuple[str | None, list[int]]]) -> None:
        self.items: dict[int, set[str]] = {}
        whole: dict[int, dict[int, tuple[int, set[str]]]] = {}
        shorts = 0
        self.table = np.zeros(1 << TABLE_BITS, dtype=bool)
        for name, seq in coded:
            state = 0
            for i, code in enumerate(seq):
                state = self.next[state][code]
                if i + 1 >= self.window:
                    names = self.items.setdefault(self._suffix(state, self.window), set())
                    if name is not None:
                        names.add(name)
            if len(seq) < self.window:
                same = whole.setdefault(self._suffix(state, len(seq)), {})
                if len(seq) not in same:
                    shorts += 1
                    same[len(seq)] = (-shorts, set())
                if name is not None:
                    same[len(seq)][1].add(name)
            if len(seq) >= self.gram:
                self.table[self.slots(np.array(seq, dtype=np.int64))] = True
        by_length = sorted(range(len(self.length)), key=self.length.__getitem__)
        self.window_state = [0] * len(by_length)
        # (words, mark below zero, names) of the short items at a state: one for each length below the window
        self.whole: dict[int, list[tuple[int, int, set[str]]]] = {}
        for s in by_length[1:]:
            up = self.link[s]
            self.window_state[s] = self.window_state[up] if self.length[up] >= self.window else s
            if found := [(size, *short) for size, short in whole.get(s, {}).items()] + self.whole.get(up, []):
                self.whole[s] = found

    def slots(self, codes: np.ndarray) -> np.ndarray:
        n = len(codes) - self.gram + 1
        mixed = sum(codes[k : k + n] * _MIX[k] for k in range(self.gram))
        return (mixed ^ (mixed >> 15)) & ((1 << TABLE_BITS) - 1)

    def runs(self, codes: np.ndarray) -> list[tuple[int, int]]:
        """Word ranges in which every gram may occur in an item, long enough for a window."""
        if len(codes) < self.least:
            return []
        known = codes >= 0
        n = len(codes) - self.gram + 1
        hit = self.table[self.slots(codes)]
        for k in range(self.gram):
            hit &= known[k : k + n]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
        starts, ends = edges[::2], edges[1::2]
        long = ends - starts >= self.least - self.gram + 1
        return list(zip(starts[long].tolist(), (ends[long] + self.gram - 1).tolist(), strict=True))

    def search(self, seq: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit word ranges (merged, in order, ends exclusive) and the names of the items."""
        get = self.codes.get
        codes = np.fromiter((get(w, -1) for w in seq), dtype=np.int64, count=len(seq))
        ranges: list[list[int]] = []
        names: set[str] = set()
        seen: set[int] = set()

        def hit(start: int, end: int) -> None:
            while ranges and ranges[-1][1] >= start:
                start = min(start, ranges.pop()[0])
            ranges.append([start, end])

        nxt, link, length, window = self.next, self.link, self.length, self.window
        for start, end in self.runs(codes):
            state = matched = 0
            for i, code in enumerate(codes[start:end].tolist(), start + 1):
                while state and code not in nxt[state]:
                    state = link[state]
                    matched = length[state]
                if code in nxt[state]:
                    state = nxt[state][code]
                    matched += 1
                if matched >= window:
                    hit(i - window, i)
                    if (at := self.window_state[state]) not in seen:
                        seen.add(at)
                        names |= self.items[at]
                for size, mark, short in self.whole.get(state, ()):
                    if matched >= size:
                        hit(i - size, i)
                        if mark not in seen:
                            seen.add(mark)
                            names |= short
        return [(a, b) for a, b in ranges], names

    @classmethod
    def of(cls, parts: dict) -> ItemAutomaton:
        """An automaton from its parts, as a task packed them."""
        made = cls.__new__(cls)
        made.__dict__ = parts
        return made


def item_pieces(benchmark: DataFrame, item_col: str, text_col: str, window: int, piece_words: int) -> DataFrame:
    """``item, piece, n``: the distinct items as words with single spaces, cut where they have more than ``piece_words``."""
    step = piece_words - window + 1

    def start():
        def work(items, texts):
            cut = []
            for item, text in zip(items, texts, strict=True):
                seq = words(text)
                for at in range(0, max(len(seq) - window, 0) + 1 if seq else 0, step):
                    piece = seq[at : at + piece_words]
                    cut.append((item, b" ".join(piece).decode("utf-8", "surrogatepass"), len(piece)))
            return {name: [c[k] for c in cut] for k, name in enumerate(("item", "piece", "n"))}

        return work

    schema = StructType([StructField("item", StringType()), StructField("piece", StringType()), StructField("n", LongType())])
    picked = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(text_col).alias("t"))
    return map_rows(picked.where("t IS NOT NULL").distinct(), schema, start)


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_words: int) -> Iterator[bytes]:
    """One packed automaton after the other, over at most ``block_words`` words each (or two windows, if these are more).

    Tasks build them, each from its share of the pieces, and write them to the
    shared folder; the driver passes on one share at a time.
    """
    piece_words = max(block_words // 4, 2 * window)
    pieces = keep(item_pieces(benchmark, item_col, text_col, window, piece_words))
    total = pieces.agg(F.sum("n")).first()[0]
    if not total:
        return

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple[str | None, list[bytes]]] = []
        size = 0

        def packed() -> pa.RecordBatch:
            parts = pickle.dumps(vars(ItemAutomaton(block, window)), protocol=pickle.HIGHEST_PROTOCOL)
            return pa.RecordBatch.from_arrays([pa.array([parts], pa.binary())], names=["automaton"])

        for batch in batches:
            for item, piece in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                seq = words(piece)
                if block and size + len(seq) > block_words:
                    yield packed()
                    block, size = [], 0
                block.append((item, seq))
                size += len(seq)
        if block:
            yield packed()

    shares = pieces.select("item", "piece").repartition(-(-total // block_words))
    for row in keep(shares.mapInArrow(build, "automaton binary")).toLocalIterator():
        yield bytes(row["automaton"])


_RANGES = ArrayType(ArrayType(IntegerType()))


def _through_blocks(frame: DataFrame, blocks, text_at: int, schema: StructType, finish) -> DataFrame:
    """Search each text in all blocks, one pass per block, then apply ``finish``.

    ``finish(rows, found)`` gets the rows of a slice and, for each, its hit
    ranges and item names; it returns the columns of ``schema``. What passes
    find goes along with the rows and is written between passes, so that one
    automaton at a time is in memory.
    """
    carried = StructType(
        [
            *frame.schema.fields,
            StructField("found_ranges", _RANGES),
            StructField("found_items", ArrayType(StringType())),
        ]
    )
    names = carried.fieldNames()
    frame = frame.select(
        "*", F.lit(None).cast(_RANGES).alias("found_ranges"), F.lit(None).cast("array<string>").alias("found_items")
    )
    block = next(blocks, None) or pickle.dumps(vars(ItemAutomaton([], 1)))
    while block is not None:
        following = next(blocks, None)
        sent = frame.sparkSession.sparkContext.broadcast(block)

        def start(sent: Broadcast = sent, last=following is None):
            search = ItemAutomaton.of(received(sent)).search

            def work(*columns):
                rows, found = [], []
                for *row, old, named in zip(*columns, strict=True):
                    new, more = search(words(row[text_at]))
                    found.append((merge_ranges(old or [], new), sorted({*(named or []), *more})))
                    rows.append(row)
                if last:
                    return finish(rows, found)
                ranges, items = zip(*found, strict=True)
                return dict(zip(names, [*columns[:-2], list(ranges), list(items)], strict=True))

            return work

        frame = map_rows(frame, schema if following is None else carried, start)
        if following is not None:
            frame = keep(frame)
        block = following
    return frame


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per document: id_col, n_words, n_hit, items (sorted texts), spans of hits in code points.

    One row per row of ``docs``; other columns of both inputs are ignored.
    """
    picked = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("body"))
    result = StructType(
        [
            StructField(id_col, docs.schema[id_col].dataType),
            StructField("n_words", LongType()),
            StructField("n_hit", LongType()),
            StructField("items", ArrayType(StringType())),
            StructField("spans", _RANGES),
        ]
    )

    def finish(rows, found):
        return {
            id_col: [r[0] for r in rows],
            "n_words": [len(words(r[1])) for r in rows],
            "n_hit": [sum(b - a for a, b in ranges) for ranges, _ in found],
            "items": [names for _, names in found],
            "spans": [char_ranges(r[1], ranges) if ranges else [] for r, (ranges, _) in zip(rows, found, strict=True)],
        }

    blocks = item_blocks(benchmark, item_col, item_text_col, window, block_words)
    return _through_blocks(picked, blocks, 1, result, finish)


def merge_ranges(one: list, two: list) -> list[tuple[int, int]]:
    merged: list[list[int]] = []
    for start, end in sorted(map(tuple, [*one, *two])):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [(a, b) for a, b in merged]


def char_ranges(text: str, ranges: list) -> list[tuple[int, int]]:
    """From the first code point of the first word to the end of the last, per range of words."""
    at = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, **names) -> DataFrame:
    """Counts and digests per document: n_words, n_hit, n_items, items_sha256, contaminated, spans."""
    return find_benchmark(docs, benchmark, window, **names).select(
        names.get("id_col", "doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.array_join(F.transform("spans", lambda r: F.array_join(r, ":")), ",").alias("spans"),
    )


def remove_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    max_coverage: float = 0.5,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """``docs`` without benchmark passages.

    Every hit span is cut out of its text; a document of whose words more than
    ``max_coverage`` are hit goes whole. All columns stay as they were, but for
    the text; documents without hits are left untouched, null texts included.
    """
    at = docs.columns.index(text_col)
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])

    def finish(rows, found):
        left = []
        for row, (ranges, _) in zip(rows, found, strict=True):
            if ranges:
                if sum(b - a for a, b in ranges) > max_coverage * len(words(row[at])):
                    continue
                row[at] = cut_out(row[at], char_ranges(row[at], ranges))
            left.append(row)
        return {f.name: [row[i] for row in left] for i, f in enumerate(inner)}

    blocks = item_blocks(benchmark, item_col, item_text_col, window, block_words)
    return _through_blocks(docs.toDF(*inner.fieldNames()), blocks, at, inner, finish).toDF(*docs.columns)


def cut_out(text: str, ranges: list[tuple[int, int]]) -> str:
    parts, last = [], 0
    for start, end in ranges:
        parts.append(text[last:start])
        last = end
    return "".join([*parts, text[last:]])
