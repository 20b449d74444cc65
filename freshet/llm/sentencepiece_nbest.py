"""SentencePiece encoding to the N best segmentations, and decoding.

A text's lattice has a node between any two characters and an arc for each
piece of the vocabulary that occurs there; a character without a piece is an
arc of ``UNKNOWN_PENALTY`` below the least score, written as byte pieces. A
segmentation's score is the sum of its pieces' scores, as the model file
states them.

A forward pass (Viterbi) gives the best scores from the start to each node.
Those are exact heuristics for a backward A* search from the end: the sum of
a partial path's score and the heuristic of its first node is the score of
its best completion, so complete paths come out in order of score. Of equal
ones, the deeper goes first, which keeps the agenda small.

No piece has a word mark after another character, so the lattice falls apart
at the words. A word's forward pass gives its best segmentation and how far
its second best is behind, and the A* search runs only in those words of a text
that can take part in its N best, which are the N - 1 words whose second best is
least behind. The N best of the text are the N best choices among these.

The forward passes of all new words of a slice run side by side in numpy: a trie of
arrays finds the pieces at each place, and one step per end and length of piece
handles all words. What is known of a word is kept; when there are more than
``CACHED_WORDS`` the half that was used most stays.

Defined results: a null text has null columns; an empty one no pieces, score
zero and no alternatives. Texts of any length are encoded whole; one word of
any length is one lattice. Decoding turns word marks into spaces and drops
the first; a text that has word marks itself comes back with spaces. Repeated
rows come out each for itself; an empty table gives no rows. Columns other than
id and text are not read, whatever their names.
"""

from __future__ import annotations

import heapq
import re
from operator import add

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from freshet.llm.common import Codes, map_rows

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 250_000
CACHED_PARTS = 250_000
CACHED_CHOICES = 20_000
SLICE_CHARS = 1_000_000
# Words solved side by side, and the longest that are.
SOLVED_AT_ONCE = 8_192
LONGEST = 64
_NEVER = float("-inf")

EDIT = StructType([StructField("at", IntegerType()), StructField("n", IntegerType()), StructField("ids", ArrayType(IntegerType()))])
ALTERNATIVE = StructType([StructField("score", DoubleType()), StructField("edits", ArrayType(EDIT))])


def read_pieces(model_file: str) -> dict:
    """Pieces and scores of a model file, by kind: plain values that can be sent to tasks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    size = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(size)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
    byte = [model.is_byte(i) for i in range(size)]
    return {
        "pieces": pieces,
        "scores": [model.get_score(i) for i in range(size)],
        "normal": [i for i in range(size) if not special[i] and not byte[i]],
        "bytes": {int(pieces[i][3:-1], 16): i for i in range(size) if byte[i]},
        "unknown": model.unk_id(),
    }


class Trie:
    """Pieces by their characters, in arrays."""

    def __init__(self, pieces: dict[str, int]):
        children: dict[int, int] = {}
        found = {}
        for piece, number in pieces.items():
            node = 0
            for c in piece:
                node = children.setdefault(node << 21 | ord(c), len(children) + 1)
            found[node] = number
        self.longest = max(map(len, pieces), default=0)
        self.keys = np.array(sorted(children), dtype=np.int64)
        self.nodes = np.array([children[k] for k in self.keys.tolist()], dtype=np.int64)
        self.first = np.full(0x110000, -1, dtype=np.int32)
        at_root = self.keys < 1 << 21
        self.first[self.keys[at_root]] = self.nodes[at_root]
        self.piece = np.full(len(children) + 1, -1, dtype=np.int32)
        for node, number in found.items():
            self.piece[node] = number

    def pieces_at(self, codes: np.ndarray) -> np.ndarray:
        """(longest, rows, words): the piece of each length that starts in a cell of ``codes`` (rows, words), or -1; 0 in codes is no character."""
        rows, words = codes.shape
        out = np.full((self.longest, rows, words), -1, dtype=np.int32)
        flat = np.concatenate([codes.ravel(), np.zeros((self.longest + 1) * words, dtype=np.int64)])
        at = np.flatnonzero(flat)
        node = self.first[flat[at]].astype(np.int64)
        at, node = at[node >= 0], node[node >= 0]
        for length in range(self.longest):
            out[length].ravel()[at] = self.piece[node]
            key = node << 21 | flat[at + (length + 1) * words]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            there = self.keys[place] == key
            at, node = at[there], self.nodes[place[there]]
            if not len(at):
                break
        return out


class Encoder:
    def __init__(self, model: dict, n: int = 4):
        self.n = n
        self.unknown, self.bytes = model["unknown"], model["bytes"]
        self.arcs = ahocorasick.Automaton()
        for i in model["normal"]:
            piece = model["pieces"][i]
            self.arcs.add_word(piece, (i, len(piece), model["scores"][i]))
        self.arcs.make_automaton()
        normal = [model["pieces"][i] for i in model["normal"]]
        self.singles = {p for p in normal if len(p) == 1}
        self.trie = Trie({model["pieces"][i]: i for i in model["normal"]})
        # Behind the pieces: characters without one, by numbers of their own, and a last score for cells without anything.
        self.piece_scores = np.array(model["scores"], dtype=np.float64)
        self.single = np.zeros(0x110000, dtype=bool)
        self.single[[ord(c) for c in self.singles]] = True
        self.inside = {p[k : k + 2] for p in normal for k in range(len(p) - 1)}
        self.unknown_score = min(model["scores"][i] for i in model["normal"]) - UNKNOWN_PENALTY
        self.text_of = [p.replace(MARK, " ").encode() for p in model["pieces"]]
        for value, i in self.bytes.items():
            self.text_of[i] = bytes([value])
        self.parts: dict[str, tuple[list[int], float, float]] = {}
        self.choices: dict[str, list[tuple[float, list[int]]]] = {}
        self._forget()

    # -- lattices

    def lattice(self, seg: str) -> list[list[tuple[int, int, float]]]:
        """By end: (start, piece id or -1 for an unknown character, score)."""
        ends: list[list[tuple[int, int, float]]] = [[] for _ in range(len(seg) + 1)]
        for last, (piece, size, score) in self.arcs.iter(seg):
            ends[last + 1].append((last + 1 - size, piece, score))
        for i, c in enumerate(seg):
            if c not in self.singles:
                ends[i + 1].append((i, -1, self.unknown_score))
        return ends

    def forward(self, ends: list) -> list[float]:
        """Best score from the start to each node."""
        best = [0.0]
        for arcs in ends[1:]:
            best.append(max((best[start] + score for start, _, score in arcs), default=_NEVER))
        return best

    def ids(self, seg: str, start: int, end: int, piece: int) -> list[int]:
        if piece >= 0:
            return [piece]
        raw = seg[start:end].encode("utf-8", "replace")
        return [self.bytes[b] for b in raw] if self.bytes else [self.unknown]

    def solve(self, seg: str) -> tuple[list[int], float, float]:
        """Best ids, their score, and how far the second best is behind (infinite if there is none).

        Forward pass that keeps the two best scores of each node. Arcs come
        in order of their ends, so the nodes before are complete.
        """
        if self.singles.issuperset(seg):
            arcs = self.arcs.iter(seg)
        else:
            arcs = ((end - 1, (p, end - start, score)) for end, found in enumerate(self.lattice(seg)) for start, p, score in found)
        size = len(seg) + 1
        best, second = [_NEVER] * size, [_NEVER] * size
        best[0] = 0.0
        back: list[tuple[int, int]] = [(0, 0)] * size
        for last, (piece, length, score) in arcs:
            end = last + 1
            start = end - length
            total = best[start] + score
            if total > best[end]:
                if best[end] > second[end]:
                    second[end] = best[end]
                best[end] = total
                back[end] = (start, piece)
            elif total > second[end]:
                second[end] = total
            total = second[start] + score
            if total > second[end]:
                second[end] = total
        path = []
        at = size - 1
        while at:
            start, piece = back[at]
            if piece >= 0:
                path.append(piece)
            else:
                path += reversed(self.ids(seg, start, at, piece))
            at = start
        path.reverse()
        return path, best[-1], best[-1] - second[-1]

    def n_best(self, seg: str) -> list[tuple[float, list[int]]]:
        """Up to n (score, ids) of a segment in order, by A* from the end."""
        ends = self.lattice(seg)
        best = self.forward(ends)
        agenda = [(-best[-1], len(seg), 0, 0.0, None)]
        found, serial = [], 1
        while agenda and len(found) < self.n:
            _, at, _, tail, path = heapq.heappop(agenda)
            if at == 0:
                ids: list[int] = []
                node = path
                while node:
                    (start, end, piece), node = node
                    ids += self.ids(seg, start, end, piece)
                found.append((tail, ids))
                continue
            for start, piece, score in ends[at]:
                if best[start] > _NEVER:
                    heapq.heappush(agenda, (-(best[start] + score + tail), start, serial, score + tail, ((start, at, piece), path)))
                    serial += 1
        return found

    # -- words of a text, cached

    def _forget(self) -> None:
        self.codes = Codes()
        self.flat = np.zeros(0, dtype=np.int32)
        self.sizes, self.starts, self.uses = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.scores, self.behind = np.zeros(0), np.zeros(0)
        self.exact = np.zeros(0, dtype=bool)

    def _keep_half(self) -> None:
        """Keep the words used most; their counts are halved."""
        names = list(self.codes)
        stay = np.sort(np.argsort(-self.uses, kind="stable")[: CACHED_WORDS // 2])
        sizes = self.sizes[stay]
        ends = np.cumsum(sizes)
        self.flat = self.flat[np.repeat(self.starts[stay] - (ends - sizes), sizes) + np.arange(int(sizes.sum()))]
        self.sizes, self.starts, self.uses = sizes, ends - sizes, self.uses[stay] // 2
        self.scores, self.behind, self.exact = self.scores[stay], self.behind[stay], self.exact[stay]
        self.codes = Codes({names[i]: code for code, i in enumerate(stay.tolist())})

    def solve_many(self, segs: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``solve`` of segments: number of ids, all ids, scores, how far the second best is behind.

        Segments lie side by side, the longest first, so that those that
        reach an end are the first ones of a row.
        """
        lengths = np.fromiter(map(len, segs), dtype=np.int64, count=len(segs))
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        words, rows = len(segs), int(lengths[0])
        codes = np.zeros((rows, words), dtype=np.int64)
        chars = np.frombuffer("".join([segs[i] for i in order.tolist()]).encode("utf-32-le"), dtype=np.uint32)
        first = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(words), lengths)
        codes[np.arange(len(chars)) - first[owner], owner] = chars
        piece = self.trie.pieces_at(codes)
        unknown = (codes > 0) & ~self.single[codes]
        odd, number = np.unique(codes[unknown], return_inverse=True)
        piece[0][unknown] = len(self.piece_scores) + number
        scores = np.concatenate([self.piece_scores, np.full(len(odd), self.unknown_score), [_NEVER]])
        used = (piece >= 0).any(axis=2)
        best, second = np.full((rows + 1, words), _NEVER), np.full((rows + 1, words), _NEVER)
        best[0] = 0.0
        back = np.zeros((rows + 1, words), dtype=np.int64)
        for end in range(1, rows + 1):
            many = int(np.searchsorted(-lengths, -end, side="right"))
            top, other, step = best[end, :many], second[end, :many], back[end, :many]
            # Longest pieces first: of equal scores the first one stays.
            for length in range(min(end, self.trie.longest), 0, -1):
                if not used[length - 1, end - length]:
                    continue
                score = scores[piece[length - 1, end - length, :many]]
                total = best[end - length, :many] + score
                np.maximum(other, np.minimum(top, total), out=other)
                np.maximum(other, second[end - length, :many] + score, out=other)
                better = total > top
                top[better] = total[better]
                step[better] = length
        at, left = lengths.copy(), np.arange(words)
        found = []
        while len(left):
            step = back[at[left], left]
            at[left] -= step
            found.append((left, piece[step - 1, at[left], left]))
            left = left[at[left] > 0]
        out = np.zeros(words, dtype=np.int64)
        out[order] = np.bincount(np.concatenate([w for w, _ in found]), minlength=words)
        ends = np.cumsum(out)[order]
        flat = np.zeros(int(out.sum()), dtype=np.int32)
        for back_from, (w, ids) in enumerate(found):
            flat[ends[w] - 1 - back_from] = ids
        if len(odd):
            sizes, flat = self._spelt_out(out, flat, [self.ids(chr(c), 0, 1, -1) for c in odd.tolist()])
        else:
            sizes = out
        span = np.arange(words)
        total, behind = np.empty(words), np.empty(words)
        total[order] = best[lengths, span]
        behind[order] = best[lengths, span] - second[lengths, span]
        return sizes, flat, total, behind

    def _spelt_out(self, sizes: np.ndarray, flat: np.ndarray, spelt: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids with the numbers behind the pieces replaced by the ids in ``spelt``."""
        own = len(self.piece_scores)
        many = np.array([1] * own + [len(x) for x in spelt])[flat]
        table = np.concatenate([np.arange(own), *spelt]).astype(np.int32)
        start = np.concatenate([np.arange(own), own + np.cumsum([0] + [len(x) for x in spelt])[:-1]])[flat]
        ends = np.cumsum(many)
        out = table[np.repeat(start - (ends - many), many) + np.arange(int(ends[-1]))]
        return np.add.reduceat(many, np.cumsum(sizes) - sizes), out

    def _learn(self, words: list[str]) -> None:
        """Add words, which have the next codes already, to what is known."""
        count = len(words)
        sizes, starts, scores, behind = np.zeros(count, dtype=np.int64), np.zeros(count, dtype=np.int64), np.zeros(count), np.zeros(count)
        exact = np.zeros(count, dtype=bool)
        flats, start = [self.flat], len(self.flat)
        short = [i for i, w in enumerate(words) if len(w) < LONGEST]
        for at in range(0, len(short), SOLVED_AT_ONCE):
            part = short[at : at + SOLVED_AT_ONCE]
            segs = [MARK + words[i] for i in part]
            n, flat, scores[part], behind[part] = self.solve_many(segs)
            sizes[part], starts[part] = n, start + np.cumsum(n) - n
            flats.append(flat)
            start += len(flat)
            ends = [0, *np.cumsum(n).tolist()]
            exact[part] = self._come_back(segs, flat.tolist(), ends)
        for i, w in enumerate(words):
            if len(w) >= LONGEST:
                ids, scores[i], behind[i] = self._solve_parts(w)
                sizes[i], starts[i] = len(ids), start
                flats.append(np.array(ids, dtype=np.int32))
                start += len(ids)
                exact[i] = self._come_back([MARK + w], ids, [0, len(ids)])
        self.flat = np.concatenate(flats)
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])
        self.scores, self.behind = np.concatenate([self.scores, scores]), np.concatenate([self.behind, behind])
        self.exact, self.uses = np.concatenate([self.exact, exact]), np.concatenate([self.uses, np.zeros(count, dtype=np.int64)])

    def _come_back(self, segs: list[str], ids: list[int], ends: list[int]) -> bool | list[bool]:
        """Whether ids decode to the segments; one by one only if they don't together."""
        texts = [*map(self.text_of.__getitem__, ids)]
        if b"".join(texts) == "".join(segs).replace(MARK, " ").encode("utf-8", "surrogatepass"):
            return True
        wanted = (x.replace(MARK, " ").encode("utf-8", "surrogatepass") for x in segs)
        return [b"".join(texts[a:b]) == x for a, b, x in zip(ends[:-1], ends[1:], wanted, strict=True)]

    def _cut(self, seg: str) -> list[str]:
        """The segment, cut where no piece can lie across."""
        inside = self.inside
        if all(map(inside.__contains__, map(add, seg, seg[1:]))):
            return [seg]
        cuts = [i for i in range(1, len(seg)) if seg[i - 1 : i + 1] not in inside]
        return [seg[a:b] for a, b in zip([0, *cuts], [*cuts, len(seg)], strict=True)]

    def _solve_parts(self, word: str) -> tuple[list[int], float, float]:
        """``solve`` of a word of any length, part by part."""
        ids, score, behind = [], 0.0, np.inf
        for part in self._cut(MARK + word):
            got = self.parts.get(part)
            if got is None:
                got = self.solve(part)
                if len(part) < 32:
                    self.parts[part] = got
            ids += got[0]
            score += got[1]
            behind = min(behind, got[2])
        return ids, score, behind

    def words(self, text: str) -> list[str]:
        """Words without their first mark; runs of spaces go with the word after them."""
        if "  " in text or text[0] == " " or text[-1] == " " or MARK in text:
            marked = MARK + text.replace(" ", MARK)
            return [w[1:] for w in re.findall(f"{MARK}+[^{MARK}]*", marked)]
        return text.split(" ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
        """Of non-empty texts: all ids, offsets by text, scores, alternatives by text."""
        return self.encode_checked(texts)[:4]

    def encode_checked(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list, np.ndarray]:
        """As ``encode``, and whether each text comes back from its ids: decoding goes word by word, so it does if all its words do."""
        split = [self.words(t) for t in texts]
        flat_words = [w for ws in split for w in ws]
        if len(self.codes) > CACHED_WORDS:
            self._keep_half()
        if len(self.parts) > CACHED_PARTS:
            self.parts.clear()
        at = np.fromiter(map(self.codes.__getitem__, flat_words), dtype=np.int64, count=len(flat_words))
        if self.codes.new:
            self._learn(self.codes.new)
            self.codes.new = []
        self.uses += np.bincount(at, minlength=len(self.uses))
        n = self.sizes[at]
        ends = np.cumsum(n)
        first = ends - n
        ids = self.flat[np.repeat(self.starts[at] - first, n) + np.arange(int(ends[-1]) if len(ends) else 0)]
        word_ends = np.cumsum([len(ws) for ws in split])
        bounds = np.concatenate(([0], word_ends))
        offsets = np.concatenate(([0], ends[word_ends - 1]))
        totals = np.add.reduceat(self.scores[at], bounds[:-1])
        behind = self.behind[at]
        others = [
            self._alternatives(flat_words, slice(a, b), behind[a:b], first, n, int(offsets[k]), float(totals[k]))
            for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
        ]
        back = np.logical_and.reduceat(self.exact[at], bounds[:-1]) & np.array([MARK not in t for t in texts])
        return ids, offsets, totals, others, back

    def _alternatives(self, words, span, behind, first, n, offset, total) -> list[dict]:
        """The second to n-th best of a text as changes of its best."""
        wanted = self.n - 1
        if wanted < 1:
            return []
        likely = np.arange(len(behind)) if len(behind) <= wanted else np.sort(np.argpartition(behind, wanted - 1)[:wanted])
        picked = [span.start + int(i) for i in likely if behind[i] < np.inf]
        combos: list[tuple[float, tuple]] = [(0.0, ())]
        for w in picked:
            options = self.choices.get(words[w])
            if options is None:
                options = self.n_best(MARK + words[w])
                if len(self.choices) < CACHED_CHOICES and len(words[w]) < 64:
                    self.choices[words[w]] = options
            top = options[0][0]
            combos = heapq.nsmallest(
                self.n,
                [(lost + top - score, (*edits, (w, k)) if k else edits) for lost, edits in combos for k, (score, _) in enumerate(options)],
            )
        return [
            {
                "score": total - lost,
                "edits": [{"at": int(first[w]) - offset, "n": int(n[w]), "ids": self._option(words[w], k)} for w, k in edits],
            }
            for lost, edits in combos
            if edits
        ]

    def _option(self, word: str, k: int) -> list[int]:
        options = self.choices.get(word) or self.n_best(MARK + word)
        return options[k][1]

    def decode(self, ids: list[int]) -> str:
        raw = b"".join(map(self.text_of.__getitem__, ids))
        return raw.removeprefix(b" ").decode("utf-8", "replace")


def _broadcast(spark: SparkSession, model_file: str):
    return spark.sparkContext.broadcast(read_pieces(model_file))


def encode(docs: DataFrame, model_file: str, n: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, n_pieces, ids, score, alternatives (2nd to n-th best, as edits of ids), decoded (does the text come back?)."""
    sent = _broadcast(docs.sparkSession, model_file)
    schema = StructType(
        [
            StructField(id_col, docs.schema[id_col].dataType),
            StructField("n_pieces", LongType()),
            StructField("ids", ArrayType(IntegerType())),
            StructField("score", DoubleType()),
            StructField("alternatives", ArrayType(ALTERNATIVE)),
            StructField("decoded", BooleanType()),
        ]
    )
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def slices(texts: list) -> list[tuple[int, int]]:
        cuts, size = [0], 0
        for i, t in enumerate(texts):
            if size and size + len(t or "") > SLICE_CHARS:
                cuts.append(i)
                size = 0
            size += len(t or "")
        return list(zip(cuts, [*cuts[1:], len(texts)], strict=True))

    def run(batches):
        # A worker keeps its encoder, and the words it knows, from task to task.
        if getattr(sent, "encoder", None) is None or sent.encoder.n != n:
            sent.encoder = Encoder(sent.value, n)
        encoder = sent.encoder
        for batch in batches:
            ids_in, texts_in = (c.to_pylist() for c in batch.columns)
            for a, b in slices(texts_in) if texts_in else ():
                texts = texts_in[a:b]
                full = [i for i, t in enumerate(texts) if t]
                sizes, scores = np.zeros(len(texts), dtype=np.int64), [0.0 if t == "" else None for t in texts]
                others, decoded = [[] if t == "" else None for t in texts], [True if t == "" else None for t in texts]
                values = np.zeros(0, dtype=np.int32)
                if full:
                    values, offsets, totals, found, back = encoder.encode_checked([texts[i] for i in full])
                    for k, i in enumerate(full):
                        sizes[i] = offsets[k + 1] - offsets[k]
                        scores[i] = float(totals[k])
                        others[i] = found[k]
                        decoded[i] = bool(back[k])
                null = np.array([t is None for t in texts], dtype=bool)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values, pa.int32()), mask=pa.array(null)
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids_in[a:b], arrow.field(0).type),
                        pa.array([None if t is None else int(s) for t, s in zip(texts, sizes, strict=True)], pa.int64()),
                        lists.cast(arrow.field(2).type),
                        pa.array(scores, pa.float64()),
                        pa.array(others, arrow.field(4).type),
                        pa.array(decoded, pa.bool_()),
                    ],
                    schema=arrow,
                )

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id_col, text) of arrays of ids; null for null."""
    sent = _broadcast(encoded.sparkSession, model_file)
    schema = StructType([StructField(id_col, encoded.schema[id_col].dataType), StructField("text", StringType())])

    def start():
        encoder = Encoder(sent.value, 1)

        def work(ids, arrays):
            return {id_col: ids, "text": [None if x is None else encoder.decode(x) for x in arrays]}

        return work

    return map_rows(encoded.select(F.col(id_col), F.col(ids_col)), schema, start)
