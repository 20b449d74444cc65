"""Language identification by averaged hashed subword embeddings.

A text is the mean of the embeddings of its subwords: each word, its edges
marked, gives its character 2- to 4-grams and itself, and single characters
too if it has any beyond ASCII, hashed to ``BUCKETS`` rows. A linear softmax over
the mean gives the languages. Both layers are trained by stochastic gradient
descent in numpy on a bounded sample: of each language the ``ROWS_PER_LANGUAGE``
distinct (id, text) with the least hashes. How many languages there are is
bounded by the labels alone, as the model is.

Since mean and softmax are linear, a trained model is one table of language
logits per bucket, and a text costs one sum over its words. The subwords of all
new words of a slice are hashed and summed at once in numpy. Sums of words are
kept; when there is no more room, the half that was used most stays. A temperature
fitted on held-back rows calibrates the probabilities, and ``reject_below`` is the
least probability at which the held-back rows are right often enough (``REJECT_RIGHT``).

Defined results: a text that is null or has no letter is ``und`` with score 0;
rejected texts keep their likeliest language and are flagged. If no labelled
row exists, everything is ``und``. Ties go to the first language in order.
Rows that repeat an id and text are learned from once and predicted each for
itself; rows without an id are told apart by their texts. An empty table gives
no rows. Columns other than id, text and language are not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StringType, StructField, StructType

from freshet.llm.common import Codes, least_hashed, map_rows, received, send

# Bound of the training sample: rows per language.
ROWS_PER_LANGUAGE = 800
BUCKETS = 1 << 15
DIMENSION = 12
# Bounds of what is kept: words, and numbers in their sums.
CACHED_WORDS = 200_000
CACHED_NUMBERS = 16_000_000
LEARNED_AT_ONCE = 8_192
REJECT_RIGHT = 0.9

_WORD = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    found = _WORD.findall(text.lower()) if text else []
    if found and not found[0].isalpha():  # signs such as a raised two count as alphanumeric, not as letters
        found = [w for w in found if any(map(str.isalpha, w))]
    return found


def buckets(word: str) -> list[int]:
    """Hashed subwords of a word."""
    marked = f"<{word}>".encode("utf-8", "surrogatepass") if word.isascii() else f"<{word}>"
    n = len(marked)
    if isinstance(marked, bytes):
        grams = [marked[i : i + k] for k in (2, 3, 4) for i in range(n - k + 1)]
    else:
        grams = [marked[i : i + k].encode("utf-8", "surrogatepass") for k in (1, 2, 3, 4) for i in range(n - k + 1)]
        marked = marked.encode("utf-8", "surrogatepass")
    grams.append(b"=" + marked)
    return [zlib.crc32(g) & (BUCKETS - 1) for g in grams]


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


CRC = _crc_table()


def crc_of_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``zlib.crc32`` of each span of the bytes."""
    state = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    open_, at = np.arange(len(starts)), starts
    while len(open_):
        state[open_] = CRC[(state[open_] ^ raw[at]) & 0xFF] ^ (state[open_] >> 8)
        more = at + 1 < ends[open_]
        open_, at = open_[more], at[more] + 1
    return state ^ np.uint32(0xFFFFFFFF)


def bucket_sums(words: list[str], table: np.ndarray) -> np.ndarray:
    """Of each word the sum of the table's rows over ``buckets``, and last their number."""
    joined = f"<{'><'.join(words)}>".encode("utf-8", "surrogatepass")
    raw = np.frombuffer(joined, dtype=np.uint8)
    chars = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    last = np.cumsum(sizes)
    word = np.repeat(np.arange(len(words)), sizes)
    left = last[word] - np.arange(len(word))
    plain = chars[last] - chars[last - sizes] == sizes
    out = np.zeros((len(words), table.shape[1] + 1))
    for k in (1, 2, 3, 4):
        at = np.flatnonzero((left >= k) & ~plain[word] if k == 1 else left >= k)
        if not len(at):
            continue
        rows = table[crc_of_spans(raw, chars[at], chars[at + k]) & (BUCKETS - 1)]
        owner, first, count = np.unique(word[at], return_index=True, return_counts=True)
        out[owner, :-1] += np.add.reduceat(rows, first, axis=0)
        out[owner, -1] += count
    edges = chars[np.append(0, last)].tolist()
    sign = zlib.crc32(b"=")
    whole = [zlib.crc32(joined[a:b], sign) & (BUCKETS - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    out[:, :-1] += table[whole]
    out[:, -1] += 1
    return out


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray | None = None
    temperature: float = 1.0
    reject_below: float = 0.0
    _codes: Codes = field(default_factory=Codes, repr=False)
    _rows: np.ndarray | None = field(default=None, repr=False)
    _uses: np.ndarray | None = field(default=None, repr=False)

    def _room(self) -> int:
        return max(1_000, min(CACHED_WORDS, CACHED_NUMBERS // (len(self.languages) + 1)))

    def _forget(self) -> None:
        """Keep the half of the words that was used most; their counts are halved."""
        names = list(self._codes)
        stay = np.sort(np.argsort(-self._uses[: len(names)], kind="stable")[: self._room() // 2])
        self._rows[: len(stay)] = self._rows[stay]
        self._uses[: len(stay)] = self._uses[stay] // 2
        self._uses[len(stay) :] = 0
        self._codes = Codes({names[i]: code for code, i in enumerate(stay.tolist())})

    def _sums(self, words: list[str]) -> np.ndarray:
        """Per word, of at most a quarter of what there is room for: logits summed over its subwords, and last their number."""
        if self._rows is None:
            self._rows = np.zeros((self._room() * 5 // 4, len(self.languages) + 1))
            self._uses = np.zeros(len(self._rows), dtype=np.int64)
        if len(self._codes) > self._room():
            self._forget()
        codes = np.fromiter(map(self._codes.__getitem__, words), dtype=np.int64, count=len(words))
        first = len(self._codes) - len(self._codes.new)
        for at in range(0, len(self._codes.new), LEARNED_AT_ONCE):
            part = self._codes.new[at : at + LEARNED_AT_ONCE]
            self._rows[first + at : first + at + len(part)] = bucket_sums(part, self.table)
        self._codes.new = []
        self._uses += np.bincount(codes, minlength=len(self._uses))
        return self._rows[codes]

    def logits(self, texts: list[str | None]) -> np.ndarray:
        """One row per text; a row of NaN where there is no letter."""
        total = np.zeros((len(texts), len(self.languages) + 1))
        most = self._room() // 4
        words: list[str] = []
        parts: list[tuple[int, int]] = []  # (text, first of its words)

        def add() -> None:
            if words:
                owners, firsts = zip(*parts, strict=True)
                np.add.at(total, list(owners), np.add.reduceat(self._sums(words), list(firsts), axis=0))
            words.clear()
            parts.clear()

        for i, text in enumerate(texts):
            found = letter_words(text)
            for at in range(0, len(found), most):
                part = found[at : at + most]
                if len(words) + len(part) > most:
                    add()
                parts.append((i, len(words)))
                words += part
        add()
        with np.errstate(invalid="ignore"):
            return total[:, :-1] / np.where(total[:, -1:] > 0, total[:, -1:], np.nan)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        return softmax(self.logits(texts) / self.temperature)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[str], langs: list[str], epochs: int = 4, rate: float = 2.0, seed: int = 11) -> Model:
    """Fit on four fifths of the rows; calibrate on the rest."""
    model = Model(sorted(set(langs)))
    if not langs:
        return model
    number = {x: i for i, x in enumerate(model.languages)}
    rng = np.random.default_rng(seed)
    rows, truth, kept = [], [], []
    seen: dict[str, list[int]] = {}
    for i, text in enumerate(texts):
        words = letter_words(text)
        if not words:
            continue
        if len(seen) > CACHED_WORDS // 2:
            seen.clear()
        flat: list[int] = []
        for w in words:
            if (b := seen.get(w)) is None:
                b = seen[w] = buckets(w)
            flat += b
        at, count = np.unique(np.array(flat, dtype=np.int32), return_counts=True)
        rows.append((at, (count / count.sum()).astype(np.float32)))
        truth.append(number[langs[i]])
        kept.append(i)
    embed = rng.uniform(-1, 1, (BUCKETS, DIMENSION)).astype(np.float32) / DIMENSION
    out = np.zeros((DIMENSION, len(model.languages)), dtype=np.float32)
    order = rng.permutation(len(rows))
    held = order[: len(order) // 5] if len(order) >= 10 else order[:0]
    used = order[len(held) :]
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(used):
            at, weight = rows[i]
            mean = weight @ embed[at]
            error = softmax(mean @ out)
            error[truth[i]] -= 1
            back = out @ error
            out -= step * np.outer(mean, error)
            embed[at] -= step * 4 * weight[:, None] * back
    model.table = (embed @ out).astype(np.float64)
    _calibrate(model, [rows[i] for i in (held if len(held) else used)], np.array([truth[i] for i in (held if len(held) else used)]))
    return model


def _calibrate(model: Model, rows: list, truth: np.ndarray) -> None:
    """The temperature with the least log loss, then the rejection bound."""
    if not len(rows):
        return
    logits = np.stack([w @ model.table[at] for at, w in rows])
    logits = logits.astype(np.float64)
    span = np.arange(len(truth))

    def loss(t: float) -> float:
        return float(-np.log(softmax(logits / t)[span, truth] + 1e-12).mean())

    model.temperature = min((2.0**k for k in np.arange(-4, 4.25, 0.25)), key=loss)
    p = softmax(logits / model.temperature)
    best, right = p.max(axis=1), p.argmax(axis=1) == truth
    for bound in np.arange(0.95, 0.0, -0.05):
        near = (best >= bound) & (best < bound + 0.05)
        if near.any() and right[near].mean() < REJECT_RIGHT:
            model.reject_below = float(bound + 0.05)
            break


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model:
    """Train on at most ``ROWS_PER_LANGUAGE`` distinct rows of each language."""
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"), F.col(lang_col).alias("l"))
    got = least_hashed(rows, ["id", "t"], ROWS_PER_LANGUAGE, kind="l").select("t", "l").toArrow()
    pairs = sorted(zip(got["l"].to_pylist(), got["t"].to_pylist(), strict=True))
    return train([t for _, t in pairs], [lang for lang, _ in pairs])


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id_col, lang_pred, score (calibrated probability), rejected."""
    sent = send(docs.sparkSession, model)
    schema = StructType(
        [
            StructField(id_col, docs.schema[id_col].dataType),
            StructField("lang_pred", StringType()),
            StructField("score", DoubleType()),
            StructField("rejected", BooleanType()),
        ]
    )

    def start():
        model = received(sent)

        def work(ids, texts):
            if not model.languages or model.table is None:
                n = len(ids)
                return {id_col: ids, "lang_pred": ["und"] * n, "score": [0.0] * n, "rejected": [True] * n}
            p = model.probabilities(texts)
            best = np.where(np.isnan(p[:, 0]), -1, np.nan_to_num(p).argmax(axis=1))
            top = np.where(best < 0, 0.0, np.nan_to_num(p).max(axis=1))
            return {
                id_col: ids,
                "lang_pred": [model.languages[b] if b >= 0 else "und" for b in best.tolist()],
                "score": pa.array(top, pa.float64()),
                "rejected": pa.array((best < 0) | (top < model.reject_below), pa.bool_()),
            }

        return work

    return map_rows(docs.select(F.col(id_col), F.col(text_col)), schema, start)
