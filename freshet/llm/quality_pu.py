"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives P are the rows marked good, the unlabelled rows U are any
web text. With a class prior ``pi``, the risk of a logistic score g is

    pi * mean_P l(g, +1) + max(0, mean_U l(g, -1) - pi * mean_P l(g, -1))

The second term is the risk of the bad rows, estimated without any of them.
Where it would turn negative the model overfits the positives, and the step
goes the other way. A small network on standardised text statistics is
trained in numpy on bounded samples; scoring is one pass in Arrow tasks.

The prior is estimated from P and U by a first fit: the share of U that scores
at least as the best ``PRIOR_SHARE`` of P do, by that share of P itself. Labels
that say bad aren't used; the share of good ones among all labels is only
kept beside it (``labelled_share``), to see how far off the estimate is.

The samples are the distinct (id, text) with the least hashes, ``POSITIVE_ROWS``
and ``UNLABELLED_ROWS`` of them; a row that repeats counts as often as it does,
as long as all fit into that bound.

The statistics are shares and means over the whole text: pairs of character
classes, word lengths, repeated words and lines, line lengths.

Defined results: null and empty texts are scored like each other (all
statistics zero). Labels other than 1 count as none; a document that has a 1 among
several labels is trusted. Rows without an id are unlabelled. Without any positive,
every score is ``pi``. Repeated rows are scored each for itself; an empty table
gives no rows. Columns other than id, text and label are not read, whatever their names.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, LongType, StructField, StructType

from freshet.llm.common import least_hashed, map_rows, received, resampled, send

# Bounds of the training samples, in rows.
POSITIVE_ROWS = 8_000
UNLABELLED_ROWS = 16_000
PRIOR_SHARE = 0.8
DEFAULT_PRIOR = 0.5
HIDDEN = 16


def _classes() -> np.ndarray:
    """Class of each byte: lower, upper, digit, space, line end, then one each for groups of signs, and beyond ASCII."""
    kinds = np.full(256, 10, dtype=np.uint8)
    for number, chars in enumerate(
        ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".,", "!?", "-'\"():;", "|/\\_=<>[]{}", "#$%&*+@^~`")
    ):
        kinds[[ord(c) for c in chars]] = number
    kinds[128:] = 0
    return kinds


CLASSES = _classes()
N_CLASSES = 11
N_FEATURES = N_CLASSES * N_CLASSES + 8


def statistics(text: str | None) -> np.ndarray:
    """Statistics of a whole text."""
    out = np.zeros(N_FEATURES, dtype=np.float32)
    if not text:
        return out
    raw = text.encode("utf-8", "surrogatepass")
    kinds = CLASSES[np.frombuffer(raw, dtype=np.uint8)].astype(np.int64)
    pairs = np.bincount(kinds[:-1] * N_CLASSES + kinds[1:], minlength=N_CLASSES * N_CLASSES)
    out[: N_CLASSES * N_CLASSES] = np.sqrt(pairs / max(1, len(kinds) - 1))
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x]
    n = max(1, len(words))
    sizes = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    spread = len(set(words)) / n
    out[-8:] = (
        math.log1p(len(words)) / 10,
        sizes.mean() / 10,
        sizes.std() / 10,
        math.log1p(sizes.max()) / 5,
        spread,
        spread * math.log1p(n) / 5,
        len(set(lines)) / max(1, len(lines)),
        math.log1p(len(words) / max(1, len(lines))) / 5,
    )
    return out


@dataclass
class Model:
    prior: float
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: tuple = ()
    labelled_share: float | None = None

    def logits(self, rows: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(rows), math.log(self.prior / (1 - self.prior)))
        w1, b1, w2, b2 = self.weights
        x = np.clip((rows - self.mean) / self.scale, -8, 8)
        return np.tanh(x @ w1 + b1) @ w2 + b2

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -30, 30)))


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 40, seed: int = 7) -> Model:
    """Minimise the non-negative risk with Adam over mini-batches."""
    prior = min(max(prior, 0.01), 0.99)
    model = Model(prior)
    if not len(positive) or not len(unlabelled):
        return model
    rng = np.random.default_rng(seed)
    model.mean, model.scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 0.02
    p, u = (np.clip((x - model.mean) / model.scale, -8, 8).astype(np.float64) for x in (positive, unlabelled))
    params = [rng.normal(0, 0.1, (p.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, HIDDEN), np.zeros(1)]
    first, second = [np.zeros_like(w) for w in params], [np.zeros_like(w) for w in params]
    step = 0
    batches = max(4, min(40, len(u) // 256))
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        for pi_rows, u_rows in zip(
            np.array_split(rng.permutation(np.resize(np.arange(len(p)), max(len(p), batches))), batches),
            np.array_split(rng.permutation(np.resize(np.arange(len(u)), max(len(u), batches))), batches),
            strict=True,
        ):
            x = np.concatenate([p[pi_rows], u[u_rows]])
            n_p, n_u = len(pi_rows), len(u_rows)
            hidden = np.tanh(x @ params[0] + params[1])
            g = hidden @ params[2] + params[3]
            s = 1 / (1 + np.exp(-np.clip(g, -30, 30)))
            loss_negative = np.logaddexp(0, g)
            bad_risk = loss_negative[n_p:].mean() - prior * loss_negative[:n_p].mean()
            slope = np.empty_like(g)
            if bad_risk >= 0:
                slope[:n_p] = prior * ((s[:n_p] - 1) - s[:n_p]) / n_p
                slope[n_p:] = s[n_p:] / n_u
            else:
                slope[:n_p] = prior * s[:n_p] / n_p
                slope[n_p:] = -s[n_p:] / n_u
            back = np.outer(slope, params[2]) * (1 - hidden**2)
            grads = [x.T @ back + 1e-4 * params[0], back.sum(0), hidden.T @ slope + 1e-4 * params[2], slope.sum(keepdims=True)]
            step += 1
            for w, m, v, d in zip(params, first, second, grads, strict=True):
                m += 0.1 * (d - m)
                v += 0.001 * (d * d - v)
                w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    model.weights = tuple(params)
    return model


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray) -> float:
    """The class prior, by scores of a first fit."""
    if not len(positive) or not len(unlabelled):
        return DEFAULT_PRIOR
    guess = train(positive, unlabelled, DEFAULT_PRIOR, epochs=10)
    trusted = guess.scores(positive)
    bound = np.quantile(trusted, 1 - PRIOR_SHARE)
    return float((guess.scores(unlabelled) >= bound).mean() / (trusted >= bound).mean())


def _features(sample: DataFrame, text_col: str, most: int) -> np.ndarray:
    """Statistics of the sample's texts, repeated by weight."""
    schema = StructType([StructField("x", ArrayType(FloatType())), StructField("w", LongType())])

    def start():
        return lambda texts, weights: {"x": [statistics(t) for t in texts], "w": weights}

    # Each text in one order: that of its hash.
    found = map_rows(sample.orderBy(F.xxhash64(text_col)).select(text_col, "weight"), schema, start).toArrow()
    rows = np.asarray(found["x"].combine_chunks().flatten(), dtype=np.float32).reshape(-1, N_FEATURES)
    return rows[resampled(found["w"].to_numpy(), most)]


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", prior: float | None = None
) -> Model:
    """Train on ``docs`` (unlabelled) and those of them that ``labels`` marks 1 (trusted)."""
    rows = docs.select(F.col(id_col), F.col(text_col))
    good = labels.where(F.col(label_col) == 1).select(id_col).distinct()
    positive = _features(least_hashed(rows, [id_col, text_col], POSITIVE_ROWS, among=good), text_col, POSITIVE_ROWS)
    unlabelled = _features(least_hashed(rows, [id_col, text_col], UNLABELLED_ROWS), text_col, UNLABELLED_ROWS)
    model = train(positive, unlabelled, estimated_prior(positive, unlabelled) if prior is None else prior)
    known = labels.agg(F.count_if(F.col(label_col) == 1), F.count_if(F.col(label_col).isin(0, 1))).first()
    model.labelled_share = known[0] / known[1] if known[1] else None
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) per row."""
    sent = send(docs.sparkSession, model)
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("score", DoubleType())])

    def start():
        def work(ids, texts):
            rows = np.stack([statistics(t) for t in texts]) if texts else np.zeros((0, N_FEATURES))
            return {id_col: ids, "score": pa.array(received(sent).scores(rows), pa.float64())}

        return work

    return map_rows(docs.select(F.col(id_col), F.col(text_col)), schema, start)


def keep_good(docs: DataFrame, model: Model, threshold: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score ``threshold`` or more, with all their columns."""
    sent = send(docs.sparkSession, model)
    at = docs.columns.index(text_col)
    inner = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate(docs.schema.fields)])

    def start():
        def work(*columns):
            rows = np.stack([statistics(t) for t in columns[at]])
            good = np.flatnonzero(received(sent).scores(rows) >= threshold).tolist()
            return {f.name: [c[i] for i in good] for f, c in zip(inner, columns, strict=True)}

        return work

    return map_rows(docs.toDF(*inner.fieldNames()), inner, start).toDF(*docs.columns)
