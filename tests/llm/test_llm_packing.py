"""Packing, fill-in-the-middle and centroid clustering against plain versions, and on odd rows."""

from __future__ import annotations

import hashlib
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))

from freshet.llm import best_fit, centroid_tree, fill_middle  # noqa: E402
from freshet.llm.queries import BYTE_RANKS, BYTE_TOKENIZER, QUERIES  # noqa: E402

FILES = {"tokenizer": public_tokenizers.path(BYTE_TOKENIZER), "ranks": public_tokenizers.path(BYTE_RANKS), "pattern": public_tokenizers.PATTERN}
SCHEMA = "length int, doc_id long, task string, text string, place int, row string, body string, form string, rank int, first int"
LONG = "a rather long text, " * 30_000
ROWS = [(1, None), (2, ""), (3, LONG), (3, LONG), (4, "kept <P> as it is"), (5, "été 🙂 naïve"), (None, "no id"), (6, "ends <|endoftext|> here"), (7, "same"), (8, "same")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(1, i, "x", t, 2, "r", "b", "f", 3, 4) for i, t in ROWS], SCHEMA).repartition(3).cache()


def plain_best_fit(lengths: list[int], capacity: int) -> int:
    room: list[int] = []
    for length in sorted(lengths, reverse=True):
        fitting = [(r, i) for i, r in enumerate(room) if r >= length]
        if fitting:
            room[min(fitting)[1]] -= length
        else:
            room.append(capacity - length)
    return len(room)


def check_slots(slots: dict[int, list[tuple[int, int]]], capacity: int) -> None:
    for found in slots.values():
        end = 0
        for offset, length in sorted(found):
            assert offset == end
            end += length
        assert end <= capacity


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 40).flatmap(lambda c: st.tuples(st.just(c), st.lists(st.integers(1, c), max_size=60))))
def test_plan_is_best_fit(case):
    capacity, lengths = case
    rows, n = best_fit.plan(Counter(lengths), capacity)
    slots: dict[int, list[tuple[int, int]]] = {}
    taken: Counter = Counter()
    for p in rows:
        for rank in range(p.first, p.last):
            turn = rank - p.first
            slots.setdefault(p.sequence + turn // p.per, []).append((p.offset + turn % p.per * p.length, p.length))
            taken[p.length] += 1
    assert n == plain_best_fit(lengths, capacity) and set(slots) == set(range(n)) and taken == Counter(lengths)
    check_slots(slots, capacity)


def test_plan_does_not_grow_with_the_documents():
    few, many = ({i: count * (1 + i % 7) for i in range(1, 1025)} for count in (1, 10**9))
    assert len(best_fit.plan(many, 1024)[0]) < 4 * 1024
    assert len(best_fit.plan(few, 1024)[0]) < 4 * 1024


def test_packed_documents(spark, medium):
    texts = dict(duckdb.sql(f"select doc_id, text from read_parquet('{medium}/documents.parquet')").fetchall())
    plain = Tokenizer.from_file(FILES["tokenizer"])
    slots: dict[int, list[tuple[int, int]]] = {}
    by_doc: dict[int, list] = {}
    for r in QUERIES["op11_best_fit_packing"](spark, medium).collect():
        slots.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    check_slots(slots, 1024)
    assert by_doc.keys() == texts.keys()
    for doc_id, rows in by_doc.items():
        ids = np.array([*plain.encode(texts[doc_id] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        rows.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in rows] == list(range(len(rows)))
        assert len(rows) == -(-len(ids) // 1024) and all(r["length"] == 1024 for r in rows[1:])
        at = 0
        for r in rows:
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    total = sum(r["length"] for rows in by_doc.values() for r in rows)
    assert len(slots) == plain_best_fit([r["length"] for rows in by_doc.values() for r in rows], 1024)
    assert len(slots) <= 1.01 * -(-total // 1024)


def test_packed_sequences_hold_the_ids(spark, odd):
    packed = best_fit.pack(odd, **FILES, capacity=64, with_ids=True)
    rows = packed.collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == Counter(i for i, _ in ROWS)
    assert {(r["start"], r["length"], tuple(r["ids"])) for r in rows if r["doc_id"] in (1, 2)} == {(0, 1, (2,))}
    plain = Tokenizer.from_file(FILES["tokenizer"])
    by_doc: dict = {}
    for r in sorted(rows, key=lambda r: (r["piece"], r["sequence_id"])):
        by_doc.setdefault(r["doc_id"], []).extend(r["ids"])
    for doc_id, text in ROWS:
        expected = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        assert len(by_doc[doc_id]) == len(expected) * sum(i == doc_id for i, _ in ROWS)
        if doc_id != 3:
            assert by_doc[doc_id] == expected
    assert 50256 in by_doc[6]
    whole = {r["sequence_id"]: r["ids"] for r in best_fit.sequences(packed).collect()}
    for r in rows:
        assert whole[r["sequence_id"]][r["offset"] : r["offset"] + r["length"]] == r["ids"]
    assert best_fit.pack(odd.where("doc_id = 99"), **FILES).collect() == []


def test_a_common_length_and_no_fast_library(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "IF(id % 3 = 0, 'one two three', repeat('word ', CAST(id % 50 AS INT))) AS text")
    found = [best_fit.pack(docs, capacity=16, **files).collect() for files in (FILES, {"tokenizer": FILES["tokenizer"]})]
    assert [len({r["sequence_id"] for r in rows}) for rows in found] == [plain_best_fit([r["length"] for r in rows], 16) for rows in found]
    assert {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in found[0]} == {(r["doc_id"], r["piece"], r["ids_crc32"]) for r in found[1]}


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def plain_fill(doc_id, text):
    """(form, prefix, middle, suffix, output)"""
    text = text or ""
    hexed = sha(f"1:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(hexed[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= 90:
        return "plain", None, None, None, text
    a, b = h1 % (len(text) + 1), h2 % (len(text) + 1)
    a, b = min(a, b), max(a, b)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return "spm", prefix, middle, suffix, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", prefix, middle, suffix, f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(alphabet="ab<>PSM é🙂", max_size=40), st.integers(1, 7))
def test_pieces_make_the_output_and_back(doc_id, text, chunk):
    cut = fill_middle.choose(doc_id, text)
    output = "".join(fill_middle.output_pieces(text, cut, chunk))
    form, prefix, middle, _, expected = plain_fill(doc_id, text)
    assert (cut.form, output) == (form, expected) and fill_middle.restore(output, form) == text
    if form != "plain":
        assert (cut.first, cut.second - cut.first) == (len(prefix), len(middle))


@pytest.mark.parametrize("chunk", [fill_middle.CHUNK, 1000])
def test_filled_rows(spark, odd, chunk):
    found = fill_middle.fill_middle(odd, chunk=chunk, with_text=True).collect()
    expected = []
    for doc_id, text in ROWS:
        form, prefix, middle, _, output = plain_fill(doc_id, text)
        sizes = (None, None) if form == "plain" else (len(prefix), len(middle))
        expected.append((doc_id, len(text or ""), form, *sizes, sha(output), output, sha(text or "")))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))
    assert {r["form"] for r in found} >= {"plain", "psm"}
    assert fill_middle.fill_middle(odd.where("doc_id = 99")).collect() == []


def test_second_sort_shuffles_nothing(spark, odd):
    calls = []
    rdd_type = type(odd.rdd.map(lambda r: r))
    before = rdd_type.partitionBy

    def counted(self, *args, **kwargs):
        out = before(self, *args, **kwargs)
        calls.append(out is self)
        return out

    rdd_type.partitionBy = counted
    try:
        fill_middle.fill_middle(odd)
    finally:
        rdd_type.partitionBy = before
    assert calls == [False, True]


def plain_nearest(vectors: list[list[int]], centroids: list[list[int]]) -> list[tuple[int, int]]:
    out = []
    for v in vectors:
        d = [sum((a - b) ** 2 for a, b in zip(v, c, strict=True)) for c in centroids]
        out.append((d.index(min(d)), min(d)))
    return out


def plain_clusters(rows, k=8, rounds=10, width=64):
    kept = [
        (i, [int(np.floor(1024 * float(x))) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)
    ]
    order = sorted(kept, key=lambda r: (sha(f"3:{'' if r[0] is None else r[0]}"), r[1]))
    centroids = [v for _, v in order[:k]]
    for _ in range(rounds):
        own = plain_nearest([v for _, v in kept], centroids)
        for c in range(len(centroids)):
            members = [v for (_, v), (n, _) in zip(kept, own, strict=True) if n == c]
            if members:
                centroids[c] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    own = plain_nearest([v for _, v in kept], centroids)
    total = {c: sum(d for n, d in own if n == c) for c in range(len(centroids))}
    return sorted(
        (str(i), n, d, total[n], sum(total.values()), sha(",".join(map(str, centroids[n])))) for (i, _), (n, d) in zip(kept, own, strict=True)
    )


VECTOR = st.lists(st.integers(-3, 3), min_size=3, max_size=3)


@settings(max_examples=300, deadline=None)
@given(st.lists(VECTOR, min_size=1, max_size=30), st.lists(VECTOR, min_size=1, max_size=30))
def test_tree_finds_the_first_nearest(centroids, vectors):
    tree = centroid_tree.VantageTree(np.array(centroids, dtype=np.int64))
    numbers, distances = tree.nearest(np.array(vectors, dtype=np.int64))
    assert list(zip(numbers.tolist(), distances.tolist(), strict=True)) == plain_nearest(vectors, centroids)


def test_tree_prunes_far_centroids():
    rng = np.random.default_rng(5)
    centres = rng.integers(-(2**20), 2**20, (64, 8))
    vectors = np.repeat(centres, 20, axis=0) + rng.integers(-50, 50, (1280, 8))
    tree = centroid_tree.VantageTree(centres)
    seen = []
    plain = centroid_tree.squared
    centroid_tree.squared = lambda v, c: seen.append(len(v)) or plain(v, c)
    try:
        numbers, _ = tree.nearest(vectors)
    finally:
        centroid_tree.squared = plain
    assert numbers.tolist() == [n for n, _ in plain_nearest(vectors.tolist(), centres.tolist())]
    assert sum(seen) < 0.5 * len(centres) * len(vectors)


def test_clusters_of_odd_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-4, 4, 4) / 1024).tolist()) for i in range(60)]
    rows += [(1, rows[1][1]), (1, rows[2][1]), (None, rows[3][1]), (70, None), (71, [0.1, None, 0.2, 0.3]), (72, [0.1, float("nan"), 0.2, 0.3])]
    rows += [(73, [float("inf")] * 4), (74, [0.1] * 3), (75, []), (76, [-0.0001] * 4)]
    schema = "cluster string, vec_id long, embedding array<double>, id int, v string, distance int, n int"
    frame = spark.createDataFrame([("x", i, v, 1, "y", 2, 3) for i, v in rows], schema).repartition(5)
    found = centroid_tree.with_totals(*centroid_tree.cluster(frame, width=4))
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    got = sorted((str(r[0]), *r[1:]) for r in map(tuple, found.select(columns).collect()))
    assert got == plain_clusters(rows, width=4)
    assert centroid_tree.with_totals(*centroid_tree.cluster(frame.where("vec_id = 70"), width=4)).collect() == []
    assert centroid_tree.cluster(frame.where("vec_id IN (2, 3)"), width=4)[0].count() == 2


def test_components_too_large_stop_the_query(spark):
    frame = spark.createDataFrame([(1, [1e30, 0.0]), (2, [0.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        centroid_tree.cluster(frame, width=2)
