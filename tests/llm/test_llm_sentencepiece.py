"""N-best encoding against the library's own search over the same pieces, and round trips."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm import sentencepiece_nbest
from freshet.llm.queries import TOKENIZER
from freshet.llm.sentencepiece_nbest import Encoder, decode, encode, read_pieces

MODEL = read_pieces(TOKENIZER)
TEXTS = ["Hello  world", "a\nb", " lead", "x ", "日本\U0001f600", "!!!!!!!!!!!", "The thing of ndble thanonti.", "a", "éè ñ", "▁ ▁", "  "]


def applied(ids: list[int], edits: list[dict]) -> list[int]:
    out = list(ids)
    for e in reversed(edits):
        out[e["at"] : e["at"] + e["n"]] = e["ids"]
    return out


def all_of(encoder: Encoder, text: str) -> list[tuple[float, list[int]]]:
    ids, _, totals, others = encoder.encode([text])
    best = ids.tolist()
    return [(float(totals[0]), best)] + [(o["score"], applied(best, o["edits"])) for o in others[0]]


def plain_n_best(seg: str, n: int) -> list[tuple[float, tuple]]:
    """Every node keeps its n best paths, over the pieces as they are."""
    scores = {MODEL["pieces"][i]: (MODEL["scores"][i], i) for i in MODEL["normal"]}
    lowest = min(MODEL["scores"][i] for i in MODEL["normal"]) - 10
    kept = [[(0.0, ())]]
    for end in range(1, len(seg) + 1):
        found = []
        for start in range(max(0, end - 20), end):
            got = scores.get(seg[start:end])
            if got:
                found += [(s + got[0], (*p, got[1])) for s, p in kept[start]]
        if seg[end - 1] not in scores:
            bytes_ = tuple(MODEL["bytes"][b] for b in seg[end - 1].encode())
            found += [(s + lowest, (*p, *bytes_)) for s, p in kept[end - 1]]
        kept.append(sorted(found, key=lambda x: -x[0])[:n])
    return kept[-1]


@pytest.mark.parametrize("text", TEXTS)
def test_n_best_is_exact(text):
    got = all_of(Encoder(MODEL, 5), text)
    expected = plain_n_best("▁" + text.replace(" ", "▁"), 5)
    assert [s for s, _ in got] == pytest.approx([s for s, _ in expected])
    cost = {i: MODEL["scores"][i] for i in MODEL["normal"]}
    for score, ids in got:
        if all(i in cost for i in ids):
            assert sum(cost[i] for i in ids) == pytest.approx(score)
    assert len({tuple(i) for _, i in got}) == len(got)


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("abethn.! \n%é😀"), min_size=1, max_size=14))
def test_any_text(text):
    encoder = Encoder(MODEL, 4)
    got = all_of(encoder, text)
    assert [s for s, _ in got] == pytest.approx([s for s, _ in plain_n_best("▁" + text.replace(" ", "▁"), 4)])
    assert all(encoder.decode(ids) == text for _, ids in got)


def test_frame_with_odd_rows(spark):
    long = "thing " * 30_000 + "x" * 3_000
    rows = [(1, None, 5), (2, "", 5), (3, long, 5), (None, "a b", 5), (4, "a b", 5), (4, "a b", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    found = encode(docs, TOKENIZER)
    out = found.collect()
    assert len(out) == len(rows)
    null = next(r for r in out if r["doc_id"] == 1)
    assert null["ids"] is None and null["n_pieces"] is None and null["decoded"] is None
    empty = next(r for r in out if r["doc_id"] == 2)
    assert empty["ids"] == [] and empty["score"] == 0 and empty["alternatives"] == []
    back = {(r["doc_id"], r["text"]) for r in decode(found, TOKENIZER).collect()}
    assert back == {(i, t) for i, t, _ in rows}
    assert encode(docs.where("doc_id = 99"), TOKENIZER).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("abethn.!\n%é😀日"), min_size=0, max_size=80), min_size=1, max_size=12))
def test_words_solved_together_equal_words_alone(words):
    encoder = Encoder(MODEL, 2)
    segs = ["▁" + w for w in words]
    sizes, flat, scores, behind = encoder.solve_many(segs)
    at = 0
    for seg, n, score, lost in zip(segs, sizes.tolist(), scores.tolist(), behind.tolist(), strict=True):
        assert (flat[at : at + n].tolist(), score, lost) == encoder.solve(seg)
        at += n
    assert at == len(flat)


def test_forgotten_words_change_nothing(monkeypatch):
    words = [f"{a}{b}{c}" for a in ("the", "x", "é\n") for b in ("ing", "", "tion,") for c in ("", "s", "y" * 90)]
    texts = [" ".join(words[i : i + 5]) for i in range(0, len(words), 3)] * 3
    plain = Encoder(MODEL, 3)
    expected = [plain.encode_checked([t]) for t in texts]
    monkeypatch.setattr(sentencepiece_nbest, "CACHED_WORDS", 6)
    small = Encoder(MODEL, 3)
    for text, (ids, _, totals, others, back) in zip(texts, expected, strict=True):
        got = small.encode_checked([text])
        assert (got[0].tolist(), got[2].tolist(), got[3]) == (ids.tolist(), totals.tolist(), others)
        assert got[4].tolist() == back.tolist() == [small.decode(ids.tolist()) == text]
    assert len(small.codes) < 20
