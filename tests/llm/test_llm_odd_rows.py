"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; incremental and large cases."""

from __future__ import annotations

import random
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from freshet.llm import decontaminate as dc  # noqa: E402
from freshet.llm import language_id, license_digest, maxscore, pii_anchors, quality_pu, secret_ledger, simhash, simhash_similar, tag_paths  # noqa: E402
from freshet.llm.common import least_hashed, resampled  # noqa: E402
from freshet.llm.components import components  # noqa: E402
from freshet.llm.license_texts import LICENSES  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, key long, spans string, id int, body int, block int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, None, None, "x", 1, "y", 2, 3, 4) for i, t, lang in rows], SCHEMA)


LONG = "long words here " * 40_000
ROWS = [
    (1, None, "en"),
    (2, "", None),
    (3, LONG, "en"),
    (3, LONG, "en"),
    (4, "write to a.b@c-d.example.org or 10.0.0.256, 10.0.0.255 now", "en"),
    (5, "une phrase en français avec été", "fr"),
    (6, "12345 !!!", None),
    (None, "no id here at all", "en"),
    (7, "the same short text", "en"),
    (8, "the same short text", "en"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ROWS).repartition(3).cache()


def test_personal_data_rows(spark, odd):
    out = pii_anchors.find_pii(odd).collect()
    assert len(out) == len(ROWS)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[1]["spans"] == "" and by_id[2]["base_sha256"] == brute.sha("")
    assert (by_id[4]["n_email"], by_id[4]["n_ip"]) == (1, 1)
    masked = pii_anchors.mask_pii(odd)
    assert masked.columns == odd.columns and masked.count() == len(ROWS)
    assert masked.where("doc_id = 4").first()["text"] == "write to <EMAIL> or 10.0.0.256, <IP> now"
    assert masked.where("doc_id = 1").first()["text"] is None
    assert pii_anchors.find_pii(odd.where("doc_id = 99")).count() == 0


ANCHORS = pii_anchors.automaton()


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["1", "12", "4111", "a", "x@y", "@", ".", "b.c", "+", "+4", " ", "-", "(", ")", "255", "256", "%", "é", "\n"]), max_size=30))
def test_anchors_find_what_patterns_find(parts):
    text = "".join(parts)
    found = [s for s in pii_anchors.spans(text, ANCHORS) if s[2] in pii_anchors.BASE_KINDS]
    assert pii_anchors.joined(found) == brute.joined(brute.pii(text))


def test_urls_and_accounts():
    text = "see https://me:pw@site.example.com/x?y=1. IBAN DE89 3704 0044 0532 0130 00, account no. 1234567 and account of 12"
    kinds = {(k, text[a:b]) for a, b, k in pii_anchors.spans(text, ANCHORS) if k in ("url", "account")}
    assert ("url", "https://me:pw@site.example.com/x?y=1") in kinds
    assert ("account", "DE89 3704 0044 0532 0130 00") in kinds and ("account", "1234567") in kinds
    assert len(kinds) == 3


@pytest.mark.parametrize(
    ("text", "masked"),
    [
        ("Account Number: 12345678.", "Account Number: <ACCOUNT>."),
        ("Account No. 12345678 and", "Account No. <ACCOUNT> and"),
        ("ACCOUNT NUMBER 12345678 IS CLOSED FROM NOW ON", "ACCOUNT NUMBER <ACCOUNT> IS CLOSED FROM NOW ON"),
        ("Tax ID 12-3456789", "Tax ID <ACCOUNT>"),
        ("Customer ID: 1234567, Member ID #7654321", "Customer ID: <ACCOUNT>, Member ID #<ACCOUNT>"),
        ("Social Security Number 123-45-6789", "Social Security Number <ACCOUNT>"),
        ("\u0130 aCCt 1234567", "\u0130 aCCt <ACCOUNT>"),
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "IBAN <ACCOUNT> BIC COBADEFFXXX"),
        ("iban: DE89370400440532013000 12 EUR", "iban: <ACCOUNT> 12 EUR"),
        ("IBAN NO93 8601 1117 947 PAID", "IBAN <ACCOUNT> PAID"),
        ("IBAN DE89 3704 0044 0532 0130 01 BIC", "IBAN DE89 3704 0044 0532 0130 01 BIC"),
        ("Passport AB123456 ISSUED ON 2020", "Passport <ACCOUNT> ISSUED ON 2020"),
        ("Account Numbers and Passport Notes", "Account Numbers and Passport Notes"),
    ],
)
def test_spellings_of_accounts(text, masked):
    found = [s for s in pii_anchors.spans(text, ANCHORS) if s[2] == "account"]
    assert pii_anchors.mask(text, found) == masked


def test_contamination_rows(spark, odd):
    items = spark.createDataFrame(
        [(1, "long words here long words here long words here long words"), (2, None), (3, "!!"), (None, "same short text"), (5, "no id here")],
        "item_id long, text string",
    )
    out = {r["doc_id"]: r for r in dc.contamination(odd, items).collect()}
    assert (out[1]["n_words"], out[1]["n_hit"]) == (0, 0)
    assert (out[3]["n_words"], out[3]["n_hit"]) == (120_000, 119_999)
    assert (out[7]["n_hit"], out[7]["n_items"]) == (3, 0)
    assert (out[None]["n_hit"], out[None]["items_sha256"]) == (3, brute.sha("5"))
    one = sorted(map(tuple, dc.contamination(odd, items).collect()), key=str)
    many = sorted(map(tuple, dc.contamination(odd, items, block_words=3).collect()), key=str)
    assert one == many
    assert dc.contamination(odd, items.where("item_id = 99")).where("contaminated").count() == 0
    cleaned = dc.remove_contaminated(odd, items)
    assert cleaned.columns == odd.columns
    kept = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert 3 not in kept and 7 not in kept and kept[1] is None and kept[5] == ROWS[5][1]


def test_items_cut_into_pieces_give_the_same(spark):
    rng = random.Random(5)
    items = [(i, " ".join(rng.choices("abc", k=rng.choice([0, 1, 2, 3, 7, 60])))) for i in range(40)]
    docs = [(i, " ".join(rng.choices("abcd", k=rng.choice([0, 2, 30])))) for i in range(60)]
    tables = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    # pieces of 8 words, blocks of 20
    for r in dc.contamination(*tables, window=4, block_words=20).collect():
        n, hit, ids = brute.contamination(docs[r["doc_id"]][1], items, 4)
        assert (r["n_words"], r["n_hit"], r["items_sha256"]) == (n, len(hit), brute.sha(",".join(ids)))


def test_very_many_equal_short_items(spark):
    same = spark.range(100_000).selectExpr("id AS item_id", "'word' AS text")
    docs = spark.createDataFrame([(1, "word " * 20_000), (2, "other"), (3, "a word")], "doc_id long, text string")
    out = {r["doc_id"]: r for r in dc.find_benchmark(docs, same).collect()}
    assert [out[i]["n_hit"] for i in (1, 2, 3)] == [20_000, 0, 1]
    assert [len(out[i]["items"]) for i in (1, 2, 3)] == [100_000, 0, 100_000]


def test_one_item_of_a_million_words(spark):
    numbers = F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(999_999)), lambda x: F.concat(F.lit("w"), x.cast("string"))))
    item = spark.range(1).select(F.lit("long").alias("item_id"), numbers.alias("text"))
    spots = [0, 49_985, 49_995, 199_995, 500_000, 999_990]
    rows = [(at, " ".join(["x", *(f"w{i}" for i in range(at, at + 10)), "x"])) for at in spots]
    rows.append((-1, " ".join(f"w{i}" for i in (*range(9), 10))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r["doc_id"]: r for r in dc.find_benchmark(docs, item).collect()}
    assert [out[at]["n_hit"] for at in (*spots, -1)] == [10] * len(spots) + [0]
    assert [out[at]["items"] for at in spots] == [["long"]] * len(spots)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.lists(st.sampled_from("abc"), max_size=9), max_size=5),
    st.lists(st.sampled_from("abcd"), max_size=40),
    st.integers(1, 5),
)
def test_automaton_is_exact(items, words, window):
    named = [(str(i), [w.encode() for w in x]) for i, x in enumerate(items)]
    ranges, names = dc.ItemAutomaton(named, window).search([w.encode() for w in words])
    _, hit, ids = brute.contamination(" ".join(words), [(i, " ".join(x)) for i, x in enumerate(items)], window)
    assert {i for a, b in ranges for i in range(a, b)} == hit
    assert sorted(names) == ids


def test_pages_rows(spark):
    page = """<html><head><title>t</title></head><body><header><a href=/>Home</a></header>
    <div class="cookie-notice">We use cookies.</div><div class=sidebar><p>Other things, more.</p></div>
    <main><h2>A title</h2><p>First &lt;part&gt;,&nbsp; of   the text; it is long enough.<p>Second <b>part</b> of it, and more words.</p>
    <form><input value=x>Sign up</form><ul><li>One item, here.<li>Two items, there.</ul></main>
    <section id="comments"><p>A comment, by someone, which is rather long and has marks.</p></section><footer>end</footer><script>x="</p>"</script>"""
    rows = [(1, "u", page), (2, "u", None), (3, None, ""), (None, "u", "<p>plain"), (5, "u", "no markup at all"), (6, "u", "<nav>x</nav>"), (7, "u", "<p>" * 3000 + "deep")]
    out = {r["page_id"]: r for r in tag_paths.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert out[1]["text"].split("\n\n") == [
        "A title",
        "First <part>, of the text; it is long enough.",
        "Second part of it, and more words.",
        "One item, here.",
        "Two items, there.",
    ]
    assert [out[i]["text"] for i in (2, 3, None, 5, 6, 7)] == ["", "", "plain", "no markup at all", "", "deep"]


LINE = "A sentence of the article, with marks; it goes on for a while and then it ends. "


@pytest.mark.parametrize(
    ("start", "end"),
    [
        ("<article>", "</article>"),
        ("<main class=wide>", "</main>"),
        ("<div class=post>", "</div>"),
    ],
)
def test_titles_and_sections_in_nested_containers(start, end):
    first = "".join(f"<p>{LINE * 5}</p>" for _ in range(10))
    body = f"<h1>The title of it</h1><div class=body>{first}</div><div class=more><h2>Sub</h2><p>{LINE * 4}</p><p>Short one.</p><ul><li>Item</ul></div>"
    got = tag_paths.main_text(f"<html><body><div class=top>Sign in</div>{start}{body}{end}<div class=end>Terms</div></body></html>")
    assert got.split("\n\n") == ["The title of it", *[(LINE * 5).strip()] * 10, "Sub", (LINE * 4).strip(), "Short one.", "Item"]


@pytest.mark.parametrize(
    "wrap",
    [
        "<div class='content no-sidebar'>%s</div>",
        "<div class='site has-sidebar'>%s</div>",
        "<div class='post comments-open'>%s</div>",
        "<form>%s</form>",
        "<div class=widget><main>%s</main></div>",
        "<article>%s</article>",
    ],
)
def test_links_and_wrappers_of_articles_stay(wrap):
    head = "<div class=article-header><h1><a href=/x>The linked title</a></h1></div>"
    text = "".join(f"<p>{LINE * 4}</p>" for _ in range(5))
    page = "<nav><a href=/>Home</a></nav>" + wrap % (head + text + "<p><a href=/r>Full report</a></p><div class=share>Share it</div>") + "<footer>End</footer>"
    assert tag_paths.main_text(f"<html><body>{page}</body></html>").split("\n\n") == ["The linked title", *[(LINE * 4).strip()] * 5, "Full report"]


@pytest.mark.parametrize(
    "inner",
    [
        "<h2 id=related-work>Kept</h2>",
        "<h2 id='comments-on-the-law'>Kept</h2>",
        "<h3 class=banner>Kept</h3>",
        "<section id=social-impact><p>Kept</p></section>",
        "<div class=social-security>Kept</div>",
        "<p class=notice>Kept</p>",
        "<p><code class=header>Kept</code></p>",
        "<p><span class=menu>Kept</span></p>",
        "<p><math><mi>Kept</mi></math></p>",
        "<div title='Hidden gems of Rome'>Kept</div>",
        "<div aria-label='The hidden cost'>Kept</div>",
        "<div data-hidden=false>Kept</div>",
        "<div data-class=ad>Kept</div>",
        "<div data-role=banner>Kept</div>",
        "<div data-grid='sidebar' aria-hidden=false>Kept</div>",
        "<div data-x='a class=ad'>Kept</div>",
    ],
)
def test_article_text_is_not_furniture_by_a_word(inner):
    text = "".join(f"<p>{LINE * 4}</p>" for _ in range(4))
    page = f"<html><body><nav>Home</nav><article>{text}{inner}{text}</article><footer>End</footer></body></html>"
    line = (LINE * 4).strip()
    assert tag_paths.main_text(page).split("\n\n") == [line] * 4 + ["Kept"] + [line] * 4


@pytest.mark.parametrize(
    "inner",
    [
        "<div class=ad>Gone</div>",
        "<div class=cookie-banner>Gone</div>",
        "<div id=relatedPosts>Gone</div>",
        "<section class='comments-list'>Gone</section>",
        "<div hidden>Gone</div>",
        "<p><span hidden>Gone</span></p>",
        "<div aria-hidden='true'>Gone</div>",
        "<div role=banner>Gone</div>",
        "<div style='display: none'>Gone</div>",
        "<div data-x=1 class='x share-buttons'>Gone</div>",
        "<aside>Gone</aside>",
    ],
)
def test_furniture_inside_an_article_goes(inner):
    text = "".join(f"<p>{LINE * 4}</p>" for _ in range(4))
    assert tag_paths.main_text(f"<article>{text}{inner}</article>").split("\n\n") == [(LINE * 4).strip()] * 4


def test_deep_pages_take_time_in_proportion():
    import time

    pages = ["<div>a", "<font><center>a", "<nav>a", "<span hidden>x", "<ul><li>a", "<p>a", "<div class=ad>a", "<table><tr><td>a", "<header>a"]
    began = time.process_time()
    for start in pages:
        tag_paths.main_text(start * 50_000 + "<article><p>Here it is, at last.</p></article>")
    assert time.process_time() - began < 5 * len(pages)


def test_near_duplicate_rows(spark, odd):
    out = [r.asDict() for r in simhash.near_duplicates(odd).collect()]
    assert len(out) == len(ROWS)
    by_id = {r["doc_id"]: r for r in out}
    assert by_id[1]["fingerprint"] == by_id[2]["fingerprint"] == "0" * 16
    assert by_id[2]["component_id"] == 1 and by_id[8]["component_id"] == 7
    kept = simhash.one_of_each(odd, simhash.near_duplicates(odd))
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in kept.collect()) == [(False, i) for i in (1, 3, 4, 5, 6, 7)] + [(True, 0)]
    assert simhash.near_duplicates(odd.where("doc_id = 99")).count() == 0


def test_large_groups_are_linked_exactly(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SMALL", 3)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = {int(c) for c in centres}
    for c in centres[:4]:
        for _ in range(60):
            x = int(c)
            for b in rng.choice(64, rng.integers(1, 8), replace=False):
                x ^= 1 << int(b)
            values.add(x)
    values = sorted(values)
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    nodes = spark.createDataFrame([(v,) for v in signed], "fp long")
    found = {r["node"]: r["root"] for r in components(simhash.links(nodes)).collect()}
    expected = brute.components(signed, values)
    assert [found.get(v, v) for v in signed] == expected


def test_similar_documents(spark, odd, monkeypatch):
    """Against all pairs: texts at 0.8 or more of a centre, and some below."""
    rng = np.random.default_rng(5)
    vocabulary = np.array([f"w{i}" for i in range(3000)])
    docs = []
    for _ in range(25):
        centre = rng.choice(vocabulary, 200)
        for changed in (0, 0, 1, 2, 3, 4, 12):
            copy = centre.copy()
            copy[rng.choice(200, changed, replace=False)] = rng.choice(vocabulary, changed)
            docs.append((len(docs), " ".join(copy)))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for _, t in docs)]
    pairs = [(i, j) for i in range(len(docs)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    joined = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    expected = {i: joined.get(i, i) for i, _ in docs}
    given = spark.createDataFrame(docs, "doc_id long, text string")
    for small, block, common in ((128, 512, 1 << 20), (2, 3, 1 << 20), (2, 3, 0), (128, 512, 50)):
        monkeypatch.setattr(simhash_similar, "SMALL", small)
        monkeypatch.setattr(simhash_similar, "BLOCK", block)
        monkeypatch.setattr(simhash_similar, "MOST_COMMON", common)
        assert {r["doc_id"]: r["component_id"] for r in simhash_similar.similar_documents(given).collect()} == expected
    named = given.selectExpr("concat('d', doc_id) AS doc_id", "text")
    by_name = {r["doc_id"]: r["component_id"] for r in simhash_similar.similar_documents(named).collect()}
    classes = {}
    for i, root in expected.items():
        classes.setdefault(root, []).append(f"d{i}")
    assert by_name == {m: min(members) for members in classes.values() for m in members}
    out = {r["doc_id"]: r["component_id"] for r in simhash_similar.similar_documents(odd).collect()}
    assert out == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6, 7: 7, 8: 7}
    assert simhash_similar.similar_documents(odd.where("doc_id = 99")).count() == 0
    text = "one id may have several texts and each of them has links of its own"
    rows = [(1, text), (1, text + " indeed"), (-5, " ".join(reversed(text.split()))), (1, " ".join(reversed(text.split()))), (9, text.upper())]
    several = spark.createDataFrame(rows, "doc_id int, text string")
    found = simhash_similar.similar_documents(several)
    assert found.dtypes == [("doc_id", "int"), ("component_id", "int")]
    assert sorted(map(tuple, found.collect())) == [(-5, -5), (1, -5), (1, 1), (1, 1), (9, 1)]


def test_similar_documents_keep_the_links_of_fingerprints(spark):
    """Close fingerprints link whatever the sets of shingles are, in classes no finer than those of SimHash alone."""
    rng = np.random.default_rng(11)
    line = [f"line{i}" for i in range(12)]
    docs = []
    for group in range(6):
        repeated = [f"{w}of{group}" for w in line] * 60
        docs += [(10 * group + k, " ".join(repeated + [f"own{w}" for w in rng.integers(0, 10**9, 8)])) for k in range(4)]
    docs += [(100 + k, " ".join(f"other{w}" for w in rng.integers(0, 10**9, 60))) for k in range(5)]
    given = spark.createDataFrame(docs, "doc_id long, text string")
    by_bits = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(given).collect()}
    assert len(set(by_bits.values())) < len(docs)
    found = {r["doc_id"]: r["component_id"] for r in simhash_similar.similar_documents(given).collect()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in docs)}
    ids = sorted(sets)
    assert not any(len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) for i in ids for j in ids if i < j)
    assert found == by_bits


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=60), st.integers(1, 8))
def test_postings_give_all_pairs(rows, small):
    rows = sorted(set(rows)) + rows[:3]
    sizes = [10 + name for _, name in rows]
    keys, names = (np.array([r[c] for r in rows], dtype=np.uint64) for c in (0, 1))
    (a, b, star), (long_keys, long_names) = simhash_similar.pairs_of_bucket(keys, names, np.array(sizes, dtype=np.uint64), 0.8, small)
    members = {k: sorted({n for key, n in rows if key == k}) for k, _ in rows}
    short = [m for m in members.values() if len(m) <= small]
    expected = {(x, y) for m in short for x in m for y in m if x < y and (y - x) <= (20 + x + y) * 0.2 / 1.8 + 1e-6}
    assert len(a) == len(expected) and set(zip(a.tolist(), b.tolist(), strict=True)) == expected
    assert {(x, y) for x, y, s in zip(a.tolist(), b.tolist(), star.tolist(), strict=True) if s} == {(x, y) for x, y in expected if any(x == m[0] and y in m for m in short)}
    assert sorted(zip(long_keys.tolist(), long_names.tolist(), strict=True)) == sorted((k, n) for k, m in members.items() if len(m) > small for n in m)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**simhash_similar.KEY_BITS - 1), max_size=50), st.integers(1, 9))
def test_columns_survive_packing(keys, buckets):
    keys = np.sort(np.array(keys, dtype=np.uint64))
    other = np.arange(len(keys), dtype=np.uint64) * np.uint64(2**60 + 7)
    parts = [simhash_similar.unpacked(body, 2) for _, body in simhash_similar.dealt(keys, buckets, other)]
    back = np.concatenate([np.zeros((2, 0), dtype=np.uint64), *parts], axis=1)
    assert back.tolist() == [keys.tolist(), other.tolist()]
    assert all(b == int(k) * buckets >> simhash_similar.KEY_BITS for b, body in simhash_similar.dealt(keys, buckets, other) for k in simhash_similar.unpacked(body, 2)[0])


def block_copies(rng, groups, size, words=200):
    """Texts of groups: copies of one text, each with its own block of words changed; similar to the text, not all to each other."""
    vocabulary = np.array([f"w{i}" for i in range(3000)])
    docs = []
    for _ in range(groups):
        centre = rng.choice(vocabulary, words)
        docs.append(" ".join(centre))
        for _ in range(size - 1):
            copy, n = centre.copy(), int(rng.integers(words // 14, words // 11))
            at = int(rng.integers(0, words - n))
            copy[at : at + n] = rng.choice(vocabulary, n)
            docs.append(" ".join(copy))
    return docs


def similar_pairs(docs):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, docs)]
    return [(i, j) for i in range(len(docs)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]


def test_changed_blocks_are_linked_like_all_pairs(spark, monkeypatch):
    """Pairs with one changed block and groups of 30, in short and in long postings, cut into blocks too."""
    rng = np.random.default_rng(8)
    docs = [*block_copies(rng, 150, 2), *block_copies(rng, 4, 30)]
    pairs = similar_pairs(docs)
    expected = [(i, i) for i in range(len(docs))]
    links = spark.createDataFrame(pairs, "a long, b long")
    expected = dict(expected) | {r["node"]: r["root"] for r in components(links).collect()}
    assert len(pairs) > 200
    given = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    for small, block in ((128, 512), (1, 512), (1, 7)):
        monkeypatch.setattr(simhash_similar, "SMALL", small)
        monkeypatch.setattr(simhash_similar, "BLOCK", block)
        assert {r["doc_id"]: r["component_id"] for r in simhash_similar.similar_documents(given).collect()} == expected


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sets(st.integers(0, 12), min_size=1, max_size=8), min_size=1, max_size=12), st.integers(1, 12), st.sampled_from([0.3, 0.5, 0.8]))
def test_dense_forest_joins_all_pairs(sets, parts, similarity):
    n = len(sets)
    given = [i % parts for i in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i) if given[i] == given[j]]
    near = [(i, j) for i in range(n) for j in range(i) if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j])]
    found = simhash_similar.dense_forest([np.array(sorted(s), dtype=np.int64) for s in sets], np.array(given), similarity)
    assert {(max(f), min(f)) for f in found} <= set(near)

    def joined(edges):
        root = list(range(n))
        for a, b in edges:
            old, new = root[a], root[b]
            root = [new if r == old else r for r in root]
        return [[r == q for q in root] for r in root]

    assert joined(pairs + found) == joined(pairs + near)


def test_covering_triples():
    assert len(simhash.covering_triples()) == 20


def test_quality_rows(spark, odd):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 0), (7, 1, 0), (3, None, 0), (6, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality_pu.fit(odd, labels)
    out = quality_pu.score(odd, model).collect()
    assert len(out) == len(ROWS) and all(0 <= r["score"] <= 1 for r in out)
    same = {r["doc_id"]: r["score"] for r in out}
    assert same[1] == same[2] and same[7] == same[8]
    assert quality_pu.keep_good(odd, model, 0.0).count() == len(ROWS)
    none = quality_pu.fit(odd, labels.where("quality = 9"))
    assert [r["score"] for r in quality_pu.score(odd, none).collect()] == pytest.approx([none.prior] * len(ROWS))
    assert quality_pu.score(odd.where("doc_id = 99"), model).count() == 0
    assert quality_pu.keep_good(odd, model, 0.3).columns == odd.columns


def test_quality_prior_is_estimated():
    rng = np.random.default_rng(2)
    good, bad = rng.normal(0, 1, (6000, 5)), rng.normal(3, 1, (6000, 5))
    for share in (0.3, 0.6, 0.9):
        mixed = np.where((rng.random(6000) < share)[:, None], good, bad)
        assert quality_pu.estimated_prior(rng.normal(0, 1, (3000, 5)), mixed) == pytest.approx(share, abs=0.08)


def test_samples_are_bounded_and_never_empty(spark):
    rows = spark.range(40_000).selectExpr("CAST(NULL AS LONG) AS doc_id", "IF(id < 20000, 'the same', concat('text ', id)) AS text", "IF(id = 7, 'rare', 'en') AS lang")
    taken = least_hashed(rows, ["doc_id", "text"], 500)
    assert taken.columns == ["doc_id", "text", "lang", "weight"]
    assert taken.count() == 500 == taken.select("text").distinct().count()
    same = rows.where("text = 'the same'")
    assert [r["weight"] for r in least_hashed(same, ["doc_id", "text"], 500).collect()] == [20_000]
    by_kind = least_hashed(rows.withColumn("text", F.concat("text", "lang")), ["doc_id", "text"], 300, kind="lang").groupBy("lang").count()
    assert dict(by_kind.collect()) == {"en": 300, "rare": 1}
    some = spark.createDataFrame([(3,), (4,)], "doc_id long")
    known = rows.withColumn("doc_id", F.lit(3).cast("long"))
    assert least_hashed(known, ["doc_id", "text"], 10, among=some).count() == 10
    assert least_hashed(rows, ["doc_id", "text"], 10, among=some).count() == 0
    assert resampled(np.array([1, 4, 1]), 100).tolist() == [0, 1, 1, 1, 1, 2]
    assert resampled(np.array([10**12, 10**12]), 4).tolist() == [0, 0, 1, 1] and len(resampled(np.array([], dtype=int), 4)) == 0
    assert language_id.fit(same).languages == ["en", "rare"]
    model = quality_pu.fit(rows, spark.createDataFrame([(None, 1), (3, 0)], "doc_id long, quality int"))
    assert not model.weights and model.labelled_share == 0.5
    assert quality_pu.fit(known, spark.createDataFrame([(3, 1)], "doc_id long, quality int")).weights


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="abcéßñ中🙂я", min_size=1, max_size=9), min_size=1, max_size=20))
def test_words_are_summed_as_their_subwords_are(words):
    table = np.random.default_rng(1).normal(size=(language_id.BUCKETS, 3))
    found = language_id.bucket_sums(words, table)
    for word, row in zip(words, found, strict=True):
        at = language_id.buckets(word)
        assert row[-1] == len(at) and np.allclose(row[:-1], table[at].sum(axis=0), atol=1e-9)


def test_forgotten_words_change_no_score(monkeypatch):
    rng = np.random.default_rng(4)
    table = rng.normal(size=(language_id.BUCKETS, 3))
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}é" for i in range(6000)]
    texts = [" ".join(rng.choice(words, int(n))) for n in rng.integers(0, 900, 40)] + [None, "", "123", " ".join(words)]
    monkeypatch.setattr(language_id, "CACHED_WORDS", 1)
    model = language_id.Model(["a", "b", "c"], table)
    for _ in range(2):
        got = model.logits(texts)
        for text, row in zip(texts, got, strict=True):
            at = [b for w in language_id.letter_words(text) for b in language_id.buckets(w)]
            assert np.isnan(row).all() if not at else np.allclose(row, table[at].mean(axis=0))
    assert len(model._codes) <= 1250


def test_secret_rows_and_ledger(spark, odd):
    texts = [
        (1, "token: token:abcdefgh AKIA" + "A" * 12 + " " + "ab" * 20),
        (2, "é\U0001f600 PassWord = 'x1234567' secret=short"),
        (3, None),
        (4, " ".join(f"api_key={i:08d}" for i in range(1300))),
        (5, "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1" * 18),
    ]
    docs = spark.createDataFrame(texts + texts[:2], "doc_id long, text string")
    out = secret_ledger.secrets(docs).collect()
    assert len(out) == 7
    for r in out:
        base = brute.secrets(dict(texts)[r["doc_id"]])
        assert r["base_sha256"] == brute.sha(brute.joined(base))
    assert "private_key:0:31" in next(r["spans"] for r in out if r["doc_id"] == 5)
    assert secret_ledger.secrets(odd).count() == len(ROWS)
    assert secret_ledger.secrets(odd.where("doc_id = 99")).count() == 0

    rules = secret_ledger.RULES
    ledger = secret_ledger.scan(docs.where("doc_id < 3")).cache()
    assert ledger.count() == 2 * len(rules)
    later = secret_ledger.scan(docs, ledger)
    assert later.count() == 3 * len(rules)
    renewed = tuple(secret_ledger.Rule(r.kind, 2, r.pattern, r.group, r.least) if r.kind == "hex" else r for r in rules)
    again = secret_ledger.scan(docs, ledger.unionByName(later), renewed)
    assert {(r["rule"], r["rule_version"]) for r in again.collect()} == {("hex", 2)} and again.count() == 5
    with_ledger = secret_ledger.secrets(docs, ledger).collect()
    assert sorted(map(tuple, with_ledger)) == sorted(map(tuple, out))


def test_vector_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(np.float32(np.sin(i * j))) for j in range(1, 9)]) for i in range(120)]
    rows += [(50, None), (100, [1.0, None]), (150, [nan] * 8), (151, [inf] * 8), (200, []), (250, [0.25] * 8), (251, [0.25] * 8), (252, [0.25] * 8)]
    vectors = spark.createDataFrame(rows + [(None, [1.0] * 8)], "vec_id long, embedding array<float>")
    out = maxscore.top_k(vectors, F.col("vec_id") % 50 == 0).collect()
    kept = [(i, v) for i, v in rows if (i, v) not in (rows[120], rows[121])]
    padded = [(i, v if v is None else [*v, *[0.0] * (8 - len(v))]) for i, v in kept]
    assert sorted(map(tuple, out)) == brute.top_k(padded)
    assert maxscore.top_k(vectors.where("vec_id = 99999"), F.col("vec_id") % 50 == 0).count() == 0
    few = maxscore.top_k(vectors.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 50 == 0)
    assert few.count() == 2


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.integers(1, 6), st.integers(0, 10_000))
def test_search_is_exact(n, k, seed):
    rng = np.random.default_rng(seed)
    vs = rng.integers(-4, 5, (n, 12)).astype(float)
    qs = rng.integers(-4, 5, (3, 12)).astype(float)
    ids, query_ids = np.arange(n), np.array([0, n, n + 1])
    best = maxscore.search(query_ids, qs, ids, vs, k, chunk=7)
    for q, own, found in zip(qs, query_ids, best.found, strict=True):
        expected = sorted((-int(q @ v), int(i)) for i, v in zip(ids, vs, strict=True) if i != own)[:k]
        assert [(int(s), int(i)) for s, i in found] == expected


def test_language_rows(spark, odd):
    model = language_id.fit(odd)
    out = {r["doc_id"]: r for r in language_id.identify(odd, model).collect()}
    assert out[1]["lang_pred"] == out[2]["lang_pred"] == out[6]["lang_pred"] == "und" and out[6]["score"] == 0
    assert out[5]["lang_pred"] in ("en", "fr")
    untrained = language_id.identify(odd, language_id.fit(odd.where("doc_id = 99"))).collect()
    assert {r["lang_pred"] for r in untrained} == {"und"}
    assert language_id.identify(odd.where("doc_id = 99"), model).count() == 0


def test_license_rows(spark, odd):
    mit = LICENSES["MIT"]
    other = "# Copyright (c) 2020 Somebody\n" + mit.replace("\n", " \r\n  * ").upper().replace("SUBLICENSE", "sublicence").replace('"', "''")
    rows = [(1, mit), (2, other), (3, mit + " extra"), (4, None), (5, ""), (6, "x\nreleased under the mit licence\ny"), (6, "x\nreleased under the mit licence\ny")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = license_digest.scan_licenses(docs).collect()
    assert len(out) == len(rows)
    by_id = {r["doc_id"]: r for r in out}
    assert [by_id[i]["license_id"] for i in (1, 2, 3, 4, 5)] == ["MIT", "MIT", None, None, None]
    assert by_id[6]["notices"] == "MIT" and by_id[4]["digest"] == by_id[5]["digest"] == brute.sha("")
    assert license_digest.scan_licenses(odd).count() == len(ROWS)
    assert license_digest.scan_licenses(odd.where("doc_id = 99")).count() == 0


def test_licenses_at_any_width(spark):
    import textwrap

    rows, expected = [], {}
    for name, text in LICENSES.items():
        title, _, body = text.partition("\n\n")
        for width in (0, 30, 40, 55, 68, 72, 80, 100, 10_000):
            parts = body.split("\n\n")
            wrapped = "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False) if width else p for p in parts)
            for head in (f"{title}\n\nCopyright (c) 2020, A Name\n\n", "Copyright 2019-2021 The Authors\nAll rights reserved.\n\n", "Copyright Some Name <a@b.c>\n\n", "The MIT License (MIT)\n\n© Me\n\n" if name == "MIT" else ""):
                expected[len(rows)] = name
                rows.append((len(rows), head + wrapped))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: r["license_id"] for r in license_digest.scan_licenses(docs).collect()} == expected


def test_second_scan_takes_only_new_blobs(spark):
    """As the query does it: a ledger of the rows with even ids, then all rows."""
    docs = spark.createDataFrame([(i, f"token={'x' * (8 + i // 3)} {i // 3}") for i in range(24)] + [(None, "secret: 12345678"), (24, None)], "doc_id long, text string")
    first = secret_ledger.scan(docs.where("doc_id % 2 = 0")).cache()
    rules = len(secret_ledger.RULES)
    assert first.count() == rules * docs.where("doc_id % 2 = 0").select("text").distinct().count()
    second = secret_ledger.scan(docs, first)
    seen = {r["blob"] for r in first.collect()}
    new = {r["blob"] for r in second.collect()}
    assert len(new) * rules == second.count() and not new & seen
    assert len(new) + len(seen) == docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    whole = sorted(str(tuple(r)) for r in secret_ledger.secrets(docs).collect())
    assert sorted(str(tuple(r)) for r in secret_ledger.secrets(docs, first).collect()) == whole
    assert secret_ledger.scan(docs, first.unionByName(second)).count() == 0


def test_shipped_licenses_are_found(spark):
    """As they stand, in comments, in capitals, with other line ends and addresses, and wrapped anew where no copyright is stated."""
    import re
    import textwrap

    files = sorted(license_digest.FOLDER.glob("*.txt"))
    assert {f.stem for f in files} >= {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0", "BSD-3-Clause"}
    rows, expected = [], {}

    def add(name, text):
        expected[len(rows)] = name
        rows.append((len(rows), text))

    for f in files:
        text = f.read_text(encoding="utf-8")
        add(f.stem, text)
        add(f.stem, text.replace("\n", "\r\n"))
        add(f.stem, "".join(f" * {line}\n" for line in text.split("\n")))
        add(f.stem, text.replace("licence", "license").replace("51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA\n Everyone", "59 Temple Place, Suite 330, Boston, MA  02111-1307  USA\n Everyone"))
        add(None, text.replace("License", "Lizenz").replace("Redistribution", "x").replace("LICENSE", "x"))
        for width in (40, 60, 77, 100, 10_000):
            stated = re.compile(r"copyright\W*[(\[]|(?:all )?rights reserved|portions created", re.I)
            parts = [p if stated.search(p) and "Everyone is permitted" not in p else textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in text.split("\n\n")]
            add(f.stem, "\n\n".join(parts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert {r["doc_id"]: r["license_id"] for r in license_digest.scan_licenses(docs).collect()} == expected


def test_licenses_of_rows_that_share_an_id(spark):
    """One id and canonical text, other line ends: each row has its own notices."""
    line = "Released under the MIT License."
    rows = [(1, f"a\n{line}"), (1, f"a {line}"), (1, f"a\n{line}"), (None, line), (None, f"x {line}")]
    found = license_digest.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str((r["doc_id"], r["notices"], r["n_notices"])) for r in found) == sorted(
        str(x) for x in [(1, "MIT", 1), (1, "", 0), (1, "MIT", 1), (None, "MIT", 1), (None, "", 0)]
    )


def test_pipeline_stages_take_odd_rows(spark, odd, small):
    import corpus_pipeline

    docs = odd
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, small)
        if name != "sentencepiece":
            assert out.columns == odd.columns
            docs = out
        out.count()
        assert stage(spark, odd.where("doc_id = 99"), small).count() == 0
