"""The queries against plain versions, on the small tables."""

from __future__ import annotations

import sys
import zlib
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

import brute  # noqa: E402

from freshet.llm.queries import QUERIES  # noqa: E402


def rows_of(path: str) -> list[tuple]:
    return duckdb.sql(f"SELECT * FROM read_parquet('{path}')").fetchall()


@pytest.fixture(scope="module")
def docs(medium):
    return {r[0]: r[1] for r in rows_of(f"{medium}/documents.parquet")}


def collect(spark, folder, name):
    return [r.asDict(True) for r in QUERIES[name](spark, folder).collect()]


def test_personal_data(spark, medium, docs):
    found = collect(spark, medium, "op2_pii_anchors")
    assert len(found) == len(docs)
    for r in found:
        base = brute.pii(docs[r["doc_id"]])
        assert r["base_sha256"] == brute.sha(brute.joined(base))
        assert [r[f"n_{k}"] for k in ("email", "ip", "card", "phone")] == [
            sum(b[0] == k for b in base) for k in ("email", "ip", "card", "phone")
        ]
        assert {*brute.joined(base).split(",")} - {""} <= {*r["spans"].split(",")}
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in found) > 20


def test_secrets(spark, medium, docs):
    found = collect(spark, medium, "op7_secret_ledger")
    assert len(found) == len(docs)
    for r in found:
        base = brute.secrets(docs[r["doc_id"]])
        assert r["base_sha256"] == brute.sha(brute.joined(base))
        assert [r[f"n_{k}"] for k in ("assign", "access", "hex")] == [sum(b[0] == k for b in base) for k in ("assign", "access", "hex")]
    assert sum(r["n_assign"] + r["n_access"] + r["n_hex"] for r in found) > 20


def test_contamination(spark, small):
    items = rows_of(f"{small}/benchmark.parquet")
    texts = {r[0]: r[1] for r in rows_of(f"{small}/documents.parquet")}
    found = collect(spark, small, "op3_decontaminate")
    assert len(found) == len(texts)
    for r in found:
        n, hit, ids = brute.contamination(texts[r["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["n_items"]) == (n, len(hit), len(ids))
        assert r["items_sha256"] == brute.sha(",".join(ids))
        assert r["contaminated"] == bool(hit)
    assert any(r["contaminated"] for r in found)


def test_fingerprints_and_components(spark, medium, docs):
    found = {r["doc_id"]: r for r in collect(spark, medium, "op5_simhash")}
    ids = sorted(docs)
    prints = [brute.fingerprint(docs[i]) for i in ids]
    assert [found[i]["fingerprint"] for i in ids] == [f"{p:016x}" for p in prints]
    assert [found[i]["component_id"] for i in ids] == brute.components(ids, prints)


def test_best_vectors(spark, medium):
    rows = [(r[0], r[1]) for r in rows_of(f"{medium}/embeddings.parquet")]
    found = collect(spark, medium, "op8_maxscore")
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found) == brute.top_k(rows)


def test_quality_of_held_out_rows(spark, small, medium):
    for folder, least in ((small, 0.8), (medium, 0.9)):
        truth = {r[0]: r[1] for r in rows_of(f"{folder}/labels.parquet")}
        found = collect(spark, folder, "op6_quality_pu")
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in found)
        held = [r for r in found if r["held_out"] and r["doc_id"] in truth]
        right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
        assert right >= least * len(held)
        assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in found)


def test_language_of_held_out_rows(spark, medium):
    truth = {r[0]: r[2] for r in rows_of(f"{medium}/documents.parquet")}
    found = collect(spark, medium, "op9_language_id")
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in found)
    held = [r for r in found if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)


def test_pages(spark, small):
    pages = {r[0]: r[2] for r in rows_of(f"{small}/pages.parquet")}
    for r in collect(spark, small, "op4_tag_path_ratios"):
        assert r["n_chars"] == len(r["text"])
        body = pages[r["page_id"]].split("<article>")[1].split("</article>")[0]
        import html
        import re

        parts = re.split(r"</?(?:p|h1)>", body.replace("<br>", " "))
        parts = [" ".join(html.unescape(re.sub("</?b>", "", p)).split()) for p in parts]
        assert r["text"] == "\n\n".join(p for p in parts if p)


def test_licenses(spark, medium, docs):
    lines = {
        "Released under the MIT License.": "MIT",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
    }
    for r in collect(spark, medium, "op10_license_digest"):
        named = sorted({lines[x] for x in (docs[r["doc_id"]] or "").split("\n") if x in lines})
        assert r["notices"] == ",".join(named)
