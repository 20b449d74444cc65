"""The query of each operator: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm import language_id, quality_pu
from freshet.llm.best_fit import pack
from freshet.llm.centroid_tree import cluster, with_totals
from freshet.llm.common import id_remainder, keep, table
from freshet.llm.decontaminate import contamination
from freshet.llm.fill_middle import fill_middle
from freshet.llm.license_digest import scan_licenses
from freshet.llm.maxscore import top_k
from freshet.llm.pii_anchors import find_pii
from freshet.llm.secret_ledger import scan, secrets
from freshet.llm.sentencepiece_nbest import encode
from freshet.llm.simhash import near_duplicates
from freshet.llm.tag_paths import extract

TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
BYTE_TOKENIZER = "byte_bpe_50k.json"
BYTE_RANKS = "byte_bpe_50k.tiktoken"
GOOD = 0.3


def op1_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), TOKENIZER, n=N_BEST)


def op2_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_pii(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.drop("spans")


def op4_tag_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op6_quality_pu(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 5) == 0
    model = quality_pu.fit(docs.where(~held_out), table(spark, sf_dir, "labels"))
    flags = docs.select("doc_id", held_out.alias("held_out"), "text")
    scored = quality_pu.score(flags.select(F.struct("doc_id", "held_out").alias("row"), "text"), model, id_col="row")
    return scored.select("row.*", "score", (F.col("score") >= GOOD).cast("int").alias("predicted"))


def op7_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scans: the first makes the ledger from the rows with even ids, the second takes all rows and scans what is new."""
    docs = table(spark, sf_dir, "documents")
    ledger = keep(scan(docs.where("doc_id % 2 = 0")))
    return secrets(docs, ledger)


def op8_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = id_remainder("doc_id", 4) == 2
    model = language_id.fit(docs.where(~held_out))
    flags = docs.select(F.struct("doc_id", held_out.alias("held_out")).alias("row"), "text")
    found = language_id.identify(flags, model, id_col="row")
    return found.select("row.*", "lang_pred", "score", "rejected")


def op10_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = {"tokenizer": public_tokenizers.path(BYTE_TOKENIZER), "ranks": public_tokenizers.path(BYTE_RANKS)}
    return pack(table(spark, sf_dir, "documents"), **files, pattern=public_tokenizers.PATTERN, capacity=1024, end_id=2)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle(table(spark, sf_dir, "documents"))


def op13_centroid_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_totals(*cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece_nbest,
        op2_pii_anchors,
        op3_decontaminate,
        op4_tag_path_ratios,
        op5_simhash,
        op6_quality_pu,
        op7_secret_ledger,
        op8_maxscore,
        op9_language_id,
        op10_license_digest,
        op11_best_fit_packing,
        op12_fill_middle,
        op13_centroid_tree,
        pipeline,
    )
}
