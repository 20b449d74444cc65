"""Licence scans by lookup of canonical digests, in SQL functions only.

A text is made canonical: lower case; lines that state a copyright (the word or
sign with a sign, a year or a capitalised name) dropped, so that wrapping doesn't matter;
punctuation, marks of comments and lists, and white space turned into single
spaces; words of equal meaning spelt one way. The digest of the whole canonical text
is joined with the digests of known licences, made the same way. So are the
digests of those lines that are as long as a known notice, the sentences by
which a text names its licence. A text is made canonical once.

The known texts (``licenses/`` and ``license_texts``) are a small table; it is
broadcast if ``dimension`` finds it small, and joined by shuffle if not.

Defined results: null and empty texts have the digest of the empty text and no
licence. Of several known licences with one canonical text the first id
counts. Repeated rows stay repeated, also if they differ only in line ends. An
empty table gives no rows. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freshet.llm.license_texts import EQUIVALENT, LICENSES, NOTICES
from freshet.operators.joins import dimension

FOLDER = Path(__file__).parent / "licenses"
TEXT, LINE = 0, 1
TITLE_CHARS = 200
_YEAR = r"(?:19|20)[0-9]{2}\b"
# Words that follow "copyright" in running text; a line of a wrapped text may begin there.
_NO_NAME = "notices?|holders?|owners?|owned|ownership|laws?|licen[sc]es?|licensors?|acts?|and|or|is|in|on|to|of|for|it|interests?|permissions?|rights?|status|statements?|disclaimers?|protection|treat(?:y|ies)"
_COPYRIGHT = (
    r"(?m)^[^\p{L}\p{N}\n©]*(?:"
    r"©[^\n]*|\((?i:c)\)[^\p{L}\p{N}\n]*(?:(?i:copyright)\b|[^\n]*" + _YEAR + r")[^\n]*"
    r"|(?i:copyright)[^\p{L}\p{N}\n]*(?:\((?i:c)\)|©|" + _YEAR + r"|[<\[{]\s*(?i:year|yyyy))[^\n]*"
    r"|(?:Copyright|COPYRIGHT)[ \t:,]+(?i:by[ \t]+)?(?!(?i:" + _NO_NAME + r")\b)\p{Lu}[^\n]*"
    r"|(?i:all rights reserved)[^\n]*)$"
)
# The statement at the head of a GNU licence, with the address; the words after it may stand in its last line.
_FOUNDATION = (
    r"(?i)copyright\W*\(c\)[\W\d]*free\W+software\W+foundation\W+inc\b\.?,?(?:\W*<[^>\n]*>)?"
    r"(?:\W*\d+\W+(?:franklin|temple|mass)\b[\s\S]{0,90}?\busa\b\.?)?"
)
# Titles of texts, which copies leave out or spell otherwise.
_TITLE = r"^(?:the )?(?:mit|isc|zlib|bsd zero clause|zero clause bsd|(?:simplified |new |modified |revised )?bsd(?: [23] clause)?|[023] clause bsd|(?:simplified|new|modified) bsd) license(?: (?:mit|isc|zlib|0bsd|bsd|expat))?(?: (?:mit|isc|zlib) license)? (?=\S)"
_NOT_WORDS = r"[^\p{L}\p{N}\n]+"


def canonical(text: Column) -> Column:
    """Canonical words of a text, a space before and after each; line ends stay."""
    given = F.coalesce(text, F.lit(""))
    low = F.lower(given)
    # A name can only be told while it has its capitals.
    without = F.when(
        F.contains(low, F.lit("copyright")) | F.contains(low, F.lit("(c)")) | F.contains(low, F.lit("©")) | F.contains(low, F.lit("rights")),
        F.lower(F.regexp_replace(F.when(F.contains(low, F.lit("foundation")), F.regexp_replace(given, _FOUNDATION, "")).otherwise(given), _COPYRIGHT, "")),
    ).otherwise(low)
    # Every word has its own space on either side, so that one replacement doesn't take the next one's.
    words = F.concat(F.lit(" "), F.replace(F.regexp_replace(without, _NOT_WORDS, "  "), F.lit("\n"), F.lit(" \n ")), F.lit(" "))

    def spaced(phrase: str) -> Column:
        return F.lit(f" {phrase.replace(' ', '  ')} ")

    return reduce(lambda t, pair: F.replace(t, spaced(pair[0]), spaced(pair[1])), EQUIVALENT.items(), words)


def canonical_lines(text: Column) -> Column:
    """The canonical words of each line that has any, with single spaces."""
    squeezed = F.regexp_replace(canonical(text), r"[^\S\n]+", " ")
    return F.filter(F.transform(F.split(squeezed, "\n"), lambda x: F.trim(x)), lambda x: x != "")


def whole(lines: Column) -> Column:
    """Lines as one text; equivalent phrases that a line end had parted are spelt one way too."""
    joined = F.concat(F.lit(" "), F.array_join(lines, " "), F.lit(" "))
    phrases = [(a, b) for a, b in EQUIVALENT.items() if " " in a]
    return F.trim(reduce(lambda t, pair: F.replace(t, F.lit(f" {pair[0]} "), F.lit(f" {pair[1]} ")), phrases, joined))


def untitled(text: Column) -> Column:
    """A canonical text without the title of a known licence at the start."""
    head = F.substring(text, 1, TITLE_CHARS)
    return F.concat(F.regexp_replace(head, _TITLE, ""), F.substring(text, TITLE_CHARS + 1, 2**31 - 1))


def known_digests(licenses: DataFrame, notices: DataFrame) -> DataFrame:
    """(kind, digest, license_id), one row per kind and digest; both tables have license_id and text."""
    texts = licenses.select(F.lit(TEXT).alias("kind"), F.sha2(untitled(whole(canonical_lines(F.col("text")))), 256).alias("digest"), "license_id")
    lines = notices.select(F.lit(LINE).alias("kind"), F.sha2(whole(canonical_lines(F.col("text"))), 256).alias("digest"), "license_id")
    return texts.unionByName(lines).groupBy("kind", "digest").agg(F.min("license_id").alias("license_id"))


def known_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """Licences and notices that come with the package, as literals of a plan."""

    def rows(pairs) -> DataFrame:
        structs = [F.struct(F.lit(name).alias("license_id"), F.lit(text).alias("text")) for name, text in pairs]
        return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")

    shipped = [(f.stem, f.read_text(encoding="utf-8")) for f in sorted(FOLDER.glob("*.txt"))]
    return rows([*LICENSES.items(), *shipped]), rows(NOTICES)


def scan_licenses(
    docs: DataFrame, licenses: DataFrame | None = None, notices: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: id_col, digest, license_id (of the whole text), notices (ids named by lines, sorted, comma-joined), n_notices."""
    own = known_tables(docs.sparkSession)
    licenses = own[0] if licenses is None else licenses
    notices = own[1] if notices is None else notices
    known = dimension(known_digests(licenses, notices))
    # Equal digests need equal lengths, so only lines of a notice's length are digested.
    sizes = [r[0] for r in notices.select(F.length(whole(canonical_lines(F.col("text"))))).distinct().collect()]

    texts = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), canonical_lines(F.col(text_col)).alias("lines"))
    likely = F.array_distinct(F.filter("lines", lambda x: F.length(x).isin(sizes) if sizes else F.lit(False)))
    keys = F.concat(
        F.array(F.struct(F.lit(TEXT).alias("kind"), F.sha2(untitled(whole(F.col("lines"))), 256).alias("digest"))),
        F.transform(likely, lambda x: F.struct(F.lit(LINE).alias("kind"), F.sha2(x, 256).alias("digest"))),
    )
    found = texts.select("row", "id", F.explode(keys).alias("k")).select("row", "id", "k.*").join(known, ["kind", "digest"], "left")
    of_text = F.col("kind") == TEXT
    # Each row of the table for itself, told apart by its place.
    return found.groupBy("row").agg(
        F.first("id").alias(id_col),
        F.max(F.when(of_text, F.col("digest"))).alias("digest"),
        F.max(F.when(of_text, F.col("license_id"))).alias("license_id"),
        F.array_sort(F.collect_set(F.when(~of_text, F.col("license_id")))).alias("named"),
    ).select(id_col, "digest", "license_id", F.array_join("named", ",").alias("notices"), F.size("named").cast("long").alias("n_notices"))
