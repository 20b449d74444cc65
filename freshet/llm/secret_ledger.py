"""Secret scans over an incremental ledger of blobs, in SQL functions only.

Every version of a text is addressed by the SHA-256 of its content, its blob.
The ledger has a row for each (blob, rule, version of the rule) that was
scanned, with what was found, also if that is nothing. A scan takes the
distinct blobs of the versions at hand, drops the pairs that the ledger has,
applies the remaining rules, and joins the findings of all pairs back to
every path that holds the blob. So a text is scanned once however many
copies it has, and a new version of a rule scans each blob for that rule only.

Positions come from SQL alone: a rule's matches and the gaps between them
(``regexp_extract_all``, ``split``) alternate, so running sums of their
lengths are the offsets. The sums are taken in stretches of ``STRETCH``
matches, which keeps the cost linear for texts with very many.

Copies are merged map-side before their texts are shuffled, once per blob and
task; the join back is on the blob, which adaptive execution splits if hot.

Defined results: a null text counts as empty. Offsets are code points, ends
exclusive. Rows stay as they are, repeated or without an id.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.llm.common import keep
from freshet.operators.joins import dimension

STRETCH = 500
# Addresses sent to all tasks; more are joined by shuffle.
MAX_SENT = 400_000


@dataclass(frozen=True)
class Rule:
    kind: str
    version: int
    pattern: str
    #: Group of the match, and its least length, for a finding to count.
    group: int = 0
    least: int = 1


# The base rules, in the order that their kinds sort in.
BASE_RULES = (
    Rule("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 16),
    # Runs of 32 and more; a shorter run can't hold one.
    Rule("hex", 1, r"[0-9a-f]{32,}+", 0, 32),
)
RULES = (
    *BASE_RULES,
    Rule("private_key", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("service_token", 1, r"(?:gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10}|sk_live_[A-Za-z0-9]{16}|AIza[A-Za-z0-9_-]{35})[A-Za-z0-9_-]*"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]+"),
)
SPAN = "struct<kind:string,start:bigint,end:bigint>"


def address(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def _lengths(strings: Column) -> Column:
    return F.transform(strings, lambda s: F.length(s).cast("long"))


def _sum(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, b: a + b)


def _rule_spans(text: Column, matches: Column, rule: Rule) -> Column:
    """Findings of a rule in order, from its matches (all of them, also those too short)."""
    gaps = _lengths(F.split(text, rule.pattern, -1))
    # A literal, not group 0: only texts with a match are searched again for the group.
    checked = _lengths(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))) if rule.group else _lengths(matches)
    pieces = F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("gap"), _lengths(matches).alias("size"), checked.alias("checked"))
    stretches = F.sequence(F.lit(0), F.floor((F.size(matches) - 1) / STRETCH).cast("int"))

    def within(pieces: Column) -> Column:
        def stretch(i: Column) -> Column:
            return F.slice(pieces, i * STRETCH + 1, F.lit(STRETCH))

        offsets = F.aggregate(
            stretches,
            F.array(F.lit(0).cast("long")),
            lambda acc, i: F.concat(acc, F.array(F.element_at(acc, -1) + _sum(F.transform(stretch(i), lambda p: p["gap"] + p["size"])))),
        )
        empty = F.array().cast(f"array<{SPAN}>")

        def one(i: Column, offset: Column) -> Column:
            def step(acc: Column, p: Column) -> Column:
                start = acc["at"] + p["gap"]
                end = start + p["size"]
                span = F.struct(F.lit(rule.kind).alias("kind"), start.alias("start"), end.alias("end"))
                found = F.when(p["checked"] >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
                return F.struct(end.alias("at"), found.alias("spans"))

            return F.aggregate(stretch(i), F.struct(offset.alias("at"), empty.alias("spans")), step, lambda acc: acc["spans"])

        return F.flatten(F.transform(stretches, lambda i: one(i, F.element_at(offsets, i + 1))))

    # Bound once: the pieces are an argument of a lambda, not an expression to repeat.
    spans = F.flatten(F.transform(F.array(pieces), within))
    return F.when(F.size(matches) > 0, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def scan(
    versions: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text"
) -> DataFrame:
    """New ledger rows: blob, rule, rule_version, findings; one for each pair that ``ledger`` doesn't have."""
    texts = F.coalesce(F.col(text_col), F.lit(""))
    blobs = versions.select(address(F.col(text_col)).alias("blob"), texts.alias("text"))
    pairs = [F.lit(f"{r.kind}:{r.version}") for r in rules]
    if ledger is None:
        blobs = blobs.groupBy("blob").agg(F.first("text").alias("text")).withColumn("seen", F.array().cast("array<string>"))
    else:
        # Addresses first: a text with nothing left to scan stays where it is, unless the wanted addresses are too many to be sent.
        known = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws(":", "rule", "rule_version")).alias("seen"))
        left = blobs.select("blob").distinct().join(known, "blob", "left").withColumn("seen", F.coalesce("seen", F.array().cast("array<string>")))
        left = keep(left.where(F.size(F.array_except(F.array(*pairs), "seen")) > 0))
        wanted = blobs.join(dimension(left.select("blob"), max_rows=MAX_SENT), "blob", "left_semi")
        blobs = wanted.groupBy("blob").agg(F.first("text").alias("text")).join(left, "blob")
    matched = blobs.select(
        "blob",
        "text",
        "seen",
        *[
            F.when(~F.array_contains("seen", pair), F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0))).alias(f"m_{r.kind}")
            for r, pair in zip(rules, pairs, strict=True)
        ],
    )
    entries = [
        F.struct(
            F.lit(r.kind).alias("rule"),
            F.lit(r.version).alias("rule_version"),
            F.when(F.col(f"m_{r.kind}").isNotNull(), _rule_spans(F.col("text"), F.col(f"m_{r.kind}"), r)).alias("findings"),
        )
        for r in rules
    ]
    return matched.select("blob", F.explode(F.array(*entries)).alias("e")).select("blob", "e.*").where("findings IS NOT NULL")


def findings_by_path(
    versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES, path_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """path_col, blob and findings (by start, then rule as listed) of every row of ``versions``."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    wanted = ledger.where(F.concat_ws(":", "rule", "rule_version").isin([f"{r.kind}:{r.version}" for r in rules]))
    found = wanted.where(F.size("findings") > 0).groupBy("blob").agg(F.flatten(F.collect_list("findings")).alias("found"))
    # Written first: then both sides of the join are plain shuffles, and a hot blob's paths can be split.
    found = keep(found)
    paths = versions.select(F.col(path_col), address(F.col(text_col)).alias("blob"))
    keyed = F.transform("found", lambda s: F.struct(s["start"], order[s["kind"]].alias("o"), s["end"], s["kind"]))
    in_order = F.transform(F.array_sort(keyed), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    return paths.join(found, "blob", "left").select(
        path_col, "blob", F.coalesce(in_order, F.array().cast(f"array<{SPAN}>")).alias("findings")
    )


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def digest(findings: Column) -> Column:
    return F.array_join(
        F.transform(findings, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def secrets(versions: DataFrame, ledger: DataFrame | None = None, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: path_col, n_<kind> of the base kinds, base_sha256, spans."""
    rows = scan(versions, ledger, text_col=text_col)
    everything = rows if ledger is None else ledger.unionByName(rows)
    found = findings_by_path(versions, everything, path_col=path_col, text_col=text_col)
    kinds = [r.kind for r in BASE_RULES]
    base = F.filter("findings", lambda s: s["kind"].isin(kinds))
    return found.select(
        path_col,
        *[F.size(F.filter("findings", _of_kind(k))).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(digest(base), 256).alias("base_sha256"),
        digest(F.col("findings")).alias("spans"),
        "blob",
    )
