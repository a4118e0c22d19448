"""Secret scans over an incremental ledger of content-addressed blobs.

Every version of every path is addressed by the SHA-256 of its text. A run scans only the blobs
that the ledger does not hold for the rules' version, appends one row per (blob, rule version) with
its findings, and joins findings back to every path and version of the blob. Everything is built
from DataFrame functions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlens.session import path_exists


@dataclass(frozen=True)
class SecretRule:
    """A kind of secret: matches of ``pattern``, leftmost and non-overlapping, that are kept if
    ``group`` has at least ``shortest`` characters. ``literal`` stands in every text that matches.
    """

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 1
    literal: str | None = None


# The base rules. Run lengths that a kind needs are part of its pattern where a
# shorter run can hold no longer one.
BASE_RULES = (
    SecretRule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2, shortest=6,
    ),
    SecretRule("access", r"AKIA[A-Z0-9]{16,}", literal="AKIA"),
    SecretRule("hex", r"[0-9a-f]{24,}"),
)

# Rules beyond the base ones.
MORE_RULES = (
    SecretRule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", literal="PRIVATE KEY-----"),
    SecretRule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", literal="_"),
    SecretRule(
        "jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", literal="eyJ"
    ),
    SecretRule(
        "userinfo",
        r"[a-z][a-z0-9+.-]*://[^\x09-\x0D\x20/:@?#]+:[^\x09-\x0D\x20/@?#]+@",
        literal="://",
    ),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def rule_version(rules: tuple[SecretRule, ...]) -> str:
    """Changes whenever any rule does."""
    import hashlib

    return hashlib.sha256(repr(rules).encode()).hexdigest()[:16]


def _spans_of(text: Column, rule: SecretRule, rank: int) -> Column:
    """Kept matches of one rule, from the matches and the pieces between them."""
    pattern = F.lit(rule.pattern)
    between = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found"))

    def step(state: Column, pair: Column) -> Column:
        first = state["at"] + F.length(pair["gap"])
        last = first + F.length(pair["hit"])
        kept = F.length(F.regexp_extract(pair["hit"], rule.pattern, rule.group)) >= rule.shortest
        span = F.struct(
            first.alias("start"), F.lit(rank).alias("rank"), last.alias("end"),
            F.lit(rule.kind).alias("kind"),
        )
        return F.struct(
            last.alias("at"),
            F.when(kept, F.array_append(state["found"], span)).otherwise(state["found"])
            .alias("found"),
        )

    gaps = F.slice(between, 1, F.size(matches))
    pairs = F.arrays_zip(gaps.alias("gap"), matches.alias("hit"))
    found = F.aggregate(pairs, start, step, lambda state: state["found"])
    present = F.rlike(text, pattern)
    if rule.literal:
        present = F.contains(text, F.lit(rule.literal)) & present
    return F.when(present, found).otherwise(F.array().cast(SPANS))


def secret_spans(text: Column, rules: tuple[SecretRule, ...] = RULES) -> Column:
    """All findings of a text, by start, then by the order of the rules; ends are exclusive."""
    return F.array_sort(F.concat(*[_spans_of(text, r, i) for i, r in enumerate(rules)]))


def addressed(versions: DataFrame, text_column: str) -> DataFrame:
    """The versions with their blob address; a null text is an empty one."""
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return versions.withColumn("blob", F.sha2(text, 256))


def update_ledger(
    versions: DataFrame, ledger: str, text_column: str = "text",
    rules: tuple[SecretRule, ...] = RULES,
) -> DataFrame:
    """Scan the blobs that ``ledger`` lacks for these rules; returns the ledger's rows for them.

    A blob is scanned once however many versions share it: copies meet before the shuffle and
    after it. A run that dies leaves the ledger as it was. Two runs at once may both add a blob;
    readers see it once.
    """
    spark = versions.sparkSession
    version = rule_version(rules)
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    blobs = versions.select(F.sha2(text, 256).alias("blob"), text.alias("text"))
    blobs = blobs.dropDuplicates(["blob"])
    if path_exists(spark, ledger):
        seen = spark.read.parquet(ledger).where(F.col("rule_version") == version)
        blobs = blobs.join(seen.select("blob"), "blob", "left_anti")
    blobs.select(
        "blob", F.lit(version).alias("rule_version"),
        secret_spans(F.col("text"), rules).alias("spans"),
    ).write.mode("append").parquet(ledger)
    return (
        spark.read.parquet(ledger).where(F.col("rule_version") == version)
        .dropDuplicates(["blob"]).select("blob", "spans")
    )


def scan_versions(
    versions: DataFrame, ledger: str, text_column: str = "text",
    rules: tuple[SecretRule, ...] = RULES,
) -> DataFrame:
    """Every row of ``versions`` without its text, with blob and spans (start, rank, end, kind).

    Positions are code points. Null and empty texts have no spans. Rows are never merged: repeated
    rows each get their blob's findings. Columns named blob or spans are replaced. An empty table
    leaves the ledger without new rows.
    """
    findings = update_ledger(versions, ledger, text_column, rules)
    paths = addressed(versions.drop("blob", "spans"), text_column).drop(text_column)
    found = findings.where(F.size("spans") > 0)
    return paths.join(found, "blob", "left").withColumn(
        "spans", F.coalesce("spans", F.array().cast(SPANS))
    )


def spans_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
