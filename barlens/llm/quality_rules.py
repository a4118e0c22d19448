"""Quality rules: counts per document, failure rates per host, host verdicts joined back.

A host's share of failing documents is shrunk towards the corpus by a beta prior whose two numbers
are fitted to the hosts' own rates (method of moments). Documents that fail the base rules go, and
so do all documents of a host whose shrunken rate reaches ``HostRules.limit``. With
``HostRules.judge_documents`` a document goes as well that fails one of the other rules itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barlens.llm.common import chunks, covered, raw_text, window_hashes, word_hashes
from barlens.session import stage

REPEAT_WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_NO_CHARACTER = _SPACE + bytes(range(0x80, 0xC0))


@dataclass(frozen=True)
class HostRules:
    """When a document fails for its host's rate, and when a host is refused."""

    symbol_share: float = 0.1
    shortest_mean_word: float = 2.0
    longest_mean_word: float = 15.0
    limit: float = 0.8
    weakest_prior: float = 1.0
    strongest_prior: float = 10_000.0
    judge_documents: bool = False


def repeated_words(words: list[bytes], width: int = REPEAT_WINDOW) -> int:
    """Words inside runs of ``width`` words that occur twice or more in the text."""
    if len(words) <= width:
        return 0
    hashes = window_hashes(word_hashes(words), width)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    if not same.any():
        return 0
    suspects = np.unique(np.concatenate((order[1:][same], order[:-1][same])))
    seen: dict[tuple, int] = {}
    grams = [tuple(words[i : i + width]) for i in suspects.tolist()]
    for gram in grams:
        seen[gram] = seen.get(gram, 0) + 1
    starts = suspects[np.fromiter((seen[g] > 1 for g in grams), bool, len(grams))]
    return int(covered(starts, starts + width, len(words)).sum())


def measure_text(text: bytes) -> tuple[int, int, int, int, int]:
    """The values of ``MEASURES`` for one text."""
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, _NO_CHARACTER)),
        len(text) - len(text.translate(None, _SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def measured(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """The documents with the ``MEASURES`` columns; columns of those names are replaced."""
    source = docs.drop(*MEASURES).withColumn("__text", raw_text(text_column))
    schema = T.StructType(
        [f for f in source.schema.fields if f.name != "__text"]
        + [T.StructField(name, T.LongType()) for name in MEASURES]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text"):
            found = [measure_text(text) for text in batch.column("__text").to_pylist()]
            columns = {n: batch.column(n) for n in batch.schema.names if n != "__text"}
            for name, values in zip(MEASURES, zip(*found)):
                columns[name] = pa.array(values, pa.int64())
            yield pa.RecordBatch.from_pydict(columns)

    return source.mapInArrow(work, schema)


def base_failed() -> Column:
    """Too few words, or too many inside repeated runs."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def fails_a_rule(rules: HostRules = HostRules()) -> Column:
    """The base rules, too many symbols, or words of an unusual mean length."""
    mean_word = F.try_divide(F.col("word_chars"), F.col("n_words"))
    return (
        base_failed()
        | (F.col("n_symbols") > rules.symbol_share * F.col("word_chars"))
        | F.coalesce(
            (mean_word < rules.shortest_mean_word) | (mean_word > rules.longest_mean_word),
            F.lit(False),
        )
    )


def host_verdicts(docs: DataFrame, host_column: str, rules: HostRules = HostRules()) -> DataFrame:
    """One row per host of measured documents: host, n_docs, n_failing, shrunken rate, refused.

    Counts combine before the shuffle, so a host with a third of all documents costs no more than
    another. Documents without a host belong to none.
    """
    hosts = (
        docs.where(F.col(host_column).isNotNull())
        .groupBy(F.col(host_column).alias("host"))
        .agg(
            F.count("*").alias("n_docs"),
            F.sum(fails_a_rule(rules).cast("long")).alias("n_failing"),
        )
        .withColumn("rate", F.col("n_failing") / F.col("n_docs"))
    )
    spread = hosts.agg(
        F.avg("rate").alias("mean"), F.coalesce(F.var_samp("rate"), F.lit(0.0)).alias("variance")
    )
    room = F.col("mean") * (1 - F.col("mean"))
    fitted = F.when(F.col("variance") > 0, room / F.col("variance") - 1)
    strength = F.coalesce(
        F.least(F.greatest(fitted, F.lit(rules.weakest_prior)), F.lit(rules.strongest_prior)),
        F.lit(rules.strongest_prior),
    )
    prior = spread.select(
        (F.col("mean") * strength).alias("alpha"), strength.alias("strength")
    )
    shrunken = (F.col("n_failing") + F.col("alpha")) / (F.col("n_docs") + F.col("strength"))
    return (
        hosts.join(F.broadcast(prior))  # one row
        .withColumn("shrunken", shrunken)
        .select(
            "host", "n_docs", "n_failing", "shrunken",
            (F.col("shrunken") >= rules.limit).alias("refused"),
        )
    )


def judged(
    docs: DataFrame, hosts: DataFrame, host_column: str, rules: HostRules = HostRules()
) -> DataFrame:
    """Measured documents with base_failed and kept."""
    verdicts = hosts.where("refused").select(
        F.col("host").alias("__host"), F.lit(True).alias("__refused")
    )
    failed = fails_a_rule(rules) if rules.judge_documents else F.col("base_failed")
    return (
        docs.drop("base_failed", "kept")
        .withColumn("base_failed", base_failed())
        .join(verdicts, F.col(host_column) == F.col("__host"), "left")
        .withColumn("kept", ~failed & F.col("__refused").isNull())
        .drop("__host", "__refused")
    )


def quality_filter(
    docs: DataFrame, host_column: str = "source", text_column: str = "text",
    rules: HostRules = HostRules(),
) -> DataFrame:
    """The documents that the rules keep, with their own columns.

    A null or empty text has no words and fails. A null host is never refused. Repeated rows are
    judged one by one. An empty table gives an empty result. Columns named like the measures are
    left out of the judgement and returned untouched.
    """
    # Written, the verdicts have a known size: as long as they are small no text is shuffled by
    # host, where one host may hold a third of it; beyond, the join splits such hosts.
    hosts = stage(
        host_verdicts(
            measured(docs.select(F.col(host_column).alias("host"), text_column), text_column),
            "host", rules,
        ),
        "hosts",
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    packed = docs.select(row, F.col(host_column).alias("host"), F.col(text_column).alias("body"))
    kept = judged(measured(packed, "body"), hosts, "host", rules).where("kept")
    return kept.select("row.*")
