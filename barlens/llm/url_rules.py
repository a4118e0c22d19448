"""URL filters: rules indexed by their rarest literal token.

A rule names the literal tokens that stand in every URL it fits. Token frequencies over the URLs
choose the rarest one, and the rule is filed under it. A URL fetches the rules filed under its own
tokens by an equality join, and only those run their regular expression. Work happens once per
distinct URL. Everything is built from DataFrame functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over host + path (host in lower case).

    ``label`` is reported; of the rules that fit, the highest ``rank``, then the longest label wins.
    ``tokens`` are runs of a-z and 0-9 that every fitting URL holds as whole tokens.
    """

    label: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    rank: int = 0


_TOKEN = re.compile("[a-z0-9]+")


def host_rule(host_path: str, verdict: str, rank: int = 1) -> PatternRule:
    """A rule for a host with its subdomains and paths that begin with the given one."""
    host, slash, rest = host_path.partition("/")
    path = slash + rest
    # The last token of a path may go on in the URL unless the rule closes it.
    closed = re.sub("[A-Za-z0-9]+$", "", path).lower()
    tokens = _TOKEN.findall(host.lower()) + _TOKEN.findall(closed)
    pattern = rf"^(?:[^/]*\.)?\Q{host.lower()}{path}\E"
    return PatternRule(host_path, pattern, tuple(dict.fromkeys(tokens)), verdict, rank)


def word_rule(word: str, verdict: str = BLOCK) -> PatternRule:
    """A rule for a word that stands alone anywhere in host or path."""
    pattern = rf"(?i)(?<![a-z0-9])\Q{word}\E(?![a-z0-9])"
    return PatternRule(word, pattern, (word,), verdict)


# The stated host rules.
HOST_RULES = (
    host_rule("com/", ALLOW),
    host_rule("example.com/en/", BLOCK),
    host_rule("www.example.com/en/", ALLOW),
    host_rule("net/es/", BLOCK),
    host_rule("net/fr/", BLOCK),
)

# Words that mark a URL as unwanted where no host rule speaks.
WORD_RULES = tuple(
    word_rule(w)
    for w in (
        "adserver", "banner", "bet", "betting", "casino", "doubleclick", "escort", "jackpot",
        "pills", "poker", "porn", "sex", "slots", "spam", "tracker", "viagra", "warez", "xxx",
    )
)


def url_host(url: Column) -> Column:
    """What lies between the first :// and /, ?, # or the end, with A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(target: Column) -> Column:
    """Distinct tokens, and the empty one under which rules without tokens are filed."""
    lowered = F.translate(target, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.array_distinct(F.concat(F.split(lowered, "[^a-z0-9]+"), F.array(F.lit(""))))


def rule_table(spark, rules: tuple[PatternRule, ...]) -> DataFrame:
    return spark.createDataFrame(
        [(i, r.label, r.pattern, list(r.tokens), r.verdict, r.rank) for i, r in enumerate(rules)],
        "rule_id int, label string, pattern string, tokens array<string>, verdict string, rank int",
    )


def filed_rules(rules: DataFrame, tokens: DataFrame) -> DataFrame:
    """Every rule with the one of its tokens that the fewest URLs hold."""
    wanted = rules.select("rule_id", F.explode_outer("tokens").alias("token")).select(
        "rule_id", F.coalesce("token", F.lit("")).alias("token")
    )
    counts = (
        tokens.join(wanted.select("token").distinct(), "token", "left_semi")
        .groupBy("token").agg(F.count("*").alias("n"))
    )
    rarest = (
        wanted.join(counts, "token", "left")
        .groupBy("rule_id")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "token")).alias("best"))
        .select("rule_id", F.col("best.token").alias("token"))
    )
    return rules.drop("tokens").join(rarest, "rule_id")


def judge_urls(
    pages: DataFrame, rules: tuple[PatternRule, ...] = HOST_RULES + WORD_RULES,
    url_column: str = "url", default: str = ALLOW,
) -> DataFrame:
    """The rows of ``pages`` with host, path, rule_rank, rule (label of the winner) and verdict.

    A null URL and one without :// have empty host and path; no rule fits them unless it fits an
    empty text. Where no rule fits, rule and rule_rank are null and the verdict is ``default``.
    Repeated rows are each judged. Columns with the names of the added ones are replaced.
    """
    spark = pages.sparkSession
    url = F.col(url_column)
    urls = pages.select(url.cast("string").alias("__url")).where("__url is not null").distinct()
    target = F.concat(url_host(F.col("__url")), url_path(F.col("__url")))
    targets = urls.select("__url", target.alias("target"))
    tokens = targets.select("__url", "target", F.explode(_tokens(F.col("target"))).alias("token"))
    filed = filed_rules(rule_table(spark, rules), tokens.select("token"))
    best = (
        tokens.join(filed, "token")
        .where(F.rlike(F.col("target"), F.col("pattern")))
        .groupBy("__url")
        .agg(
            F.max(
                F.struct(
                    "rank", F.length("label").alias("n"), "label", (-F.col("rule_id")).alias("id"),
                    "verdict",
                )
            ).alias("best")
        )
        .select(
            F.col("__url"), F.col("best.rank").alias("__rank"), F.col("best.label").alias("__label"),
            F.col("best.verdict").alias("__verdict"),
        )
    )
    return (
        pages.drop("host", "path", "rule_rank", "rule", "verdict")
        .withColumn("host", url_host(url)).withColumn("path", url_path(url))
        .join(best, url.cast("string") == F.col("__url"), "left")
        .withColumn("rule_rank", F.col("__rank")).withColumn("rule", F.col("__label"))
        .withColumn("verdict", F.coalesce("__verdict", F.lit(default)))
        .drop("__url", "__rank", "__label", "__verdict")
    )
