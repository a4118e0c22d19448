from barlens.llm.quality_rules import HostRules, host_verdicts, measured, quality_filter

from .conftest import odd_documents

GOOD = " ".join(f"word{i}" for i in range(40))
BAD = "too short"


def hosts_of(spark, counts):
    rows = []
    for host, good, bad in counts:
        rows += [(host, GOOD)] * good + [(host, BAD)] * bad
    return spark.createDataFrame(rows, "source string, text string")


def test_a_small_host_is_shrunk_towards_the_others(spark):
    docs = hosts_of(spark, [("a", 60, 2), ("b", 50, 3), ("c", 40, 1), ("bad", 1, 120), ("tiny", 0, 1)])
    verdicts = {r.host: r for r in host_verdicts(measured(docs), "source").collect()}
    assert verdicts["bad"].refused and not verdicts["a"].refused
    assert verdicts["tiny"].shrunken < 1 and not verdicts["tiny"].refused
    kept = quality_filter(docs)
    assert kept.groupBy("source").count().count() == 3
    assert kept.columns == docs.columns


def test_hosts_alike_share_one_rate(spark):
    docs = hosts_of(spark, [("a", 1, 1), ("b", 1, 1)])
    assert {round(r.shrunken, 6) for r in host_verdicts(measured(docs), "source").collect()} == {0.5}


def test_odd_rows_and_clashing_columns(spark, documents):
    docs = documents(odd_documents(null_ids=True)).withColumnsRenamed(
        {"lang": "n_words", "n_chars": "kept"}
    )
    kept = quality_filter(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert {6, 7, 8, 9, 17} <= set(ids) and not {0, 1, 2, 3, 15} & set(ids)
    assert ids.count(6) == 2 and ids.count(None) == 1


def test_limit_is_a_parameter(spark):
    docs = hosts_of(spark, [("a", 5, 5), ("b", 9, 1)])
    assert quality_filter(docs, rules=HostRules(limit=0.0)).count() == 0


def test_documents_judged_by_every_rule(spark):
    symbols = " ".join(f"w{i} #$%" for i in range(40))
    lines = "\n".join(f"line {i} of words" for i in range(20)) + "\nthe end\nthe end"
    texts = [GOOD] * 9 + [symbols, lines, BAD, " ".join(f"{i}" + "x" * 20 for i in range(40))]
    docs = spark.createDataFrame([(i, "a", t) for i, t in enumerate(texts)], "n int, source string, text string")
    rules = HostRules(judge_documents=True)
    assert {r.n for r in quality_filter(docs, rules=rules).collect()} == {*range(9), 10}
    assert {r.n for r in quality_filter(docs).collect()} == {*range(11), 12}
