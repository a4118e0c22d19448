import pytest

from barlens.llm import contamination
from barlens.llm.contamination import build_index, find_contamination, index_words

from .conftest import ITEMS, odd_documents


def by_hand(text, items, width=13):
    words, hit, names = index_words((text or "").encode()), set(), set()
    for name, item in items:
        own = index_words((item or "").encode())
        n = min(width, len(own))
        for j in range(len(own) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == own[j : j + n]:
                    hit.update(range(i, i + n))
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block_words", [1, 40, 10**6])
def test_blocks_agree_with_brute_force(spark, documents, monkeypatch, block_words):
    monkeypatch.setattr(contamination, "BLOCK_WORDS", block_words)
    rows = odd_documents(null_ids=True)
    rows += [(50 + i, f"x {t} y {t}", None, None, None) for i, (_, t) in enumerate(ITEMS)]
    items = spark.createDataFrame(ITEMS + [(None, "one two")], "item_id long, text string")
    docs = documents(rows).withColumnRenamed("lang", "segment").repartition(3)
    found = find_contamination(docs, items)
    got = sorted((r.doc_id or -1, r.n_words, r.n_hit, r.items) for r in found.collect())
    assert got == sorted((d or -1, *by_hand(t, ITEMS)) for d, t, *_ in rows)
    assert found.where("n_hit != aggregate(spans, 0, (n, s) -> n + s.ends - s.starts)").count() == 0


@pytest.mark.parametrize("most", [1, 3, 100])
def test_pieces_hold_every_window_once(spark, most):
    words = [f"w{i}" for i in range(20)]
    items = [("a", " ".join(words)), ("b", "x y"), ("c", ""), ("d", None), (None, "x")]
    cut = contamination.cut_items(
        spark.createDataFrame(items, "item string, text string"), 5, "item", "text", most
    )
    windows = []
    for row in cut.collect():
        own = bytes(row.words).decode().split()
        assert row.n == len(own) <= most + 4
        n = min(5, len(own))
        windows += [(row.item, *own[i : i + n]) for i in range(len(own) - n + 1)]
    assert sorted(windows) == sorted(
        [("a", *words[i : i + 5]) for i in range(16)] + [("b", "x", "y")]
    )


def test_one_plan_for_every_test_set(spark, documents, monkeypatch):
    plans = []
    search = contamination.search_index

    def kept(*args, **named):
        found = search(*args, **named)
        text = found._jdf.queryExecution().optimizedPlan().toString()
        plans.append([line.strip(" :+-").split(" ")[0] for line in text.splitlines()])
        return found

    monkeypatch.setattr(contamination, "search_index", kept)
    docs = documents(odd_documents())
    for n in (1, 1000):
        items = spark.range(n).selectExpr("id AS item_id", "concat('some words ', id) AS text")
        monkeypatch.setattr(contamination, "BLOCK_WORDS", 100)
        assert find_contamination(docs, items).count() == len(odd_documents())
    assert plans[0] == plans[1]


def test_proximity(spark, documents):
    items = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    texts = ["alpha beta gamma delta", "alpha x beta gamma delta", "delta gamma beta alpha",
             "alpha x x x beta gamma delta"]
    docs = documents([(i, t, None, None, None) for i, t in enumerate(texts)])
    hit = {r.doc_id: r.n_hit for r in find_contamination(docs, items, slop=1).collect()}
    assert hit[0] == 4 and hit[1] == 5 and hit[3] == 0
    assert {r.doc_id for r in find_contamination(docs, items).collect() if r.n_hit} == {0}


def test_whole_index_holds_every_word(documents):
    rows = odd_documents()
    index = build_index(documents(rows).repartition(2))
    places = index.where("kind = 'term'").selectExpr("sum(length(places)) / 4").first()[0]
    assert places == sum(len(index_words((t or "").encode())) for _, t, *_ in rows)
    assert index.where("kind = 'doc'").count() == len(rows)


def test_no_items(spark, documents):
    items = spark.createDataFrame([], "item_id long, text string")
    found = find_contamination(documents(odd_documents()), items).collect()
    assert len(found) == len(odd_documents()) and not any(r.n_hit for r in found)
