"""Substring, line and near-duplicate operators beyond their SQL."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barlens.llm import substring_dedup
from barlens.llm.common import with_file_rows
from barlens.llm.line_dedup import dedup_lines
from barlens.llm.near_duplicates import chance, components, fewest_matches, near_duplicates
from barlens.llm.substring_dedup import SuffixAutomaton, remove_repeats

from . import brute_force
from .conftest import odd_documents, prose


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=12), max_size=4), st.text("abc", max_size=20))
def test_matching_statistics(spans, probe):
    automaton = SuffixAutomaton()
    for span in spans:
        automaton.add(list(span))
    expected = [
        max(n for n in range(i + 2) if any(probe[i + 1 - n : i + 1] in s for s in [*spans, ""]))
        for i in range(len(probe))
    ]
    assert list(automaton.matches(list(probe))) == expected


def removed_by_hand(rows, width):
    words = [(-1 if d is None else d, (t or "").encode().split()) for d, t, *_ in rows]
    first = {}
    for doc, ws in words:
        for i in range(len(ws) - width + 1):
            key = tuple(ws[i : i + width])
            first[key] = min(first.get(key, doc), doc)
    out = []
    for doc, ws in words:
        gone = set()
        for i in range(len(ws) - width + 1):
            if first[tuple(ws[i : i + width])] < doc:
                gone.update(range(i, i + width))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone).decode()
        out.append((doc, len(ws), len(gone), kept))
    return sorted(out)


@pytest.mark.parametrize("width, probe_words", [(50, 10**9), (50, 60), (7, 20), (1, 5)])
def test_removed_words(documents, width, probe_words):
    rows = odd_documents(null_ids=True)
    rng = random.Random(3)
    rows += [(100 + i, prose(rng, 80, size=6), None, None, None) for i in range(6)]
    docs = documents(rows).withColumnRenamed("lang", "row").repartition(3)
    found = remove_repeats(docs, width, probe_words=probe_words, keep_text=True)
    got = sorted(
        (-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text)
        for r in found.collect()
    )
    assert got == removed_by_hand(rows, width)


def test_rows_numbered_in_their_files(documents, tmp_path):
    rows = odd_documents(null_ids=True)
    docs = documents(rows).repartition(3)
    docs.write.parquet(str(tmp_path / "docs"))
    scan = docs.sparkSession.read.parquet(str(tmp_path / "docs"))
    numbered = with_file_rows(scan, "number")
    assert numbered.select("number").distinct().count() == len(rows)
    found = remove_repeats(numbered, 7, keep_text=True, row_column="number")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text)
                 for r in found.collect())
    assert got == removed_by_hand(rows, 7)


@pytest.mark.parametrize("doc", [None, 3])
def test_a_reference_is_one_row_of_an_id(documents, monkeypatch, doc):
    rng, seen = random.Random(4), []
    texts = [prose(rng, 80) for _ in range(5)]
    rows = [(doc, t) for t in [*texts, texts[0] + " more"]] + [(9 + i, t + " x") for i, t in enumerate(texts)]
    dealt = substring_dedup._with_salts
    monkeypatch.setattr(
        substring_dedup, "_with_salts", lambda spans, n: dealt(seen.append(spans.collect()) or spans, n)
    )
    found = remove_repeats(documents([(*r, None, None, None) for r in rows]), keep_text=True)
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text)
                 for r in found.collect())
    assert got == removed_by_hand(rows, 50)
    held = {}
    for span in seen[0]:
        if span.kind == 0:
            held.setdefault(span.owner, set()).add(span.row)
    assert sorted(len(v) for v in held.values()) == [1] * 5


def test_lines_with_null_ids_and_clashing_columns(spark, documents):
    line = "a line that many documents hold"
    rows = [(None, line), (None, line + "\nx"), (1, line), (5, "y\n" + line), (5, line)]
    docs = documents([(d, t, "a", "b", 1) for d, t in rows]).withColumnsRenamed(
        {"lang": "doc", "source": "n_dropped", "n_chars": "body"}
    )
    found = dedup_lines(docs)
    assert found.columns == ["doc_id", "text", "doc", "body", "n_lines", "n_dropped"]
    got = sorted((r.doc_id or 0, r.text, r.n_dropped) for r in found.collect())
    assert got == [(0, "", 1), (0, "x", 1), (1, "", 1), (5, line, 0), (5, "y\n" + line, 0)]


def similar_families(seed=5):
    """Chains of edited copies, so that links differ from classes."""
    rng, rows, doc = random.Random(seed), [], 0
    for _ in range(6):
        words = prose(rng, 120, size=5000).split()
        for _ in range(rng.randrange(1, 9)):
            rows.append((doc, " ".join(words), None, None, None))
            doc += 1
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return rows


@pytest.mark.parametrize("block", [1, 2, 1000])
def test_links_and_classes(documents, block):
    rows = similar_families() + [(900 + (r[0] or 0), *r[1:]) for r in odd_documents(repeats=False)]
    docs = documents(rows).withColumnRenamed("lang", "row")
    got = sorted(
        (r.doc_id, r.class_id, r.n_links, r.n_copies)
        for r in near_duplicates(docs, block=block).collect()
    )
    assert got == brute_force.classes(rows)


def test_repeated_and_null_ids(documents):
    rows = [(None, "a b c d e f"), (None, None), (3, "a b c d e f"), (3, "a b c d e f"), (3, "z")]
    docs = documents([(d, t, None, None, None) for d, t in rows])
    found = near_duplicates(docs).collect()
    assert sum(r.is_first for r in found) == 3
    same = [r for r in found if r.n_copies == 3]
    assert len(same) == 3 and {r.class_id for r in same} == {None}


def test_components_of_a_long_path(spark):
    order = list(range(300))
    random.Random(2).shuffle(order)
    edges = spark.createDataFrame(list(zip(order, order[1:])) + [(1000, 1001)], "a long, b long")
    found = components(edges).groupBy("root").agg(F.count("*").alias("n")).collect()
    assert sorted((r.root, r.n) for r in found) == [(0, 300), (1000, 2)]


def test_pruning_keeps_pairs_at_the_threshold():
    assert all(chance(fewest_matches(n) - 1, n) < 1e-6 for n in (16, 32, 64, 128) if fewest_matches(n))
    assert fewest_matches(128) < 0.8 * 128
