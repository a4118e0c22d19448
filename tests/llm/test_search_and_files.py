"""Ranked search, manifests and token files: bounds, proofs, file metadata and odd rows."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from barlens.llm import manifest, ranked_search, token_files
from barlens.llm.queries import QUERIES, tokenizer_path

from .conftest import DOC_SCHEMA, odd_documents, prose

# --- ranked search -----------------------------------------------------------------------


def brute_scores(docs, query):
    """(score, doc) of every document that matches, best first; ids may be null or repeat."""
    from math import floor, log

    words = [(doc, ranked_search.terms_of((text or "").encode())) for doc, text in docs]
    words = [(doc, w) for doc, w in words if w]
    n, total = len(words), sum(len(w) for _, w in words)
    terms = set(ranked_search.terms_of((query or "").encode()))
    df = {t: sum(t in w for _, w in words) for t in terms}
    out = []
    for doc, w in words:
        m = 50 + (50 * len(w) * n) // total
        score = 0
        for t in terms & set(w):
            tf = w.count(t)
            score += floor(1000 * log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf // (1000 * tf + 20 * m))
        if score:
            out.append((-score, (doc is not None, doc or 0)))
    return [(-s, doc if known else None) for s, (known, doc) in sorted(out)]


def searched(spark, docs, items, k, **how):
    found = ranked_search.search(
        ranked_search.build_index(spark.createDataFrame(docs, "doc_id long, text string, terms int")),
        spark.createDataFrame(items, "item_id string, text string, score string"), k, **how,
    ).collect()
    out = {}
    for row in sorted(found, key=lambda r: (r.item_id or "", r["rank"])):
        out.setdefault(row.item_id, []).append((row.score, row.doc_id))
        assert row["rank"] == len(out[row.item_id])
    return out


@pytest.mark.parametrize("k, first_read, block_terms, lanes", [(5, 1, 50_000, 3), (50, 8, 3, 1), (1, 64, 7, 2)])
def test_search_equals_brute_force(spark, k, first_read, block_terms, lanes):
    rng = random.Random(3)
    docs = [(i, prose(rng, rng.randrange(1, 80), 60), 1) for i in range(300)]
    docs += [(None, prose(rng, 30, 60), 1), (7, docs[7][1], 1), (400, None, 1), (401, " .,", 1)]
    items = [(f"q{i}", prose(rng, rng.randrange(1, 30), 70), None) for i in range(12)]
    items += [(None, "w1 w2 W3", None), ("empty", "", None), ("none", None, None), ("new", "zzz", None)]
    found = searched(
        spark, docs, items, k, first_read=first_read, block_terms=block_terms, lanes=lanes
    )
    for name, text, _ in items:
        assert found.get(name, []) == brute_scores([d[:2] for d in docs], text)[:k]


def test_ties_are_ranked_by_id(spark):
    docs = [(i, "same words here", 1) for i in range(90, 0, -1)] + [(500 + i, "other text", 1) for i in range(90)]
    found = searched(spark, docs, [("q", "words", None)], 50)
    assert [doc for _, doc in found["q"]] == list(range(1, 51))


def test_reading_stops_early():
    """With good documents known, a list of weak ones is not read to its end."""
    places = np.arange(10_000)
    lists = ranked_search._Lists(
        {
            "docs": places.tobytes(), "terms": np.array([5], np.int64).tobytes(),
            "ends": ranked_search._packed(np.array([10_000])),
            "places": ranked_search._packed(places),
            "impacts": ranked_search._packed(np.sort(places)[::-1]),
        }
    )
    read = []
    summed = ranked_search._summed

    def counted(at, values, n):
        read.append(len(at))
        return summed(at, values, n)

    ranked_search._summed = counted
    try:
        one, ten = np.array([5]), np.full(10, 9_990)
        found, scores = ranked_search.read_best(lists, one, np.array([1]), 10, ten)
    finally:
        ranked_search._summed = summed
    assert sorted(scores.tolist()) == list(range(9_990, 10_000)) and len(found) == 10
    assert max(read) < 100


def test_length_factor_of_huge_corpora():
    lengths = np.array([1, 10**9])
    exact = [50 + 50 * n * 10**10 // (3 * 10**12) for n in (1, 10**9)]
    assert ranked_search.length_factors(lengths, 10**10, 3 * 10**12).tolist() == exact


# --- manifest ----------------------------------------------------------------------------


def digest(text):
    return sha256(text.encode()).hexdigest()


def levels_of(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path_of(levels, i):
    out = []
    for level in levels[:-1]:
        first = i // 3 * 3
        out.append((i - first, [h for j, h in enumerate(level[first : first + 3], first) if j != i]))
        i //= 3
    return out


@pytest.mark.parametrize("sizes", [[1], [1, 1, 1, 1], [2, 3, 4, 9, 10], [243, 244, 1], [800, 27]])
def test_paths_of_all_leaves(spark, sizes):
    rows = [(i, f"s{s:03}", f"text {s} {i}") for s, n in enumerate(sizes) for i in range(n)]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    tree = manifest.build_manifest(docs, F.sha2("text", 256))
    found = {
        (r.tree, r.idx): (r.digest, r.subroot, [(p.place, p.others) for p in r.path])
        for r in manifest.prove(tree, tree.leaves.select("tree", "idx")).collect()
    }
    built = [levels_of([digest(f"text {s} {i}") for i in range(n)]) for s, n in enumerate(sizes)]
    top = levels_of([levels[-1][0] for levels in built])
    assert tree.root == top[-1][0]
    assert found == {
        (s, i): (built[s][0][i], built[s][-1][0], path_of(built[s], i) + path_of(top, s))
        for s, n in enumerate(sizes)
        for i in range(n)
    }


def test_some_leaves_of_many(spark):
    docs = spark.range(2000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("source")
    )
    tree = manifest.build_manifest(docs, F.sha2(F.col("doc_id").cast("string"), 256))
    few = tree.leaves.where("doc_id % 500 = 7").select("tree", "idx", "doc_id", "leaf")
    found = manifest.prove(tree, few).withColumn("out", manifest.folded(F.col("path"), F.col("leaf")))
    assert sorted(r.doc_id for r in found.collect()) == [7, 507, 1007, 1507]
    assert {r.out for r in found.collect()} == {tree.root}


def test_copies_share_records_and_take_places_of_their_own(spark):
    rows = [(1, "s", "same")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    tree = manifest.build_manifest(docs, F.sha2("text", 256))
    assert tree.root == levels_of([digest("same")] * 40)[-1][0]
    found = manifest.prove(tree, tree.leaves.select("tree", "idx", "leaf"))
    assert found.select("idx").distinct().count() == 40
    assert found.where(manifest.folded(F.col("path"), F.col("leaf")) != tree.root).isEmpty()


def test_fields_cannot_be_shifted(spark):
    rows = [("ab", "c"), ("a", "bc"), (None, "abc"), ("", "abc"), ("-", "abc"), ("é", None)]
    made = spark.createDataFrame(rows, "a string, b string").select(
        manifest.leaf_digest(F.col("a"), F.col("b")).alias("h")
    )
    found = [r.h for r in made.collect()]
    assert len(set(found)) == len(rows) and found[-1] == digest("2:é-")


# --- token files -------------------------------------------------------------------------


@pytest.fixture(scope="module")
def token_rows():
    long_text = "many words " * 500_000  # above the bytes a task encodes at once
    return odd_documents(null_ids=True) + [(900, long_text, None, None, None)]


@pytest.fixture(scope="module")
def token_path(spark, token_rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens") / "t")
    docs = spark.createDataFrame(token_rows, DOC_SCHEMA).withColumn("part", F.lit("x"))
    token_files.write_tokens(docs, path, tokenizer_path(), stripe_bytes=4096, rows_per_group=1000)
    return path


def test_token_files_equal_the_tokenizer(spark, token_rows, token_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    ids = [
        (doc, [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2])
        for doc, text, *_ in token_rows
    ]
    found = token_files.read_tokens(spark, token_path).orderBy("start").collect()
    assert [r.doc_id for r in found] == sorted((d for d, _ in ids), key=lambda d: (d is not None, d or 0))
    key = lambda row: (row[0] is not None, row[0] or 0, row[1])
    assert sorted(((r.doc_id, list(r.ids)) for r in found), key=key) == sorted(ids, key=key)
    ends = np.cumsum([r.n_tokens for r in found])
    assert [r.start for r in found] == [0, *ends[:-1].tolist()]
    sums = {(r.start, r.ids_crc32) for r in token_files.token_checksums(spark, token_path).collect()}
    assert sums == {(r.start, zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in found}


def test_lookups_skip_row_groups(spark, tmp_path):
    """Only row groups whose range and Bloom filter admit an id are decoded."""
    path = str(tmp_path / "t")
    docs = spark.range(0, 40_000, 2).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    token_files.write_tokens(docs, path, tokenizer_path(), rows_per_group=1000)

    def rows_read(ids):
        from pyspark.sql import Observation

        whole = token_files.read_documents(spark, path, ids)
        assert "PushedFilters: [In(doc_id" in whole._jdf.queryExecution().toString() or (
            "EqualTo(doc_id" in whole._jdf.queryExecution().toString()
        )
        found = whole.collect()
        plan = whole._jdf.queryExecution().executedPlan().finalPhysicalPlan()
        leaves = plan.collectLeaves()
        scans = [leaves.apply(i) for i in range(leaves.size())]
        counts = [
            s.metrics().apply("numOutputRows").value() for s in scans
            if s.metrics().contains("numOutputRows") and "Scan orc" in s.toString()
        ]
        return [r.doc_id for r in found], sum(counts)

    found, read = rows_read([20_000])
    assert found == [20_000] and read <= 2000
    missing, read = rows_read([20_001])  # within a range, but not in the Bloom filter
    assert missing == [] and read <= 1000


def test_stripes_of_a_file_are_read_by_several_tasks(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i, prose(rng, 400, 5000)) for i in range(400)]
    path = str(tmp_path / "t")
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    token_files.write_tokens(docs, path, tokenizer_path(), stripe_bytes=64 << 10)
    whole = token_files.read_tokens(spark, path).drop("ids").orderBy("start").collect()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "32k")
        split = token_files.read_tokens(spark, path)
        assert spark.read.orc(path).rdd.getNumPartitions() > 4
        assert split.drop("ids").orderBy("start").collect() == whole
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_token_query_of_no_documents(spark, odd_folder, tmp_path):
    spark.read.parquet(f"{odd_folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES["op13_token_binary_output"](spark, str(tmp_path)).count() == 0
