"""The pipeline against the same steps by brute force."""

from collections import Counter

import corpus_pipeline
from barlens.llm.quality_rules import measure_text

from . import brute_force
from .conftest import ITEMS, odd_documents, prose, write_tables
from .test_contamination import by_hand
from .test_dedup import similar_families


def keeps(text):
    n, _, _, _, repeated = measure_text((text or "").encode())
    return n >= 20 and 100 * repeated <= 30 * n


def deduplicated(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").encode().lower().decode()
    holders = {}
    for doc, text, *_ in rows:
        for line in text.split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(doc)
    gone = {k: max(d) for k, d in holders.items() if len(d) >= 3}
    return [
        (d, "\n".join(x for x in t.split("\n") if gone.get(key(x), d) == d), *rest)
        for d, t, *rest in rows
    ]


def test_stages_agree_with_brute_force(spark, tmp_path):
    import random

    rng = random.Random(11)
    shared = prose(rng, 30)
    rows = similar_families() + [(500 + (r[0] or 0), *r[1:]) for r in odd_documents(repeats=False)]
    rows += [(700 + i, prose(rng, 40) + "\n" + shared, "en", "a", 1) for i in range(5)]
    rows += [(800 + i, prose(rng, 25) + " " + (t or ""), "en", "b", 1) for i, (_, t) in enumerate(ITEMS)]
    rows = [(*r[:2], r[2], r[3], r[4]) for r in rows]
    write_tables(spark, tmp_path, rows)
    found = {}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, work in corpus_pipeline.STAGES:
        docs = work(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        found[name] = docs
    kept = [r for r in rows if keeps(r[1])]
    assert texts(found["quality_rules"]) == Counter((r[0], r[1]) for r in kept)
    lines = deduplicated(kept)
    assert texts(found["line_dedup"]) == Counter((r[0], r[1]) for r in lines)
    classes = brute_force.classes(lines)
    first = {doc for doc, head, *_ in classes if doc == head}
    unique = [r for r in lines if r[0] in first]
    assert texts(found["ngram_jaccard_join"]) == Counter((r[0], r[1]) for r in unique)
    clean = []
    for row in unique:
        n, hit, _ = by_hand(row[1], ITEMS)
        if not (hit and 20 * hit >= n):
            clean.append(row)
    assert texts(found["benchmark_decontamination"]) == Counter((r[0], r[1]) for r in clean)
    assert 0 < len(clean) < len(unique) < len(lines) < len(rows)
    packed = found["best_fit_packing"]
    assert {r.doc_id for r in packed.collect()} == {r[0] for r in clean}
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert run.select("doc_id", "piece", "ids_crc32").exceptAll(
        packed.select("doc_id", "piece", "ids_crc32")
    ).count() == 0
    assert run.columns == packed.columns and run.count() == packed.count()


def texts(docs):
    assert docs.columns == list(corpus_pipeline.COLUMNS)
    return Counter((r.doc_id, r.text) for r in docs.collect())


def test_repeated_and_null_ids(spark, documents, odd_folder):
    rows = odd_documents(null_ids=True)
    docs = documents(rows)
    for _, work in corpus_pipeline.STAGES[:-1]:
        docs = work(spark, docs, odd_folder)
        assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert docs.count() > 0
