"""HTML extraction, URL rules, WARC archives and secret scans beyond their SQL."""

import gzip

import pytest
from pyspark.sql import functions as F

from barlens.llm import secret_scan, url_rules, warc
from barlens.llm.html_text import extract_text, main_text

from .conftest import PAGES, odd_documents

PARAGRAPH = "It is the way of the world that they are here and that he was there with you. " * 4


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("<p>" + PARAGRAPH, ""),
        (f"<div><p>{PARAGRAPH}</p><p>{PARAGRAPH}", "two"),
        ("<nav><a href=x>Home</a></nav><article><h1>T</h1><p>Short.<p>A &amp; B&eacute;</article>"
         "<footer>&copy; us</footer>", "T\n\nShort.\n\nA & Bé"),
        ("<article><p><b>a\n b</b><br>c<p>d</p><div class='comments'><p>no</p></div><p>e</article>",
         "a b c\n\nd\n\ne"),
        ("<article><p>x<script>if (a</p>) '<p>'</script>y<style>p{}</style><!-- <p>no --></p></article>",
         "xy"),
        ("<div class=ad>buy <div>now</div></div><main><p>text</p><aside>side</aside>"
         "<form><p>mail</p></form></main>", "text"),
        ("<article><p>cut &am", "cut &am"),
        ("<article><p>cut <a hre", "cut"),
        ("<article><header><h1>Head</h1></header><p>body</p></article><header>Site</header>",
         "Head\n\nbody"),
        ("<div class='ad'>never closed<article><p>body</p></article>", "body"),
        ("<article><p>a <a href='1'>b</a> c d e f</p><ul><li><a href=2>link one</a></li></ul>"
         "</article>", "a b c d e f"),
        ("<div role='banner'>top</div><div id='content'><p>body</p></div>", "body"),
    ],
)
def test_main_text(page, text):
    if page.startswith("<p>"):
        text = PARAGRAPH.strip()
    if text == "two":
        text = PARAGRAPH.strip() + "\n\n" + PARAGRAPH.strip()
    assert main_text(page) == text


def test_short_blocks_follow_their_neighbours():
    page = (f"<div><p>Top</p><p>{PARAGRAPH}</p><p>Yes.</p><p>{PARAGRAPH}</p></div>"
            "<div><ul><li><a href=1>one two three</a><li>or</li><li><a href=2>four five</a></ul></div>")
    assert "Yes." in main_text(page) and "\n\nor" not in main_text(page)


MEDIUM = [
    f"This is the story number {i} of the people that were in the town with him and of all that they "
    "had to say about it when he came." for i in range(4)
]
FINNISH = [
    f"Kylän {i} asukkaat kokoontuivat aamulla rannalle katsomaan veneitä, jotka palasivat mereltä täynnä "
    "kalaa, vaikka myrsky yöllä heitti aallot korkealle." for i in range(4)
]
RUSSIAN = [
    f"Жители деревни {i} собрались утром на берегу, чтобы посмотреть на лодки, которые вернулись с моря "
    "полные рыбы, хотя ночью была буря." for i in range(4)
]
AROUND = ("<div class='site-header'><a href=/>Home</a></div>", "<footer>&copy; us</footer>")


def paragraphs(texts):
    return "".join(f"<p>{t}</p>" for t in texts)


@pytest.mark.parametrize("texts", [MEDIUM, FINNISH, RUSSIAN, [" ".join(FINNISH)], MEDIUM[:1]])
@pytest.mark.parametrize(
    "opened",
    [
        "<div>", "<form action=x>", "<form><div class='content'>", "<form><div><article>",
        "<div class='page-with-sidebar'>", "<div class='has-sidebar'>", "<div class='header-fixed'>",
        "<div class='sidebar-layout'><div><div class='content'>", "<section class='post nav-open'>",
        "<div class='banner'><div><main>",
    ],
)
def test_pages_unlike_the_sample(texts, opened):
    for before, after in (("", ""), AROUND):
        page = f"{before}{opened}{paragraphs(texts)}"
        tags = [t.split()[0].strip("<>") for t in opened.split("<")[1:]]
        page += "".join(f"</{t}>" for t in reversed(tags)) + after
        assert main_text(page) == "\n\n".join(texts)


def test_russian_text_among_english_notes():
    notes = "".join(f"<div class='notice'><p>{m}</p></div>" for m in MEDIUM)
    assert main_text(notes + paragraphs(RUSSIAN)) == "\n\n".join(RUSSIAN)
    assert main_text(paragraphs([PARAGRAPH.strip()] + RUSSIAN)) == "\n\n".join([PARAGRAPH.strip()] + RUSSIAN)


def test_furniture_around_lesser_regions_stays():
    text = paragraphs([PARAGRAPH])
    for lesser in (
        f"<div class='comments'><ol><li><article><p>{PARAGRAPH}</p></article></li></ol></div>",
        "<div class='sidebar'><ul><li><article><p>A card.</p></article></li></ul></div>",
        "<form><div class='content'><p>Subscribe to it.</p></div></form>",
        "<div class='main-nav'><p>All of the news</p></div>",
        f"<div class='post-comments'><p>{MEDIUM[0]}</p></div>",
    ):
        assert main_text(f"<main>{text}</main>{lesser}") == PARAGRAPH.strip()
        assert main_text(f"{lesser}<div class='entry-content'>{text}</div>") == PARAGRAPH.strip()


def test_odd_pages_and_clashing_columns(spark):
    rows = [(i, u, h, "x") for i, u, h in PAGES + PAGES[:2]] + [(None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = extract_text(pages)
    assert found.columns == ["page_id", "url", "text", "n_chars"]
    assert found.where(F.length("text") != F.col("n_chars")).count() == 0
    assert found.count() == len(rows)
    assert found.where("page_id is null and text = ''").count() == 1


def test_rules_without_tokens_and_rarest_tokens(spark):
    rules = (
        url_rules.PatternRule("any png", r"\.png$", (), url_rules.BLOCK),
        url_rules.PatternRule("pair", r"/common/rare/", ("common", "rare"), url_rules.BLOCK),
        url_rules.host_rule("www.example.com/en", url_rules.ALLOW),
    )
    urls = ["http://a/x.png", "http://a/common/rare/", "http://a/common/", "http://b/common",
            "http://www.example.com/english", "http://a.example.com/en", None, "x.png"]
    pages = spark.createDataFrame(
        [(u, "x") for u in urls + urls[:1]], "url string, rule string"
    )
    tokens = spark.createDataFrame([("common",)] * 3 + [("rare",)], "token string")
    filed = url_rules.filed_rules(url_rules.rule_table(spark, rules), tokens)
    assert {(r.label, r.token) for r in filed.collect()} == {
        ("any png", ""), ("pair", "rare"), ("www.example.com/en", "com")
    }
    found = [(r.url, r.rule, r.verdict) for r in url_rules.judge_urls(pages, rules).collect()]
    assert sorted(found, key=str) == sorted(
        [(urls[0], "any png", "block")] * 2
        + [(urls[1], "pair", "block"), (urls[2], None, "allow"), (urls[3], None, "allow"),
           (urls[4], "www.example.com/en", "allow"), (urls[5], None, "allow"),
           (None, None, "allow"), ("x.png", None, "allow")], key=str
    )


def test_native_plans(spark):
    pages = spark.createDataFrame([("http://a.com/",)], "url string")
    docs = spark.createDataFrame([("a",)], "text string")
    spans = docs.select(secret_scan.secret_spans(F.col("text")))
    for df in (url_rules.judge_urls(pages), spans):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_archive_round_trip(spark, tmp_path):
    rows = PAGES + [PAGES[0], (None, None, "<p>" + "a b " * 600), (11, "http://z/", "z" * 70_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "digest", F.lit("x")
    )
    folder = str(tmp_path / "archive")
    warc.write_archive(pages.repartition(3), folder, segment_bytes=500)
    kinds = warc.read_records(spark, folder).groupBy("kind").count()
    assert {r.kind for r in kinds.collect()} == {"response", "revisit", "continuation"}
    found = warc.read_archive(spark, folder).collect()
    assert len(found) == len(rows)
    html = {p: (h or "").encode() for p, _, h in rows}
    for r in found:
        assert r.payload_bytes == len(html[r.page_id])
        assert r.record_type == "revisit" or bytes(r.payload) == html[r.page_id]
    revisits = {(r.page_id, r.refers_to) for r in found if r.record_type == "revisit"}
    assert revisits == {(1, 7), (5, 7), (None, 7), (9, 10)}


def records_file(tmp_path, records):
    data = b"".join(r + b"\r\n\r\n" for r in records)
    half = len(data) // 2
    # Several compressed members in one file, as other writers make them.
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(data[:half]) + gzip.compress(data[half:]))
    return str(tmp_path)


def test_segments_of_any_order_and_faults(spark, tmp_path):
    def records():
        return list(warc.page_records(1, 0, "u", b"0123456789" * 9, None, "d", 80))

    def folder(name):
        (tmp_path / name).mkdir()
        return tmp_path / name

    found = warc.read_archive(spark, records_file(folder("good"), records()[::-1])).collect()
    assert [bytes(r.payload) for r in found] == [b"0123456789" * 9]
    cut = records()
    del cut[1]
    wrong = [r.replace(b"Total-Length: 1", b"Total-Length: 2") for r in records()]
    digest = [r.replace(b"sha1:", b"sha1:0") for r in records()]
    for name, bad in (("missing", cut), ("total", wrong), ("digest", digest)):
        with pytest.raises(Exception, match="segments missing|digest"):
            warc.read_archive(spark, records_file(folder(name), bad)).collect()


def test_chunked_framing():
    for payload in (b"", b"a", b"\r\n0\r\n\r\n" * 5000):
        assert warc.unframed(warc.framed(payload, 7)) == payload
    assert warc.unframed(b"3;name=x\r\nabc\r\n0\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        warc.unframed(b"2\r\nabc\r\n0\r\n\r\n")


def test_ledger_scans_each_blob_once_per_rule_version(spark, documents, tmp_path):
    ledger = str(tmp_path / "ledger")
    first = documents(odd_documents())
    paths = secret_scan.scan_versions(first.withColumn("spans", F.lit(1)), ledger)
    assert paths.count() == first.count() and "text" not in paths.columns
    n = spark.read.parquet(ledger).count()
    assert n == first.select(F.coalesce("text", F.lit(""))).distinct().count()
    more = documents([(1, "new token=abcdefgh", None, None, None), (2, None, None, None, None)])
    found = {r.doc_id: len(r.spans) for r in secret_scan.scan_versions(first.union(more), ledger)
             .where("doc_id in (1, 2, 19)").collect()}
    assert found[1] == 1 or found[1] == 0
    assert spark.read.parquet(ledger).count() == n + 1
    secret_scan.scan_versions(first, ledger, rules=secret_scan.BASE_RULES)
    assert spark.read.parquet(ledger).count() == 2 * n + 1
