"""Block labels against the plain rule, and pages whose article is known."""

import random
import time

import pytest

from barlens.llm import html_text
from barlens.llm.html_text import Block


def plain_label(place, blocks):
    """The second pass as it is stated: every decided block is looked at for every open one."""
    block = blocks[place]
    decided = [(i, b) for i, b in enumerate(blocks) if b.label != "open"]
    own = [(i, b.label) for i, b in decided if b.region == block.region and not b.furniture]
    if block.in_text:
        before = [label for i, label in own if i < place][-1:] or ["good"]
        after = [label for i, label in own if i > place][:1] or ["good"]
        return "bad" if before + after == ["bad", "bad"] else "good"
    near = own or [(i, b.label) for i, b in decided]
    reach = {
        label: min((abs(i - place) for i, found in near if found == label), default=10**9)
        for label in ("good", "bad")
    }
    return "good" if reach["good"] < reach["bad"] else "bad"


@pytest.mark.parametrize("seed", range(40))
def test_open_blocks_follow_their_neighbours(seed):
    pick = random.Random(seed)
    blocks = [
        Block("x", 0, region := pick.randrange(3), region > 0, pick.random() < 0.2,
              pick.choice(("good", "bad", "open", "open")))
        for _ in range(pick.randrange(1, 60))
    ]
    expected = {i: plain_label(i, blocks) for i, b in enumerate(blocks) if b.label == "open"}
    assert html_text._inherited(blocks) == expected


def test_many_blocks_take_linear_time():
    blocks = [Block("x", 0, 0, False, False, "open" if i % 2 else "good") for i in range(40_000)]
    start = time.perf_counter()
    assert set(html_text._inherited(blocks).values()) == {"good"}
    assert time.perf_counter() - start < 1


NAV = '<nav><ul>' + "".join(f'<li><a href="/{i}">Section {i}</a></li>' for i in range(8)) + "</ul></nav>"
FOOT = '<footer><p>© 2024 Some Company. All rights reserved.</p><a href="/terms">Terms</a></footer>'
SIDE = '<aside class="sidebar"><h3>Related</h3>' + "".join(f'<a href="/r{i}">A related story number {i}</a> ' for i in range(6)) + "</aside>"
NOTICE = '<div class="cookie-notice"><p>We use cookies to make this site work. By going on you accept them all.</p><button>Accept</button></div>'
FORM = '<form action="/subscribe"><label>Mail</label><input name="m"><p>Subscribe to our letter and never miss a story again.</p></form>'
COMMENTS = '<section id="comments"><h3>Comments</h3><div class="comment"><p>What a wonderful text this is, I have read it twice and will read it again.</p></div></section>'


def page(template, paragraphs):
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    return {
        "article": f"<html><head><style>p {{}}</style></head><body>{NOTICE}{NAV}<article>{body}</article>{SIDE}{COMMENTS}{FORM}{FOOT}</body></html>",
        "main": f"<html><body><header>{NAV}</header><main>{body}</main>{COMMENTS}{SIDE}{FOOT}</body></html>",
        "plain": f"<html><body>{NAV}<div class=wrap><div class=story>{body}</div>{SIDE}{COMMENTS}</div>{NOTICE}{FORM}{FOOT}<script>x()</script></body></html>",
    }[template]


@pytest.mark.parametrize("template", ["article", "main", "plain"])
def test_known_articles(spark, template):
    """Blocks found among the right ones and right ones found, over all languages of the table."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("lang", "text").collect()
    pick = random.Random(5)
    right = found = shared = 0
    for lang in sorted({d.lang for d in docs if d.lang}):
        words = [w for d in docs if d.lang == lang for w in (d.text or "").replace("<", "").replace("&", "").split()]
        for _ in range(15):
            paragraphs = []
            for _ in range(pick.randrange(3, 9)):
                at = pick.randrange(len(words) - 80)
                paragraphs.append(" ".join(words[at : at + pick.randrange(12, 80)]))
            got = html_text.main_text(page(template, paragraphs)).split("\n\n")
            right += len(paragraphs)
            found += len([b for b in got if b])
            shared += len(set(got) & set(paragraphs))
    print(template, "precision", shared / found, "recall", shared / right)
    assert shared / found >= 0.97 and shared / right >= 0.97
