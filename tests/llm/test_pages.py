"""Page extraction: labelled pages, broken markup, and the given pages."""

from __future__ import annotations

import html
import itertools
import math
import re

import pytest

from starloom.llm import pages

SCHEMA = "page_id long, url string, html string, text string"


@pytest.fixture(scope="module")
def model(spark):
    return pages.trained(spark.read.parquet("/root/testdata/sf0.01/pages.parquet"))


def test_marginals_are_exact(model):
    nodes = pages.parse("<body><nav><a href=x>Up</a></nav><div><p>Some words here. And more.</p></div></body>")
    pages.measure(nodes)
    weights = [sum(model.weights[f] for f in pages.features(nodes, k)) for k in range(len(nodes))]
    total, sums = 0.0, [0.0] * len(nodes)
    for states in itertools.product((0, 1), repeat=len(nodes)):
        score = sum(w for w, s in zip(weights, states) if s)
        score += sum(model.ties[pages.tie_kind(nodes, k)][states[nodes[k].parent], states[k]] for k in range(1, len(nodes)))
        total += math.exp(score)
        for k, s in enumerate(states):
            sums[k] += math.exp(score) * s
    assert pages.marginals(nodes, model) == pytest.approx([x / total for x in sums])


def test_a_page_of_another_make(model):
    page = (
        '<html><head><title>T</title></head><body><div class="header">Site</div><ul class="menu"><li><a href=x>One</a></li></ul>'
        '<div class="story"><h2>Title   here</h2><p>Some words of a story, which go\non for a while. And on they go, longer than most.'
        "<p>Short.<p>Tom &amp; Ann said &#233;t&eacute; was <b>ov</b>er. That was all they said about it.<br>So.</div>"
        '<div class="sidebar"><p>Text about other matters, as one finds in such places. More of it.</p></div><script>var a = "<p>no</p>";</script>'
        '<div class="comments"><p>Nice story, I liked it a lot. Really.</p></div><form><p>Subscribe to our newsletter now.</p></form><footer>Copyright</footer>'
    )
    assert pages.main_text(page, model).split("\n\n") == [
        "Title here",
        "Some words of a story, which go on for a while. And on they go, longer than most.",
        "Short.",
        "Tom & Ann said été was over. That was all they said about it. So.",
    ]


def article(page):
    """The text of the one <article> of a given page, by its fixed layout."""
    body = page[page.find("<article>") + 9 :] if "<article>" in page else ""
    body = re.sub(r"<[^<>]*$", "", body[: body.find("</article>")] if "</article>" in body else body)
    blocks = [html.unescape(re.sub(r"<[^>]*>", lambda m: " " if m[0] == "<br>" else "", x)) for x in re.split(r"</?(?:p|h1)>", body)]
    return "\n\n".join(y for y in (" ".join(x.split()) for x in blocks) if y)


def test_given_pages(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    expected = {r.page_id: article(r.html) for r in table.collect()}
    got = pages.extracted(table).collect()
    assert {r.page_id: r.text for r in got} == expected
    assert all(r.n_chars == len(r.text) for r in got)


def test_odd_pages(spark):
    long = "<article>" + "<p>Word after word, without an end. And so on it goes.</p>" * 20000
    odd = [None, "", "   ", "just text. With two sentences.", "<", "<p", "</p></div>", "<div>" * 3000 + "deep", "<script>x", "<!-- open", long, "<a b='", "&#xD800;&#0;"]
    rows = [(k if k else None, None, x, "clash") for k, x in enumerate(odd)] + [(1, "u", odd[3], "clash")] * 2
    got = pages.extracted(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[None].text == by_id[2].text == by_id[8].text == "" and by_id[10].text.count("\n\n") == 19999
    assert pages.extracted(spark.createDataFrame([], SCHEMA)).collect() == []


STORY = "<article><h1>Rain</h1><p>It rained all day, and nobody went out. The river rose by a foot or more.</p></article>"


@pytest.mark.parametrize("tag", sorted(pages.RAW - pages.UNPARSED - {"head"}))
def test_controls_without_an_end_leave_the_page(model, tag):
    expected = pages.main_text(f"<body>{STORY}</body>", model)
    assert expected.startswith("Rain")
    for control in (f"<nav><{tag}></nav>", f"<{tag}><{tag}/></{tag}>", f"<{tag}><{tag} a='>' /><{tag}>x</{tag}></{tag}>", f"<{tag}><!--<{tag}>--></{tag}>"):
        assert pages.main_text(f"<body>{control}{STORY}</body>", model) == expected
    assert expected in pages.main_text(f"<{tag}>Menu{STORY}", model)
    many = pages.parse(f"<{tag}>" * 20000 + STORY)
    assert any(n.tag == "article" for n in many)


def test_heads_end_at_the_body():
    for head in ("<head><title>T</title>", "<head><script>'<body>'</script></head>", "<head><meta><body class=x>"):
        assert [n.tag for n in pages.parse(head + STORY) if n.tag not in ("", "body")] == ["html", "article", "h1", "p"]


def test_data_main_of_crawled_pages_is_no_label(spark):
    rows = [(k, "u", f"<body><div data-main={x}>{STORY}</div></body>", "clash") for k, x in enumerate(('"home"', '""', '"1"', '"0"', "x"))]
    assert len({r.text for r in pages.extracted(spark.createDataFrame(rows, SCHEMA)).collect()}) == 1
    assert all(n.label is None for n in pages.parse(rows[2][2]))
