"""Main text: the given template against SQL, other page layouts, awkward rows, long and broken markup."""

import time

import pytest
from conftest import SF_SMALL

from taxograde.llm import main_text as M

ARTICLE = ["The first paragraph of the article says a good deal about its subject, in two lines of text.",
           "Short one.", "A third paragraph is here; it is long enough to hold the windows above the point of surge again."]
WANT = "\n".join(ARTICLE)
BODY = "".join(f"<p>{p}</p>" for p in ARTICLE)
NAV = '<nav><ul><li><a href="/a">Home of all the pages that we have</a></li><li><a href="/b">Shop</a></li></ul></nav>'
PAGES = {
    "article": f"<html><head><title>T</title></head><body>{NAV}<article>{BODY}</article><footer>All rights are reserved.</footer>",
    "main": f"<body><header><h1>Our site, with a long claim</h1></header><main>{BODY}</main><aside><p>{'Other news. ' * 30}</p></aside>",
    "no marks": f"<div class='top-menu'><a href=x>One</a> <a href=y>Two</a></div><div id=content>{BODY}</div><div class=footer>{'legal ' * 40}</div>",
    "unclosed nav": f"<div><nav><a href=1>Menu</a><main>{BODY}</main></div>",
    "comments inside": f"<article>{BODY}<section class='comments'><p>{'I do not agree at all. ' * 20}</p></section></article>",
    "comments after": f"<article>{BODY}</article><div id='comment-list'><article><p>{'Me too. ' * 40}</p></article></div>",
    "notice and form": f"<div role=alert>{'We use cookies. ' * 20}</div><form>{'Sign up here. ' * 20}</form><article>{BODY}</article>",
    "advert inside": f"<article><p>{ARTICLE[0]}</p><div class='ad-box'>{'Buy now! ' * 30}</div><p>{ARTICLE[1]}</p><p>{ARTICLE[2]}</p></article>",
    "scripts": f"<article><script>if (a < b) t = '</p><p>{'x ' * 90}';</script><style>p {{}}</style>{BODY}<!-- <p>no</p> --></article>",
    "inline": "<article><p>The <b>first</b> paragraph of\n the <a href='x'>article</a> says a good deal&nbsp;about its subject, in two "
              f"lines<br>of text.<p>{ARTICLE[1]}</p><p>{ARTICLE[2]}</article>",
}


@pytest.mark.parametrize("name", PAGES)
def test_layouts(name):
    assert M.main_text(PAGES[name]) == WANT


def test_references_and_blocks():
    page = "<article><h1>Fish &amp; chips &lt;b&gt;</h1><ul><li>one &#8364;</li><li>two</li></ul><pre>a\n  b</pre></article>"
    assert M.main_text(page) == "Fish & chips <b>\none €\ntwo\na b"


def test_surge_and_dive():
    assert M.stretches([0, 50, 0, 40, 0, 0, 0, 9]) == [(1, 4, 90), (7, 8, 9)]
    assert M.stretches([]) == [] and M.stretches([0, 0]) == []
    # without marks, a short stretch beside a long one is no text; alone it is
    few, many = "<div><p>Only few words.</p></div>", f"<div>{BODY}</div>"
    assert M.main_text(f"{few}<hr><section class=x>{NAV}</section>{many}") == WANT
    assert M.main_text(few) == "Only few words."


@pytest.mark.parametrize("page", [None, "", "   ", "<p>", "<!-- never closed <p>x</p>", "<script>x", "<article><p class='a", "<", "</", "<<<>>>", "&"])
def test_without_text(page):
    assert M.main_text(page) in ("", "<", "</", "<<<>>>", "&")


def test_markup_costs_linear_time():
    for unit in ('<a "', "<a '\"", "<p <p", "<div>", "</b", "<!--", "<b>x", "&amp"):
        t = time.time()
        M.main_text(unit * 60_000)
        assert time.time() - t < 20, unit


def test_rows(spark):
    rows = [(1, "u", PAGES["article"], "x", 1), (1, "u", PAGES["article"], "x", 1), (None, None, PAGES["main"], None, None),
            (2, "v", None, "y", 2), (3, "w", f"<article>{'<p>word word</p>' * 20_000}</article>", "", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    got = M.extract(df).collect()
    assert [tuple(r)[:2] for r in got] == [r[:2] for r in rows]
    assert [r["n_chars"] for r in got] == [len(r["text"]) for r in got]
    assert got[0]["text"] == got[1]["text"] == got[2]["text"] == WANT and got[3]["text"] == ""
    assert got[4]["text"].count("\n") == 19_999
    assert M.extract(df.where("page_id = 99")).collect() == []


def test_oracle(spark):
    from oracle_check import digest, duck_rows
    got = M.op11_line_blocks(spark, SF_SMALL)
    cols, want = duck_rows(SF_SMALL, M.ORACLE)
    assert digest([tuple(r) for r in got.collect()], got.columns)[0] == digest(want, cols)[0]
