import html
import re

import pytest
from llm_helpers import prose

from lodestar.llm.maintext import extract_pages, fit_weights, main_text, observations, weights

PARA = "This is a paragraph with quite a few words that make it look like prose, and it goes on."


def page(body, title="t"):
    return f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var x='</p>';</script></head><body>{body}</body></html>"


def labelled(i):
    paragraphs = "".join(f"<p>{' '.join(prose(i * 31 + j, 40))}</p>" for j in range(1 + i % 4))
    return page(f"<nav><ul><li><a href='/a'>one</a></li><li><a>two</a></li></ul></nav><div class='ad'>{' '.join(prose(i, 9))}</div>"
                f"<article><h1>{' '.join(prose(i + 1, 5))}</h1>{paragraphs}</article><footer>&copy; x {' '.join(prose(i + 2, 8))}</footer>")


@pytest.fixture(scope="module")
def weight():
    total = {}
    for i in range(60):
        for k, n in observations(labelled(i)).items():
            total[k] = total.get(k, 0) + n
    return weights(total)


CASES = {
    "plain divs": (
        f"<div class='header'><a href='/'>Site Name</a></div><ul class='menu'><li><a>Home</a></li></ul><div id='content'><h1>Title here</h1><p>{PARA}</p>"
        f"<div class='sidebar'><p>{PARA}</p></div><p>{PARA} more</p><ul><li>one item</li><li>two items</li></ul></div>"
        f"<div class='comments'><h3>Comments</h3><div class='comment'><p>{PARA * 3}</p></div></div><form><label>Name</label><button>Send</button></form>"
        "<div class='footer'>Copyright all rights reserved</div>",
        f"Title here\n{PARA}\n{PARA} more\none item\ntwo items"),
    "things inside the article": (
        f"<header><h1>Site</h1><nav><a>x</a></nav></header><main><article><header><h1>Big &amp; title</h1></header><p>{PARA}</p><aside>Related: foo</aside>"
        f"<div class=ad-banner>Buy now {PARA}</div><p>last one</p><section class='comments'><p>{PARA}</p></section><footer>Tags: a</footer></article></main>"
        f"<aside>{PARA * 2}</aside><footer>{PARA * 4}</footer>",
        f"Big & title\n{PARA}\nlast one"),
    "wrapper with a telling name": (f"<div class='content with-sidebar'><article><h1>T</h1><p>{PARA}</p></article></div>", f"T\n{PARA}"),
    "notice, breaks and references": (
        f"<div class='cookie-notice'>We use cookies {PARA}</div><article><h1>T</h1><p>one<br>two&nbsp;&#233; <b>bo</b>ld</p>loose\n text<p>end</p></article>",
        "T\none two é bold\nloose text\nend"),
    "tiny article": ("<nav><a>a</a></nav><article><h1>Hi</h1></article><footer>x y z a b c d e f</footer>", "Hi"),
    "unclosed": ("<article><h1>H</h1><p><b>open <i>tags<p>next <script>no <p>", "H\nopen tags\nnext"),
    "only a menu": ("<nav><a>a</a> <a>b</a></nav>", ""),
}


@pytest.mark.parametrize("name", CASES)
def test_pages(weight, name):
    body, want = CASES[name]
    assert main_text(page(body), weight) == want


def test_odd_input(weight):
    assert main_text(None, weight) == main_text("", weight) == main_text("<!-- x", weight) == ""
    assert main_text("a < b and c", weight) == "a < b and c"
    for long in ("<a " * 100_000, '<a "' * 50_000, "<div>" * 20_000 + "x", "&amp;" * 50_000):
        main_text(long, weight)


def test_whole_table(spark):
    rows = [(i, f"http://x/{i}", labelled(i), "clash") for i in range(80)] + [(80, None, None, "c"), (None, "u", "", "c"), (81, "u", labelled(3), "c"), (81, "u", labelled(3), "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(4)
    got = extract_pages(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        h = next(x[2] for x in rows if x[0] == r["page_id"])
        blocks = re.split("</?(?:p|h1)>", re.search("<article>(.*)</article>", h)[1]) if h else []
        assert r["text"] == "\n".join(html.unescape(b) for b in blocks if b.strip()) and r["n_chars"] == len(r["text"])
    empty = pages.limit(0)
    assert extract_pages(empty).collect() == [] and fit_weights(empty) == {}


def test_names_inside_of_an_article():
    """Slugs as ids, names as parts of classes and long named sections don't cost an article its text; short named boxes go."""
    def say(tag, n):
        return " ".join(f"{tag}{i}" for i in range(n)) + "."
    page = f"""<html><body><nav><a href="/">home</a></nav><article><h1>Title</h1><p>{say("intro", 60)}</p>
        <h2 id="search-and-rescue">Search and rescue</h2><p>{say("rescue", 50)}</p><section id="discussion"><h2 id="a-form-of-art">A form of art</h2>
        <p>{say("talk", 12)}</p></section><div class="related-work"><p>{say("related", 9)}</p></div><section class="discussion"><p>{say("long", 80)}</p></section>
        <div class="ad">buy this now</div><p class="ad">and this<p>{say("after", 20)}</p>
        <ul class="share"><li class="social"><a href="#">one</a><li class="social"><a href="#">two</a></ul>
        <p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>hidden tex</annotation></math> be <label>the root</label> {say("end", 20)}</p>
        <form><label>your mail</label></form></article><label>menu</label><footer>imprint</footer></body></html>"""
    got = main_text(page, {}).split("\n")
    assert got == ["Title", say("intro", 60), "Search and rescue", say("rescue", 50), "A form of art", say("talk", 12), say("related", 9), say("long", 80),
                   say("after", 20), f"Let x=1 be the root {say('end', 20)}"]


def test_best_run_equals_all_runs():
    """The scan's sum is the largest of all runs that end with a word, on random pages with and without marked articles."""
    import random

    from lodestar.llm.maintext import best_run, parse, scores
    r = random.Random(12)
    for _ in range(300):
        page, opened = [], []
        for _ in range(r.randrange(1, 30)):
            if opened and r.random() < 0.4:
                page.append(f"</{opened.pop()}>")
            elif r.random() < 0.5:
                opened.append(r.choice(["p", "div", "nav", "b", "li", "article", "section", "aside", "h2"]))
                page.append(f"<{opened[-1]}{r.choice(['', '', ' class=ad'])}>")
            else:
                page.append("word " * r.randrange(1, 8))
        items = parse("".join(page))
        scored = scores(items, {"<p": -0.4, "p": 0.8, "<div": -1.5, "<nav": -12.0})
        sums = [0.0] + [sum(s for _, s in scored[a:b + 1]) for b in range(len(scored)) for a in range(b + 1)
                        if scored[b][1] > 0 and items[scored[b][0]].name is None]
        best, run = best_run(items, scored)
        assert abs(best - max(sums)) < 1e-6 and (run is None) == (max(sums) <= 0)


def test_remarks_after_a_marked_article_and_boxes_beside_it():
    from lodestar.llm.maintext import main_text
    article = "<article><p>" + "word " * 10 + "</p></article>"
    remarks = "<h2>4 responses</h2><ol>" + "".join(f"<li>remark {i} says {'much ' * 30}</li>" for i in range(4)) + "</ol>"
    for page in (article + remarks, "<div>" + "box " * 70 + "</div>" + article, remarks + article + remarks):
        assert main_text(page, {}) == ("word " * 10).strip()
    assert main_text("<main></main><p>" + "outside " * 20 + "</p>", {}) == ("outside " * 20).strip()


def test_short_paragraph_after_an_advert():
    from lodestar.llm.maintext import main_text
    page = "<p>" + "text " * 30 + "</p><div class=ad>buy now</div><p>The end.</p>"
    assert main_text(page, {}) == ("text " * 30).strip() + "\nThe end."


def test_stray_quotes_do_not_stop_a_tag():
    from lodestar.llm.maintext import main_text
    page = "<article><p>see <img alt=Bob's src=x> this and <a href='x>here</a> it's fine <b title=\"a > b <i>\">bold</b> <i title='it'>x</i></p></article>"
    assert main_text(page, {}) == "see this and here it's fine bold x"


def test_deep_nesting_is_linear():
    import time

    from lodestar.llm.maintext import main_text
    at = time.time()
    for page in ("<div>" * 50_000 + "x " * 30 + "</div>" * 50_000, "<b>" * 50_000 + "x " * 30 + "</i>" * 50_000, "<p a=\"" * 50_000 + "x " * 30):
        main_text(page, {})
    assert time.time() - at < 20
