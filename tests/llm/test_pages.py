"""URL filter and main text of pages."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from blocklog.llm import html_text, url_filter
from blocklog.llm.queries import URL_RULES
from blocklog.session import Staging
from tests.llm import plain

RULES = [url_filter.parse_rule(*r) for r in URL_RULES]


def _plain_rule(host: str, path: str):
    best = None
    for verdict, text in URL_RULES:
        h, _, rest = text.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[0])):
            best = text, verdict
    return best or (None, None)


def test_rules_and_parts(spark):
    urls = {
        "http://A.Example.COM/en/1?x#y": ("a.example.com", "/en/1"), "https://www.example.com/en/": ("www.example.com", "/en/"), "x://y.net/fr/2#t": ("y.net", "/fr/2"),
        "http://net?/es/": ("net", ""), "http://host.org": ("host.org", ""), "no scheme/en/": ("", ""), "": ("", ""), None: ("", ""), "a://b://c.com/d": ("b:", "//c.com/d"),
        "http://mycom/": ("mycom", "/"), "http://É.com/É": ("É.com", "/É"), "http://com/\nx": ("com", "/\nx"),
    }
    rows = [(k, u) for k, u in enumerate(urls)] + [(0, "http://A.Example.COM/en/1?x#y"), (None, "http://b.net/es/1")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumns({"host": F.lit(1), "rule": F.lit(2), "n": F.lit(3)})
    got = url_filter.filter_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.page_id is not None:
            host, path = list(urls.values())[r.page_id]
            rule, verdict = _plain_rule(host, path)
            assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
    assert url_filter.filter_urls(pages.limit(0), RULES).count() == 0


def test_method_rejects_a_blocked_template_and_merges_like_branches(spark):
    rules = [url_filter.Rule("block", "h.org", "/spam/a"), url_filter.Rule("allow", "h.org", "/news/")]
    urls = [f"http://h.org/spam/a{k}/x" for k in range(60)] + ["http://h.org/spam/77/x"] * 3
    urls += [f"http://h.org/news/{k}" for k in range(60)] + [f"http://h.org/{lang}/{k}.html" for lang in ("en", "de") for k in range(50)]
    urls += [f"http://h.org/u/user{chr(97 + k % 26)}{chr(97 + k // 26)}/p" for k in range(100)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = url_filter.filter_urls(pages, rules).collect()
    by = {r.page_id: r for r in got}
    assert by[100].verdict == "allow" and by[130].template == by[180].template == "/de|en/#.html" and by[130].verdict == "allow"
    assert by[300].template == by[230].template == "/u/*/p"
    spam = [r for r in got if r.path == "/spam/77/x"]
    assert spam and all(r.rule is None and r.verdict == "block" and r.purity > 0.8 for r in spam)


def _equals_plain_tree(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = url_filter.filter_urls(pages, rules).collect()
    leaves: dict = {}
    for r in got:
        shape = re.sub("[0-9]+", "#", r.path)
        n, block, allow = leaves.get((r.host, shape), (0, 0, 0))
        leaves[r.host, shape] = n + 1, block + (r.rule is not None and r.verdict == "block"), allow + (r.rule is not None and r.verdict == "allow")
    block, known = sum(x[1] for x in leaves.values()), sum(x[1] + x[2] for x in leaves.values())
    want = plain.url_templates(leaves, url_filter.FAN_OUT, url_filter.SHARE, url_filter.UNLIKE, url_filter.PRIOR, (block + 1) / (known + 2))
    for r in got:
        template, purity = want[r.host, re.sub("[0-9]+", "#", r.path)]
        assert r.template == ("/" + "/".join(template) if template else "") and abs(r.purity - purity) < 1e-9, r
        if r.rule is None:
            assert r.verdict == ("block" if r.purity >= url_filter.REJECT else "allow")
    return got


def test_tree_equals_plain(spark, sf_dir):
    r = random.Random(2)
    segs = ["a", "b", "c1", "c22", "", "news", "spam", "é", "x|y", "*", "long-" + "z" * 300] + [f"u{chr(97 + k)}" for k in range(26)]
    urls = ["http://h%d.org/%s" % (r.randint(0, 2), "/".join(r.choice(segs) for _ in range(r.randint(0, 5)))) for _ in range(900)]
    urls += ["http://deep.org/" + "/".join("d" * 9) + end for end in ("/x", "/y", "")] + ["http://h0.org/spam/" + "z" * 200_000, "no url", None]
    rules = [url_filter.Rule("block", "org", "/spam"), url_filter.Rule("allow", "h1.org", "/news/"), url_filter.Rule("block", "h0.org", "/b/")]
    got = _equals_plain_tree(spark, urls, rules)
    assert any(x.rule is None and x.verdict == "block" for x in got) and any(x.rule is None and x.verdict == "allow" for x in got)
    given = [x.url for x in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    _equals_plain_tree(spark, given, RULES)


MAIN = "<h1>A &amp; B</h1><p>One <b>two</b>three\n four<p>five<br>six</p>"
TEXT = "A & B One twothree four five six"


def test_main_text_of_hard_pages(spark):
    frame = '<html><head><title>t</title><script>if (a<b) x("</p>")</script></head><body><nav><ul><li><a href="x>y">m{k}</a></ul></nav>{ad}{main}<footer>&copy; f{k}</footer>'
    cases = {
        f"<article>{MAIN}</article>": TEXT,
        f"<main>{MAIN}<aside>no</aside><form>no<input></form><div class='cookie-notice'>no</div><section id=comments><article>no</article></section></main>": TEXT,
        f"<article>{MAIN}<div class='comment-list'><p>no</div><style>p{{}}</style><!-- no --></article>": TEXT,
        "<article><p>x &lt; y &#233; 5 < 6</article>": "x < y é 5 < 6",
        f"<article>{MAIN}": TEXT + "",
        "": None,
    }
    rows, want = [], {}
    for k, (main, text) in enumerate(cases.items()):
        for ad in ("", f"<div class=ad>ad{k}</div>", f'<div class="ad">open{k}'):
            page = len(rows)
            html = frame.replace("{k}", str(page)).replace("{ad}", ad).replace("{main}", main)
            rows.append((page, f"http://h{k}.org/{page}", html))
            want[page] = text
    rows += [(100, None, None), (101, "http://h0.org/", ""), (102, "http://q.org/", "plain <b"), (None, "http://q.org/", "<p>x</p>")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({"host": F.lit(1), "main": F.lit(2), "key": F.lit(0)})
    got = {r.page_id: r for r in html_text.extract_text(pages).collect()}
    assert {k: got[k].text for k in want if want[k]} == {k: t for k, t in want.items() if t}
    assert (got[100].text, got[101].text, got[102].text, got[None].text) == ("", "", "plain", "x")
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extract_text(pages.limit(0)).count() == 0


def test_template_finds_the_slot_without_landmarks(spark):
    rows = []
    for k in range(40):
        body = f"<div class=wrap><div class=top><span>Site name</span></div><div class=story><p>story {k} " + "word " * (20 + k) + f"</p><p>end {k}</p></div><div class=end>All rights</div></div>"
        rows.append((k, f"http://s.org/{k}", f"<html><body>{body}</body></html>"))
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {k: f"story {k} " + "word " * (20 + k) + f"end {k}" for k in range(40)}


@pytest.mark.parametrize("copies", [12])
def test_copies_of_an_article_are_not_template_text(spark, copies):
    rows = [(k, f"http://c.org/{k}", "<body><p>Menu</p><article><p>same text</p></article></body>") for k in range(copies)]
    got = html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    assert {r.text for r in got} == {"same text"}


def _story(k: int) -> str:
    return f"story {k} " + " ".join(f"w{k}x{j}" for j in range(30))


def test_a_repeated_box_inside_the_article_goes(spark):
    box = "<div class=blurb7><p>Get our letter every week</p><p>No spam</p></div>"
    page = "<body><nav>n</nav><article><h1>Title {k}</h1><p>{story}</p>{box}<p>end {k}</p></article><footer>f</footer></body>"
    rows = [(k, f"http://b.org/{k}", page.format(k=k, story=_story(k), box=box)) for k in range(40)]
    rows += [(100 + k, f"http://few{k}.org/", page.format(k=k, story=_story(k), box=box)) for k in range(3)]  # no template from one page
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert all(got[k] == f"Title {k} {_story(k)} end {k}" for k in range(40))
    assert all(got[100 + k] == f"Title {k} {_story(k)} Get our letter every week No spam end {k}" for k in range(3))


def test_an_article_copied_over_a_host_keeps_its_text(spark):
    page = "<body><nav>menu {k}</nav><article><p>copied story</p><p>copied end</p></article><footer>foot {k}</footer></body>"
    rows = [(k, f"http://k.org/{k}", page.format(k=k)) for k in range(30)]
    rows += [(k, f"http://k.org/{k}", page.format(k=k).replace("copied story", _story(k)).replace("copied end", f"end {k}")) for k in range(30, 40)]
    got = {r.page_id: r.text for r in html_text.extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert {got[k] for k in range(30)} == {"copied story copied end"} and all(got[k] == f"{_story(k)} end {k}" for k in range(30, 40))


def test_the_pages_are_not_read_again_for_the_templates(spark):
    rows = [(k, "h", f"<nav>menu</nav><main><p>text {k}</p></main>") for k in range(8)]
    pages = spark.createDataFrame(rows, "key bigint, host string, html string")
    templates = html_text.page_templates(pages, Staging(spark))
    assert "MapInArrow" not in templates._jdf.queryExecution().executedPlan().toString()
    assert [r.host for r in templates.collect()] == ["h"]
