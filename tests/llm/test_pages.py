"""HTML extraction on pages with known articles, URL filters against a plain judge."""

from __future__ import annotations

import html as entities
import re

import numpy as np
import pytest

from muniment.llm import html, queries, urls

SF = "/root/testdata/sf0.01"


def article(page):
    """Blocks of the article of a given page, whose form is known."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", " ").replace("<b>", "").replace("</b>", "")
    return [x for b in re.split(r"</?(?:p|h1)>", inner) if (x := " ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split()))]


def test_given_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op1_html_extraction(spark, SF).collect()
    assert len(rows) == len(pages)
    wrong = [r.page_id for r in rows if r.text != "\n".join(article(pages[r.page_id])) or r.n_chars != len(r.text)]
    assert len(wrong) <= 0.01 * len(rows)


@pytest.fixture(scope="module")
def model(spark):
    return html.train([r.html for r in spark.read.parquet(f"{SF}/pages.parquet").limit(html.SAMPLE).collect()])


def test_held_out_forms(spark, model):
    """Pages that the model was not fitted on, without their article tag and with more around it."""
    import random

    dice, right, total = random.Random(99), 0, 0
    rows = spark.read.parquet(f"{SF}/pages.parquet").collect()[150:]
    for r in rows:
        form = html.rewritten(r.html, dice).replace(html.MARK, "div")
        found = html.extract([form.encode()], model)[0]
        right += found == article(r.html)
        total += 1
    assert right / total > 0.9


def test_odd_pages(model):
    page = (
        "<body><div class='site-header'>My site</div><div class=menu><a href=a>One</a> <a href=b>Two</a></div><div class='post'><h2>A &amp; B</h2><div>"
        + "<p>Long  text of the\n article &lt;x&gt;, with some marks. And more text here to read.</p>" * 4
        + "</div></div><div id=comments><p>Great post, thanks a lot!</p></div><div class='footer'>(c) 2020</div>"
    )
    block = "Long text of the article <x>, with some marks. And more text here to read."
    got = html.extract([page.encode(), b"", b"no tags", b"<p><", b"<script>var x = '<p>';</script>", b"<!-- open", b"\xff\xfe<p>"], model)
    assert got[0] == ["A & B", *[block] * 4] and got[1] == [] and got[2] == ["no tags"] and got[4] == [] and got[5] == []
    long = "<div>" * 3000 + "<p>word, " * 3000
    assert len(html.extract([long.encode()], model)) == 1


@pytest.mark.parametrize("extra", [
    '<svg class="icon" viewBox="0 0 1 1"/>', "<svg><path d='M0 0'><title/></svg>", "<svg><svg><text>no</text></svg><text>no</text></svg>", "<svg>", "<noscript>", "<template>",
    "<template><template><p>no</p></template><p>no</p></template>", "<noscript><p>no</p></noscript>", "<template><div>no</div></template>",
])
def test_hidden_elements_take_nothing_else(model, extra):
    """Self-closed, nested and unclosed elements without shown text leave the article whole, with or without a later one of the tag."""
    paragraph = "Some plain text of an article, with a few marks. And more text here to read."
    for later in ("", "<div><svg></svg><noscript></noscript><template></template></div>"):
        page = f"<html><body><nav><a href=a>One</a></nav><article><h1>Heading of the text</h1><p>{paragraph}</p>{extra}" + f"<p>{paragraph}</p>" * 4 + f"</article>{later}</body></html>"
        assert html.extract([page.encode()], model)[0] == ["Heading of the text", *[paragraph] * 5]


def test_text_directly_in_the_body(model):
    """Plain body text with breaks is an article like any other, beside a heading or kept elements too; loose menus are not."""
    lines = [f"Line {i} of a plain text, with a few marks and some words. It goes on for a while, and then it ends." for i in range(6)]
    menu = "<div class=menu><a href=a>One</a> <a href=b>Two</a></div>"
    plain = "<br><br>".join(lines)
    one = " ".join(lines)
    assert html.extract([f"<html><body>{menu}<h1>Heading of the text</h1>{plain}</body></html>".encode()], model)[0] == ["Heading of the text", one]
    got = html.extract([f"<body>{menu}<h1>Heading of the text</h1>{plain}<p>{lines[0]}</p>{lines[1]} <b>bold words</b> {lines[2]}<hr><a href=a>One</a> | <a href=b>Two</a><div class=footer>(c) 2020</div>".encode()], model)[0]
    assert got == ["Heading of the text", one, lines[0], f"{lines[1]} bold words {lines[2]}"]


def named_blocks(form):
    """Blocks of the article that a training form names."""
    page = html.Page(form)
    page.tags = [t if t != html.MARK.lower() else html.MARK for t in page.tags]
    return html.blocks(page, [True, *(html.label(page)[1:] > 0).tolist()])


def test_held_out_forms_with_lists_tables_and_without_article(spark, model):
    import random

    dice = random.Random(5)
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id >= 1000").limit(300).collect()]
    rate = lambda forms, want: sum(g == w for g, w in zip(html.extract([f.encode() for f in forms], model), want)) / len(forms)
    rich = [html.enriched(p, dice) for p in pages]
    assert rate(rich, [named_blocks(f) for f in rich]) > 0.95
    assert rate([html.rewritten(p, dice).replace(html.MARK, "div") for p in pages], [article(p) for p in pages]) > 0.95
    assert rate([html.without_article(p, dice) for p in pages], [[]] * len(pages)) > 0.95


def test_parts_of_articles_and_pages_without(model):
    paragraph = "Some plain text of an article, with a few marks. And more text here to read."
    lists = f"<p>{paragraph}</p><ul><li>one item</li><li>two item</li></ul><p>{paragraph}</p><table><tr><td>a cell</td><td>b cell</td></tr></table><p>{paragraph}</p>"
    comments = "<section id=reader-feedback><h3>Feedback</h3><div><p>Great post, thanks a lot, I liked it.</p></div><div><p>I do not agree with this at all, sorry.</p></div></section>"
    pages = [
        f"<html><body><nav><a href=a>One</a></nav><article><h1>Heading of the text</h1>{lists}</article><footer>c</footer></body></html>", "<body>Home | About | Login | Subscribe now",
        "<body><nav><a href=a>Home</a></nav><p>Accept cookies</p><footer>(c) x</footer></body>", f"<body><article><h1>Heading of the text</h1>{f'<p>{paragraph}</p>' * 4}</article>{comments}</body>",
    ]
    got = html.extract([p.encode() for p in pages], model)
    assert got[0] == ["Heading of the text", paragraph, "one item", "two item", paragraph, "a cell", "b cell", paragraph]
    assert got[1] == got[2] == [] and got[3] == ["Heading of the text", *[paragraph] * 4]


def test_sample_is_of_labelled_pages_whatever_their_order(spark):
    """Pages that name no article come first and don't take the sample's place; the order of rows changes nothing."""
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    plain = [(-1 - i, "u", f"<body><div class=menu><a href=x>{i}</a></div><p>No article named here, {i}.</p></body>") for i in range(300)]
    frames = [spark.createDataFrame(x, "page_id long, url string, html string").coalesce(1) for x in ([*plain, *rows], [*rows[::-1], *plain])]
    first, second = ({r.page_id: r.text for r in html.main_text(f).collect()} for f in frames)
    assert first == second
    assert sum(first[i] != "\n".join(article(h)) for i, _, h in rows) <= 0.01 * len(rows)


def test_decoding_is_the_best_of_all_consistent_choices():
    from itertools import product

    dice = np.random.default_rng(3)
    tags = ["div", "p", "section", "nav", "form", "ul", "li"]
    for _ in range(60):
        page = html.Page("")
        n = int(dice.integers(2, 9))
        page.tags = ["#page", *dice.choice(tags, n).tolist()]
        page.parents = [0, *(int(dice.integers(0, i)) for i in range(1, n + 1))]
        page.tokens = [()] * (n + 1)
        score = dice.normal(size=n + 1)
        worth = lambda kept: sum(score[i] if page.tags[i] not in html.NEVER else -1e9 for i in range(1, n + 1) if kept[i])  # noqa: E731, B023
        best = max(worth((True, *k)) for k in product([False, True], repeat=n) if all(not k[i - 1] or page.parents[i] == 0 or k[page.parents[i] - 1] for i in range(1, n + 1)))
        kept = html.decode(page, score)
        assert all(kept[page.parents[i]] for i in range(1, n + 1) if kept[i]) and abs(worth(kept) - best) < 1e-9


def test_features_are_counts_of_the_tree(model):
    page = html.Page("<body><div class='post menu'><p>One, two.</p><p><a href=x>link</a> and</p></div><ul><li>x</li></ul></body>")
    rows = {t: f for t, f in zip(page.tags, html.features(page))}
    div, total = rows["div"], len("One, two." + "link and" + "x")
    texts = {"div": 17, "ul": 1}
    assert div[9] == 1 and div[10] == 1 and np.isclose(div[17], np.log1p(texts["div"])) and np.isclose(div[18], 4 / 17)
    assert np.isclose(div[19], 4 / 17) and np.isclose(div[20], 2 / 17) and np.isclose(div[21], np.log1p(2)) and np.isclose(div[22], 17 / total)
    assert np.isclose(rows["ul"][25], np.log1p(17)) and np.isclose(div[26], np.log1p(1)) and np.isclose(div[28], 17 * 2 / 18)


def test_kept_elements_have_kept_parents(model):
    page = html.Page(html.SKELETON)
    dice = np.random.default_rng(1)
    for _ in range(50):
        kept = html.decode(page, dice.normal(size=len(page.tags)))
        assert all(kept[page.parents[i]] for i in range(1, len(kept)) if kept[i])


def test_trees_learn_a_rule():
    dice = np.random.default_rng(2)
    x = dice.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.2) & (x[:, 2] < 0.5)).astype(float)
    model = html.BoostedTrees().fit(x[:2000], y[:2000])
    assert ((model.log_odds(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.97


def test_empty_and_extra_columns(spark):
    schema = "page_id long, url string, html string, text string, k0 string, t string, host string, path string, rule string"
    empty = spark.createDataFrame([], schema)
    assert html.main_text(empty).count() == 0
    rows = spark.createDataFrame([(1, None, None, "x", "x", "x", "x", "x", "x"), (1, None, "", "x", "x", "x", "x", "x", "x"), (None, "u", html.SKELETON, "x", "x", "x", "x", "x", "x")], schema)
    assert sorted(r.text[:12] for r in html.main_text(rows).collect()) == ["", "", "Some heading"]
    assert urls.url_verdicts(empty, urls.rule_table(spark, queries.URL_RULES)).count() == 0


def plain_verdict(url, rules):
    _, found, rest = (url or "").partition("://")
    rest = rest.split("?")[0].split("#")[0]
    host, slash, path = rest.partition("/")
    host, path = "".join(c.lower() if c.isascii() else c for c in host), slash + path
    fits = [(len(r), len(r.split("/")[0]), a, r) for a, r in rules if (h := r[: r.index("/")]) and (host == h or host.endswith("." + h)) and path.startswith(r[r.index("/") :])]
    return host, path, max(fits)[3] if fits else None, max(fits)[2] if fits else "allow"


def test_url_verdicts(spark):
    rules = [*queries.URL_RULES, ("block", "a.b.example.com/"), ("allow", "com/x/yy"), ("block", "com/x/yy"), ("block", "b.com/xy"), ("allow", "localhost:8080/a?")]
    hosts = ["example.org", "www.Example.ORG", "org", "xorg", "notexample.org", "a.b.example.com", "c.a.b.example.com", "com", "b.com", "", ".com", "ÄÖ.com", "localhost:8080", "a..com"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/123", "/en/2?x=/en/1", "/fr/x#y", "/de/", "/x/yy", "/xyz", "//", "/a?b"]
    given = [f"http://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "a://b://org/", "http://org", "x\ny://org/z", "http://a.com#http://b.com/de/", "http://example.org?u=http://fr.com/de/x",
                                                                     "http://a.com/de/?u=http://b.org/fr/", "http://a.com://b.com/de/"] * 2
    pages = spark.createDataFrame([(i, u, "x", "x", "x") for i, u in enumerate(given)], "page_id long, url string, host string, path string, suffix string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.url_verdicts(pages, urls.rule_table(spark, rules)).collect()}
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(given)}
    none = urls.url_verdicts(pages, urls.rule_table(spark, rules).limit(0))
    assert none.where("verdict != 'allow' OR rule IS NOT NULL").count() == 0 and none.count() == len(given)
