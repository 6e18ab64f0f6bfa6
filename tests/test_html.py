"""The HTML tokenizer and selectors: literal cases, random pages against a plain tree, and linear time."""

import random
import time

import pytest

from tidemark.operators import html as markup
from tidemark.operators import pages


def texts(page, selector, skip=()):
    return markup.select(page, [markup.compile_selector(selector)], frozenset(skip))[0]


PAGE = """<!DOCTYPE html><html lang=ru><head><title>A &amp; B</title><meta name=x content='1 > 0'><script>if (a < b) "</p>"</script></head>
<body class="wide main"><!-- <p>no</p> --><div id=top data-k="v-1 w"><p>one <b>two</b><br>three<p class='x y'>four</div><ul><li>a<li>b <ul><li>c</ul><li>d</ul>
<table><tr><td>1<td>2<tr><td>3</table><p>5 < 6 &lt; 7 & 8</body></html>"""


@pytest.mark.parametrize(
    "selector,want",
    [
        ("title", ["A & B"]), ("p", ["one ", "two", "three", "four", "5 < 6 < 7 & 8"]), ("div p.x", ["four"]), ("p.x.y", ["four"]), ("#top > p > b", ["two"]), ("div > b", []),
        ("body.main b::text", ["two"]), ("[data-k|=v] b", ["two"]), ("[data-k~=w] b", ["two"]), ("[data-k^='v-'] .y", ["four"]), ("[data-k$=w][id=top] .y", ["four"]), ("[data-k*='1 w'] b", ["two"]),
        ("html[lang] title", ["A & B"]), ("*.x", ["four"]), ("b, .y ::text", ["two", "four"]), ("script", ['if (a < b) "</p>"']), ("nothing", []), ("td", ["1", "2", "3"]), ("P > B", ["two"]),
    ],
)
def test_selectors(selector, want):
    assert [t for t in texts(PAGE, selector).texts if t.strip()] == [t for t in want] or [t.strip() for t in texts(PAGE, selector).texts if t.strip()] == [t.strip() for t in want]


def test_elements():
    got = texts(PAGE, "li")
    assert [[t.strip() for t in e] for e in got.elements()] == [["a"], ["b", "c"], ["c"], ["d"]]
    assert [PAGE[a:b] for a, b in texts(PAGE, "p.x").spans] == ["<p class='x y'>four"]
    assert [PAGE[a:b] for a, b in texts(PAGE, "b").spans] == ["<b>two</b>"]
    assert texts("<p>a<script>x</script>b</p>", "p", ["script"]).texts == ["a", "b"]


@pytest.mark.parametrize("selector", ["", "a >", "> a", "a,", "a:first", "a + b", "[x", "a..b", "a{"])
def test_bad_selectors(selector):
    with pytest.raises(ValueError):
        markup.compile_selector(selector)


def test_random_pages_against_a_tree():
    """Well-nested pages: select by walking a tree."""
    rng, names, chains = random.Random(3), ["div", "b", "span", "i"], ["div b", "div > b", "b", "div span > i", "span b, i i", ".k", "div .k > b"]

    def tree(depth):
        kids = [tree(depth - 1) if depth and rng.random() < 0.6 else f"t{rng.randrange(1000)} " for _ in range(rng.randint(0, 3))]
        return (rng.choice(names), rng.choice(["", "k"]), kids)

    def source(t):
        return t if isinstance(t, str) else f"<{t[0]}{' class=k' * bool(t[1])}>{''.join(map(source, t[2]))}</{t[0]}>"

    def walk(t, path, out, steps):
        if isinstance(t, str):
            if any(hit for *_, hit in path):
                out.append(t)
            return
        fits = lambda x, s: (s.tag is None or s.tag == x[0]) and (not s.tests or x[1] == "k")

        path2 = path + [(t[0], t[1], False)]

        def chain(one, j, at):  # path2[at] is step j
            if not fits(path2[at], one[j]):
                return False
            return j == 0 or any(chain(one, j - 1, k) for k in (range(max(0, at - 1), at) if one[j].child else range(at)))

        hit = any(chain(one, len(one) - 1, len(path2) - 1) for one in steps)
        for kid in t[2]:
            walk(kid, path + [(t[0], t[1], hit)], out, steps)

    for _ in range(60):
        t = tree(5)
        for selector in chains:
            steps, out = markup.compile_selector(selector), []
            walk(t, [], out, steps)
            joined = "".join(texts(source(t), selector).texts)
            assert joined == "".join(out)


@pytest.mark.parametrize(
    "piece", ["<script>", "<!--", "<link rel=canonical ", "<a href='", '<a b="', "<div>", "<p>", "<", "</", "<li><ul><b>", "</b>", "<b></p>", "<a =", "&amp", "<td><tr>", "<title>x"]
)
def test_linear_time(piece):
    page = "<li><ul>" + piece * (500_000 // len(piece))
    begin = time.process_time()
    markup.select(page, [markup.compile_selector(s) for s in ("article p", "li", "b > b")])
    assert time.process_time() - begin < 8


def test_walls_are_found_at_once():
    page = "<li><ul>" + "<b>" * 50_000 + "<li></li>" * 50_000
    begin = time.process_time()
    assert len(texts(page, "li").ranges) == 50_001
    assert time.process_time() - begin < 8


def test_fields(spark):
    rules = {"a": {"text": "p", "title": "h1", "num_views": ".v", "tags": "li", "datetime": "time"}, None: {"text": "article"}}
    rows = [
        (1, "a", "<h1> T </h1><p>long enough</p><i class=v> 12 </i><ul><li>x<li> <li>y z</ul>"), (2, "a", "<p>short</p>"), (3, "b", "<article>one<b>two</b>three four</article>"), (4, None, "<article>0123456789</article>"),
        (5, "a", None), (6, "a", "<p>no number here</p><i class=v>12k</i>"), (6, "a", "<p>the same id again</p>"),
    ]
    df = spark.createDataFrame(rows, "page_id long, source string, html string").repartition(3)
    got = sorted((r["page_id"], r["text"], r["title"], r["num_views"], r["tags"], r["html"]) for r in pages.fields(df, rules).collect())
    assert got == [
        (1, "long enough", "T", 12, ["x", "y z"], "<p>long enough</p>"), (3, "one\ntwo\nthree four", None, None, None, "<article>one<b>two</b>three four</article>"),
        (4, "0123456789", None, None, None, "<article>0123456789</article>"), (6, "no number here", "", 0, [], "<p>no number here</p>"), (6, "the same id again", "", 0, [], "<p>the same id again</p>"),
    ]
    assert pages.fields(df.limit(0), rules).count() == 0 and pages.fields(df, {"a": rules["a"]}).count() == 3
    with pytest.raises(ValueError):
        pages.fields(df, {"a": {"colour": "p"}})


def test_cut_references_in_the_queries(spark, tmp_path):
    """A reference that lost its semicolon is text for the queries, as in their SQL; browsers decode it."""
    import duckdb

    from tidemark.plans import text

    page = "<html><head><title>a &amp</title></head><body><article><h1>one &amp</h1><p>two &amp; &lt;three&gt; &amp;lt; &quo</p></article></body></html>"
    spark.createDataFrame([(1, "https://a.com/x", page), (2, "https://a.org/x", page)], "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    for name in ("html_text", "html_fields"):
        df = text.QUERIES[name](spark, str(tmp_path))
        cur = con.execute(f"select {', '.join(df.columns)} from ({text.ORACLES[name]}) order by 1")
        assert [tuple(r) for r in df.orderBy("page_id").collect()] == cur.fetchall()
    assert texts(page, "h1").texts == ["one &"]
