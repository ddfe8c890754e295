"""Main text of pages: tree matching against a plain version, and layouts whose articles are known."""

import random

import pytest
from hypothesis import given, settings, strategies as st

from riskframe.llm import page_text, queries
from riskframe.llm.dom import Node, form_text, form_tree, parse

WORDS = "river stone light garden window morning letter silver quiet market winter bridge forest paper candle".split()


def prose(seed, n=30):
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) for _ in range(n)) + f" {seed}."


def plain_weight(a, b):
    """Simple tree matching by the textbook's table, for children of nodes that match."""
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            pair = 1 + plain_weight(x.children, y.children) if x.sign == y.sign else 0
            table[i][j] = max(table[i - 1][j], table[i][j - 1], table[i - 1][j - 1] + pair)
    return table[-1][-1]


trees = st.recursive(st.builds(Node, st.sampled_from("abc")), lambda kids: st.builds(
    lambda s, c: Node(s, 1, c), st.sampled_from("abc"), st.lists(kids, max_size=4)), max_leaves=12)


@settings(max_examples=200, deadline=None)
@given(trees, trees)
def test_matching_has_the_weight_of_simple_tree_matching(x, y):
    weight, pairs = page_text.match_children(x.children, y.children)
    assert weight == plain_weight(x.children, y.children)
    assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
    assert all(x.children[i].sign == y.children[j].sign for i, j in pairs)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div class='a1 b'>", "</div>", "<b>", "x & y", "&eacute;", "<!-- c", "-->", "<",
                                 "<script>", "</script>", "<li>", "<td>", "<a href=\"q", "\">", "</", " \n", "<br>", "]]>", "<h1>"]), max_size=30))
def test_anything_is_a_page(parts):
    page = parse("".join(parts))
    form = form_tree(form_text(page))
    assert page_text.slots_of(page_text.wrapper_tree(page_text.wrapper_text(form)), form_tree(form_text(page)),
                              len(page.signs)) == list(range(len(page.signs)))
    assert all(t == " ".join(t.split()) and t for t in page.texts)


def test_blocks_of_torn_markup():
    page = parse("<p><b>One &amp;\n two.<br><p>Three<script>var a='</p>';</script> four<td>five</b><!-- <p>no</p> -->six<a href=x>7")
    assert page.texts == ["One & two.", "Three four", "fivesix7"]
    assert parse("a < b <3 c").texts == ["a < b <3 c"]
    assert parse("<div>" * 5_000 + "deep" + "</div>" * 5_000 + "end").texts == ["deep", "end"]
    assert parse('<p title="a>b">x</p><p class="open>y</p>').texts == ["x", "y"]


def named(i, article):  # a layout with the elements of the standard
    return (f"<html><head><title>t</title></head><body><header><a href=/>Site</a></header><nav><a href=/x>{prose(i, 3)}</a></nav>"
            f"<main><article><h1>Title {i}</h1>{article}<p>Read our magazine every single day</p><footer>By {i}</footer></article>"
            f"<section class='comments'><p>{prose(-i)}</p></section></main><aside><p>{prose(1000 + i)}</p></aside>"
            f"<form><p>Your mail</p><input></form><footer>&copy; all</footer></body></html>")


def unnamed(i, article):  # nothing but blocks and classes
    return (f"<body><div class=top-navigation><ul><li><a href=a>Home</a><li><a href=b>{prose(i, 2)}</a></ul></div><div id=cookieConsent>"
            f"We set cookies {i}</div><h1>Title {i}</h1><div class=wrap><div class='col c{i}'>{article}<div class='promo-box'>Buy {i}</div></div>"
            f"<div class=side><ul><li><a href=q>{prose(2000 + i, 6)}</a></ul></div></div><div class=bottom>Imprint</div></body>")


@pytest.fixture(scope="module")
def made(spark):
    rows, wanted, number = [], {}, 0
    for host, layout in (("a.example", named), ("b.example", unnamed)):
        for i in range(12):
            blocks = [prose(10 * number + k) for k in range(3 + i % 4)]
            html = layout(i, "".join(f"<p>{b}</p>" for b in blocks))
            rows.append((number, f"https://{host.upper()}/p{i}?q", html, "x"))
            wanted[number] = "\n\n".join([f"Title {i}", *blocks])
            number += 1
    copied = [prose(77_000 + k) for k in range(4)]
    for i in range(40):  # one article, copied to most pages of the host
        rows.append((100 + i, "https://a.example/copy", named(500, "".join(f"<p>{b}</p>" for b in copied)), "x"))
        wanted[100 + i] = "\n\n".join(["Title 500", *copied])
    single = [prose(88_000 + k) for k in range(2)]
    rows.append((200, "http://single.example", named(1, "".join(f"<p>{b}</p>" for b in single)), "x"))
    wanted[200] = "\n\n".join(["Title 1", *single, "Read our magazine every single day"])  # one page: nothing is known to be shared
    for k, (url, html, text) in enumerate([
            (None, None, ""), ("", "", ""), ("no scheme", "plain  text &amp; more", "plain text & more"), ("x://h", "<<<>", "<<<>"),
            ("http://l.example", "<article>" + "<p>long text here</p>" * 5_000 + "</article>", "\n\n".join(["long text here"] * 5_000))]):
        rows.append((300 + k, url, html, "x"))
        wanted[300 + k] = text
    rows += [(None, "http://n.example", "<p>no id</p>", "x")] * 2
    wanted[None] = "no id"
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string").repartition(3)
    return page_text.page_texts(pages, fan_in=4).collect(), wanted, rows


def test_articles_of_known_layouts(made):
    found, wanted, rows = made
    assert len(found) == len(rows)
    assert [(r["page_id"], r["text"]) for r in found if r["text"] != wanted[r["page_id"]]] == []


def test_empty_table(spark):
    assert page_text.page_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_query_finds_the_articles(spark, sf):
    import html as entities
    import re
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = queries.op12_page_text(spark, sf).collect()
    assert len(found) == len(source)
    for r in found:
        article = re.search("<article>(.*?)</article>", source[r["page_id"]], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?p>|</?h1>", article)]
        assert r["text"] == "\n\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_large_wrappers_keep_rare_nodes(spark):
    """Nodes that one page in thousands has stay in a wrapper of any size, and forms are aligned with them."""
    rare = [Node(f"div r{i}", 1) for i in range(20_001)]
    wrapper = Node("#page", 5_000, [Node("html", 5_000, rare)])
    text = page_text.wrapper_text(wrapper)
    assert text.count("\n") == 20_002
    form = "0 #page\n1 html\n2 div r7\n2 div r20000"
    forms = spark.createDataFrame([(k, "h", form) for k in range(5)] + [(9, "other", "0 #page")], "form_id long, host string, form string")
    wrappers = spark.createDataFrame([("h", text), ("other", "0 1 #page")], "host string, wrapper string")
    got = {r["form_id"]: r["slots"] for r in page_text.align(forms, wrappers, together=2).collect()}
    assert got == {**{k: [0, 1, 9, 20_002] for k in range(5)}, 9: [0]}
