"""Main text of web pages by wrapper induction.

Pages become forms (see ``dom``). The distinct forms of a host are aligned with each other by simple tree matching and
merged into the host's wrapper, in rounds of bounded groups; every form is then aligned with its host's wrapper, so that
a block of any page has a slot. Slots that the layout keeps for menus, headers, footers, sidebars, notices, adverts, forms
and comments go; in the others a text that most of the host's pages share at the same slot is template, whatever varies
is content. What is shared is counted exactly and in distinct pages, so copies of one article make nothing a template.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskframe.llm.dom import Node, form_text, form_tree, parse
from riskframe.llm.tokens import slices
from riskframe.llm.url_rules import host_of
from riskframe.llm.workers import ready
from riskframe.plans.storage import store

_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("form", pa.string()),
                     ("nodes", pa.list_(pa.int32())), ("texts", pa.list_(pa.string())), ("linked", pa.list_(pa.int32()))])

# Elements and words that mark what isn't the article.
CHROME_TAGS = frozenset("""nav aside footer form menu dialog search button select option optgroup template object video audio
canvas svg fieldset legend""".split())
CHROME_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion
promotions nav navbar navigation navigations menu menus menubar breadcrumb breadcrumbs pagination pager toolbar topbar sitemap
footer footnav contentinfo copyright colophon sidebar sidebars complementary aside rail widget widgets notice notices cookie
cookies consent gdpr alert alerts alertdialog announcement popup modal overlay toast paywall notification notifications
newsletter subscribe subscription signup login signin search comment comments commentlist reply replies respond disqus
discussion related recommended recommendations trending share sharing social follow""".split())
HEAD_WORDS = frozenset("header banner masthead".split())
CONTENT_WORDS = frozenset("article articles content post entry main body story text".split())
LAYOUT_WORDS = frozenset("with has no without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_REMARKS = frozenset("comment comments reply replies respond".split())


# --- trees ------------------------------------------------------------------------------------------

def match_children(a: list[Node], b: list[Node]) -> tuple[int, list[tuple[int, int]]]:
    """(weight, pairs of indices) of the best matching of two lists of children that keeps both orders.

    Only nodes of the same signature are matched; a pair weighs one more than the best matching below it.
    """
    if not a or not b:
        return 0, []
    places: dict[str, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):  # later ones first, so that equal i never chain
        places.setdefault(b[j].sign, []).append(j)
    best: list[tuple[int, int]] = [(0, -1)] * (len(b) + 1)  # prefix maxima over j
    steps: list[tuple[int, int, int]] = []  # i, j, step before
    for i, node in enumerate(a):
        for j in places.get(node.sign, ()):
            weight, before, at = 0, -1, j
            while at > 0:
                if best[at][0] > weight:
                    weight, before = best[at]
                at -= at & -at
            weight += 1 + match_children(node.children, b[j].children)[0]
            steps.append((i, j, before))
            at = j + 1
            while at <= len(b):
                if best[at][0] < weight:
                    best[at] = (weight, len(steps) - 1)
                at += at & -at
    weight, step, at = 0, -1, len(b)
    while at > 0:
        if best[at][0] > weight:
            weight, step = best[at]
        at -= at & -at
    pairs = []
    while step >= 0:
        i, j, step = steps[step]
        pairs.append((i, j))
    return weight, pairs[::-1]


def merge(wrapper: Node, form: Node) -> Node:
    """The wrapper with the form's nodes: matched ones are counted, others are put in at their place."""
    wrapper.pages += form.pages
    _, pairs = match_children(wrapper.children, form.children)
    matched = {j: i for i, j in pairs}
    out, at = [], 0
    for j, child in enumerate(form.children):
        if j in matched:
            out += wrapper.children[at:matched[j]]
            out.append(merge(wrapper.children[matched[j]], child))
            at = matched[j] + 1
        else:
            out.append(child)
    wrapper.children = out + wrapper.children[at:]
    return wrapper


def slots_of(wrapper: Node, form: Node, size: int) -> list[int]:
    """The wrapper's node for every node of the form, -1 where it has none."""
    found = [-1] * size

    def walk(a: Node, b: Node) -> None:
        found[b.number] = a.number
        for i, j in match_children(a.children, b.children)[1]:
            walk(a.children[i], b.children[j])
    walk(wrapper, form)
    return found


def wrapper_text(wrapper: Node) -> str:
    """A wrapper as text, with all its nodes."""
    lines: list[str] = []

    def walk(node: Node, depth: int) -> None:
        lines.append(f"{depth} {node.pages} {node.sign}")
        for child in node.children:
            walk(child, depth + 1)
    walk(wrapper, 0)
    return "\n".join(lines)


def wrapper_tree(text: str) -> Node:
    path: list[Node] = []
    for number, line in enumerate(text.split("\n")):
        depth, pages, sign = line.split(" ", 2)
        node = Node(sign, int(pages), [], number)
        del path[int(depth):]
        if path:
            path[-1].children.append(node)
        path.append(node)
    return path[0]


# --- roles ------------------------------------------------------------------------------------------

def is_chrome(sign: str, in_content: bool) -> bool:
    """Whether an element is no part of an article, by its tag and the words of class, id and role."""
    tag, *words = sign.split(" ")
    if tag in ("html", "body", "#page"):
        return False
    if tag in CHROME_TAGS or tag == "head" or "=hidden" in words or _REMARKS & set(words):
        return True
    if tag in ("main", "article") or LAYOUT_WORDS & set(words):
        return False
    if CHROME_WORDS & set(words):
        return True
    return not in_content and (tag == "header" or bool(HEAD_WORDS & set(words))) and not CONTENT_WORDS & set(words)


def kept_nodes(form: Node, size: int, slots: list[int], mass: dict[int, tuple[int, int]]) -> list[bool]:
    """Which nodes of a form may hold content.

    ``mass`` has the characters and the links' characters of the wrapper's slots. In ``article`` and ``main`` everything
    but chrome is content. Without them it is what lies in the element that holds most of the host's text in paragraphs:
    from the top, the child is entered that has over half of it. Headings of the first level stay wherever they are.
    Slots that are mostly links outside of ``article`` and ``main`` are menus.
    """
    keep = [False] * size
    open_nodes: list[Node] = []
    paragraphs = [0.0] * size
    roots: list[Node] = []

    def walk(node: Node, in_content: bool) -> None:
        if is_chrome(node.sign, in_content):
            return
        tag = node.sign.split(" ", 1)[0]
        own = tag in ("article", "main") or "main" in node.sign.split(" ")[1:]
        if own and not in_content:
            roots.append(node)
        chars, linked = mass.get(slots[node.number], (0, 0))
        if in_content or own or 2 * linked <= chars:
            open_nodes.append(node)
            paragraphs[node.number] = chars if tag == "p" else chars / 1_000
        for child in node.children:
            walk(child, in_content or own)
            paragraphs[node.number] += paragraphs[child.number]

    walk(form, False)
    allowed = {n.number for n in open_nodes}
    filled = [r for r in roots if paragraphs[r.number] > 0]
    if not filled:
        at = form
        while at.children:
            best = max(at.children, key=lambda c: paragraphs[c.number])
            if best.sign.split(" ", 1)[0] == "p" or 2 * paragraphs[best.number] <= paragraphs[at.number]:
                break
            at = best
        filled = [at]
        for node in open_nodes:
            if node.sign.split(" ", 1)[0] == "h1":
                keep[node.number] = True

    def mark(node: Node) -> None:
        keep[node.number] = node.number in allowed
        for child in node.children:
            mark(child)
    for root in filled:
        mark(root)
    return keep


# --- the job ----------------------------------------------------------------------------------------

def parse_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, host, form, nodes, texts, linked) of every page."""
    ready(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, 3, 4_000_000):
            made = [parse(source or "") for source in rows.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns[:3], pa.array([form_text(p) for p in made], pa.string()),
                 *(pa.array([getattr(p, n) for p in made], t)
                   for n, t in zip(("nodes", "texts", "linked"), _PARSED.types[4:]))], schema=_PARSED)

    return (pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.col(html_col).cast("string").alias("html"))
            .select("page_id", "url", host_of(F.col("url")).alias("host"), "html")
            .mapInArrow(run, "page_id long, url string, host string, form string, nodes array<int>, texts array<string>, linked array<int>"))


def induce(forms: DataFrame, fan_in: int = 256) -> DataFrame:
    """(host, wrapper) from (host, form, pages): ``fan_in`` forms or wrappers are merged at a time, until one is left."""
    most = forms.groupBy("host").count().agg(F.max("count")).first()[0] or 0
    parts = max(1, -(-most // fan_in))

    def fold(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("tree", kind="stable")
        trees = rows["tree"].tolist()
        out = wrapper_tree(trees[0])
        for more in trees[1:]:
            merge(out, wrapper_tree(more))
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "part": [rows["part"].iloc[0]], "tree": [wrapper_text(out)]})

    counted = F.regexp_replace("form", F.lit(r"(?m)^(\d+) "), F.concat(F.lit("$1 "), F.col("pages"), F.lit(" ")))
    trees = forms.select("host", F.pmod(F.xxhash64("form"), F.lit(parts)).cast("int").alias("part"), counted.alias("tree"))
    while True:
        trees = trees.groupBy("host", "part").applyInPandas(fold, "host string, part int, tree string")
        if parts == 1:
            return trees.select("host", F.col("tree").alias("wrapper"))
        parts = -(-parts // fan_in)
        trees = trees.withColumn("part", F.pmod("part", F.lit(parts)))


def align(forms: DataFrame, wrappers: DataFrame, together: int = 1_000) -> DataFrame:
    """(form_id, host, form, slots): every form aligned with its host's wrapper.

    About ``together`` forms of a host meet one copy of its wrapper, however large that is.
    """
    def run(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or own.empty:
            return pd.DataFrame({"form_id": [], "host": [], "form": [], "slots": []})
        wrapper = wrapper_tree(own["wrapper"].iloc[0])
        found = [slots_of(wrapper, form_tree(form), form.count("\n") + 1) for form in rows["form"]]
        return pd.DataFrame({"form_id": rows["form_id"], "host": rows["host"], "form": rows["form"], "slots": found})

    parts = store(forms.groupBy("host").agg(F.ceil(F.count("*") / together).cast("int").alias("parts")), "parts")
    dealt = (forms.select("form_id", "host", "form").join(parts, "host")
             .select("form_id", "host", "form", F.pmod("form_id", "parts").cast("int").alias("part")))
    copies = wrappers.join(parts, "host").select("host", "wrapper", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return (dealt.groupBy("host", "part").cogroup(copies.groupBy("host", "part"))
            .applyInPandas(run, "form_id long, host string, form string, slots array<int>"))


def _choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in batches:
        found = []
        for form, slots, held, chars, linked in zip(rows["form"], rows["slots"], rows["held"], rows["chars"], rows["linked"]):
            mass = {} if held is None else {s: (c, m) for s, c, m in zip(held, chars, linked)}
            slots = list(slots)
            found.append(kept_nodes(form_tree(form), len(slots), slots, mass))
        yield pd.DataFrame({"form_id": rows["form_id"], "host": rows["host"], "slots": rows["slots"], "keep": found})


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               support: int = 4, fan_in: int = 256) -> DataFrame:
    """(page_id, url, text) of every row: the blocks of the main text in page order, joined by two line feeds.

    Character references are decoded, white space inside a block becomes one space. A text that stands at one slot on at
    least half of a host's pages, and with at least ``support`` different articles, is template and goes. Pages count as
    one where their longest other block is the same. Pages without a host are aligned with each other. Null, empty and
    torn html, and plain text, are pages (without blocks, or with what can be read); every row is judged by itself,
    whatever its id; an empty table gives no rows. Blocks below 100 levels belong to the level above.
    """
    parsed = store(parse_pages(pages, id_col, url_col, html_col).withColumn("form_id", F.xxhash64("host", "form")), "pages")
    forms = store(parsed.groupBy("form_id", "host", "form").agg(F.count("*").alias("pages")), "forms")
    wrappers = store(induce(forms, fan_in), "wrappers")
    aligned = store(align(forms, wrappers), "slots")

    block = F.explode(F.arrays_zip("nodes", F.transform("texts", F.length).alias("chars"), "linked")).alias("b")
    sizes = (parsed.select("form_id", block).groupBy("form_id", F.col("b.nodes").alias("node"))
             .agg(F.sum("b.chars").alias("chars"), F.sum("b.linked").alias("linked")))
    mass = (sizes.join(aligned, "form_id").groupBy("host", F.get("slots", "node").alias("slot"))
            .agg(F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
            .groupBy("host").agg(F.collect_list("slot").alias("held"), F.collect_list("chars").alias("chars"),
                                 F.collect_list("linked").alias("linked")))
    chosen = store(aligned.join(mass, "host", "left").mapInPandas(
        _choose, "form_id long, host string, slots array<int>, keep array<boolean>"), "chosen")

    cells = F.transform(F.arrays_zip("nodes", "texts"), lambda b: F.struct(
        b["nodes"].alias("node"), F.length(b["texts"]).alias("chars"), F.xxhash64(b["texts"]).alias("hash")))
    content = (parsed.select("form_id", cells.alias("cells")).join(chosen, "form_id")
               .select("host", F.transform(F.filter("cells", lambda b: F.get(F.col("keep"), b["node"])), lambda b: F.struct(
                   F.get(F.col("slots"), b["node"]).alias("slot"), b["chars"].alias("chars"), b["hash"].alias("hash"))).alias("held")))

    def longest(blocks: Column) -> Column:
        return F.array_max(F.transform(blocks, lambda b: F.struct(b["chars"], b["hash"])))["hash"]

    topics = (content.withColumn("first", longest(F.col("held")))
              .withColumn("second", longest(F.filter("held", lambda b: b["hash"] != F.col("first"))))
              .select("host", "first", "second", F.explode(F.array_distinct(F.transform(
                  "held", lambda b: F.struct(b["slot"].alias("slot"), b["hash"].alias("hash"))))).alias("b"))
              .select("host", "b.slot", "b.hash", "first",
                      F.when(F.col("b.hash") == F.col("first"), F.col("second")).otherwise(F.col("first")).alias("topic")))
    shared = (topics.groupBy("host", "slot", "hash").agg(F.count_distinct("topic").alias("n"))
              .filter(F.col("n") >= support))
    whole = topics.groupBy("host", "slot").agg(F.count_distinct("first").alias("whole"))
    template = shared.join(whole, ["host", "slot"]).filter("2 * n >= whole").select("host", "slot", "hash")
    slots = aligned.select("form_id", "host", F.posexplode("slots").alias("node", "slot")).filter("slot >= 0")
    dropped = store(slots.join(template, ["host", "slot"]).groupBy("form_id")
                    .agg(F.collect_list(F.struct("node", "hash")).alias("dropped")), "template")

    decided = store(chosen.join(dropped, "form_id", "left").select("form_id", "keep", "dropped"), "decided")
    held = F.filter(F.arrays_zip("nodes", "texts"), lambda b: F.get(F.col("keep"), b["nodes"]) & ~F.coalesce(
        F.array_contains("dropped", F.struct(b["nodes"].alias("node"), F.xxhash64(b["texts"]).alias("hash"))), F.lit(False)))
    return parsed.join(decided, "form_id").select(
        "page_id", "url", F.array_join(F.transform(held, lambda b: b["texts"]), "\n\n").alias("text"))
