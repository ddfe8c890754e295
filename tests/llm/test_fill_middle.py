"""Fill-in-middle against a plain version, on awkward texts."""

import hashlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from riskframe.llm import fill_middle, queries

TEXTS = [None, "", "a", " ", "one two three four " * 20, "漢字かな🙂é é", "<P> inside", "x<S", "y<S>z", "<M>", "<",
         "<<P", "\n\n line\r\n", "same", "same", "\x00\x01", "long " * 40_000]


def plain_version(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = text[:low], text[low:high], text[high:]
    if h4 % 100 < 20:
        return n, "spm", low, high - low, f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", low, high - low, f"<P>{a}<S>{c}<M>{b}"


def test_matches_plain_version_and_restores(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], "x", "y", 1) for i in range(10 * len(TEXTS))] + [(None, "no id", "x", "y", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, output string, h1 long").repartition(3)
    made = fill_middle.restore(fill_middle.fill_in_middle(docs, slice_bytes=500)).collect()
    assert len(made) == len(rows)
    forms = set()
    for r in made:
        text = "no id" if r["doc_id"] is None else TEXTS[r["doc_id"] % len(TEXTS)]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) == plain_version(r["doc_id"], text)
        assert r["restored"] == (text or "")
        forms.add(r["form"])
    assert forms == {"plain", "psm", "spm"}


def test_empty_table_gives_no_rows(spark):
    made = fill_middle.restore(fill_middle.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")))
    assert made.count() == 0 and made.columns[-1] == "restored"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="a<PSM>é漢🙂\n", max_size=12), max_size=6), st.integers(0, 12), st.integers(0, 12))
def test_pieces_of_any_texts(texts, x, y):
    lists = fill_middle.code_points(pa.array(["skipped", *texts], pa.string()).slice(1))
    assert lists.to_pylist() == [list(t) for t in texts]
    n = np.array([len(t) for t in texts], np.int64)
    low, high = np.minimum(n, min(x, y)), np.minimum(n, max(x, y))
    pieces = [p.to_pylist() for p in fill_middle.cut_pieces(lists, low, high)]
    assert [list(p) for p in zip(*pieces)] == [[t[:a], t[a:b], t[b:]] for t, a, b in zip(texts, low, high)]


def test_query_covers_every_document(spark, sf):
    found = queries.op11_fill_middle(spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert found.count() == docs.count()
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
