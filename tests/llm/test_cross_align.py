"""Minimal perfect hashes, and the alignment of two tokenizers against a plain version of whole texts."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from riskframe.llm import cross_align, queries
from riskframe.llm.perfect_hash import PerfectHash

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "  a  b ", "one two, three.\nFour", "\n\n x \n", "tab\there", "a▁b with the piece sign", "don't we're 'S",
    "<|endoftext|> mid <s> </s> <unk> <0x41>", "漢字 かな 한글 العربية", "é é ́x ẞ Σς", "x²y ①②", "a b\x1cc", "\x00 nul",
    "same text here", "same text here", "a" * 300, "=" * 257, "word " * 300, "k3y=v4l_u-e/%%% ***", "🙂 🙃🙂", "the of and the of and",
]


class Plain:
    """Whole texts, token by token."""

    def __init__(self):
        self.a, self.b = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
        self.a.encode_special_tokens = True
        visible = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
        hidden = [c for c in range(256) if c not in visible]
        self.shown = {chr(c): c for c in visible} | {chr(256 + i): c for i, c in enumerate(hidden)}

    def groups(self, text):
        if not text:
            return []
        ids_a = self.a.encode(" " + text, add_special_tokens=False).ids
        ids_b = self.b.encode(text)
        bytes_a = [bytes(self.shown[c] for c in self.a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                   for i in ids_b for p in [self.b.id_to_piece(i)]]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            return []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            m, n = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            out.append((ids_a[i:m], ids_b[j:n]))
            i, j = m, n
        return out


def plain_rows(texts):
    plain = Plain()
    every = [plain.groups(t) for t in texts]
    counts = Counter(p for groups in every for p in {(a, b) for x, y in groups for a in x for b in y})
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    rows = []
    for groups in every:
        links = [(a, b) for x, y in groups for a in x for b in y]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        rows.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links),
                     sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(made, ids, texts):
    found = sorted(((r["doc_id"] is None, r["doc_id"] or 0), tuple(r[c] for c in COLUMNS)) for r in made)
    wanted = sorted(((i is None, i or 0), r) for i, r in zip(ids, plain_rows(texts)))
    assert found == wanted


@pytest.mark.parametrize("sizes", [dict(), dict(chunk_bytes=200, shard_pairs=40, fan_in=2)])
def test_matches_plain_version(spark, sizes):
    ids = [*range(len(TEXTS)), None, 3, 3]
    texts = [*TEXTS, "no id", "repeated row", "repeated row"]
    docs = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in zip(ids, texts)],
                                 "doc_id long, text string, chunk string, pairs int, shard int").repartition(3)
    check(cross_align.align_tokenizers(docs, A, B, **sizes).collect(), ids, texts)


def test_empty_table_and_texts_without_tokens(spark):
    kind = "doc_id long, text string"
    assert cross_align.align_tokenizers(spark.createDataFrame([], kind), A, B).count() == 0
    made = cross_align.align_tokenizers(spark.createDataFrame([(1, None), (2, "")], kind), A, B).collect()
    assert sorted(tuple(r) for r in made) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_query_matches_plain_version(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check(queries.op13_cross_align(spark, sf).collect(), [r[0] for r in rows], [r[1] for r in rows])


def test_groups_of_many_tokens_are_counted(monkeypatch):
    both = cross_align.tokenizers(A, B)
    usual = cross_align.align_parts(["漢字かな한글العربية", "plain"], both)
    monkeypatch.setattr(cross_align, "_BIG_GROUP", 1)
    monkeypatch.setattr(cross_align, "_BLOCK", 2)
    other = cross_align.align_parts(["漢字かな한글العربية", "plain"], both)
    assert usual.pairs.tolist() == other.pairs.tolist() and usual.written.to_pylist() == other.written.to_pylist() and usual.times.tolist() == other.times.tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab B.,'%1²é́ \n\t\x1c\xa0<s>|_漢▁", max_size=40))
def test_any_text_by_stretches(text):
    plain = test_any_text_by_stretches.__dict__.setdefault("plain", Plain())
    import pyarrow as pa
    chunk = cross_align.Chunk(pa.array([text]), cross_align.tokenizers(A, B))
    groups = plain.groups(text)
    assert bool(chunk.used[0]) == bool(groups)
    if groups:
        written = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        assert ";".join(chunk.aligned.written[c].as_py() for c in chunk.codes) == written


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab .é \n漢▁", max_size=12), max_size=8), st.sampled_from([1, 30, 1_000_000]))
def test_pair_counts_in_blocks(texts, block):
    import pyarrow as pa
    before, cross_align._BLOCK = cross_align._BLOCK, block
    try:
        pairs, counts = cross_align.Chunk(pa.array(texts, pa.string()), cross_align.tokenizers(A, B)).pair_counts()
    finally:
        cross_align._BLOCK = before
    plain = test_any_text_by_stretches.__dict__.setdefault("plain", Plain())
    width = cross_align.tokenizers(A, B).width
    wanted = Counter(p for t in texts for p in {a * width + b for x, y in plain.groups(t) for a in x for b in y})
    assert dict(zip(pairs.tolist(), counts.tolist())) == dict(wanted)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(-2 ** 62, 2 ** 62), max_size=200), st.sets(st.integers(-2 ** 62, 2 ** 62), max_size=50))
def test_perfect_hash_is_minimal_and_verifies(keys, others):
    index = PerfectHash(np.array(sorted(keys), np.int64))
    assert sorted(index(np.array(sorted(keys), np.int64)).tolist()) == list(range(len(keys)))
    foreign = np.array(sorted(others - keys), np.int64)
    assert (index(foreign) == -1).all()
