"""Encoding, packing, token files, counts and BPE against the libraries, on awkward texts."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from riskframe.llm import byte_bpe, merges, packing, queries, token_counts, token_files
from riskframe.llm.tokens import library_encoder

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

TEXTS = [
    None, "", " ", "  a  b ", "one two, three.\nFour", "\n\n x \n", "tab\there", "a b c\x1cd", "don't we're 'S",
    "<|endoftext|> mid <|endoftext|>x", "<|startoftext|>Ab CD", "漢字 かな 한글 العربية", "é e\u0301 \u0301x ẞ Σς", "x²y ①②",
    "same text", "same text", "a" * 300, "=" * 257, "word " * 3_000, "k3y=v4l_u-e/%%% ***", "🙂 🙃🙂",
]
KIND = "doc_id long, text string, start string, ids string, chunk string, codes string"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", "y", "z", "w") for i, t in enumerate(TEXTS)] + [(None, "no id", "x", "y", "z", "w")]
    return spark.createDataFrame(rows, KIND).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], KIND)


def as_dict(rows, key="doc_id"):
    return {r[key]: r for r in rows}


def expected(path):
    tokenizer = Tokenizer.from_file(path)
    return {**{i: tokenizer.encode(t or "", add_special_tokens=False).ids for i, t in enumerate(TEXTS)},
            None: tokenizer.encode("no id", add_special_tokens=False).ids}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab B.,'%1²é\u0301 \n\t\x1c\xa0<|endoftext|>", max_size=30), min_size=1, max_size=8))
def test_stretches_encode_like_whole_texts(texts):
    ids, offsets = library_encoder(BYTE)(pa.array(texts))
    whole = Tokenizer.from_file(BYTE) if not hasattr(test_stretches_encode_like_whole_texts, "t") else None
    whole = whole or test_stretches_encode_like_whole_texts.t
    test_stretches_encode_like_whole_texts.t = whole
    for row, text in enumerate(texts):
        assert ids[offsets[row]:offsets[row + 1]].tolist() == whole.encode(text, add_special_tokens=False).ids


def test_encoder_forgets_and_still_agrees():
    encoder = library_encoder(BYTE)
    small = type(encoder)(encoder.encode_many, most=3)
    texts = pa.array(["a b c d e f", "a b c, d", "g h i j"])
    assert [x.tolist() for x in small(texts)] == [x.tolist() for x in encoder(texts)]
    assert [x.tolist() for x in small(texts)] == [x.tolist() for x in encoder(texts)]


@pytest.mark.parametrize("bits", [1, 5, 8, 11, 16, 17, 32])
def test_bits_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 2 ** bits, 1_003, dtype=np.uint64).astype(np.uint32)
    packed = token_files.pack_bits(ids, bits)
    assert len(packed) == -(-1_003 * bits // 8)
    assert token_files.unpack_bits(packed, bits, 1_003).tolist() == ids.tolist()
    spread = ((ids.astype(np.uint64)[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
    assert packed == np.packbits(spread.ravel(), bitorder="little").tobytes()


@pytest.mark.parametrize("bits, block", [(11, 8), (11, 7), (16, 16)])
def test_file_random_access(bits, block):
    ids = np.random.default_rng(1).integers(0, 2 ** bits, 100, dtype=np.uint32)
    file = token_files.TokenFile(token_files.make_file([3, None, 9], ids, np.array([0, 10, 10, 100]), bits, block))
    assert [(d, s, len(i)) for d, s, i in file.documents()] == [(3, 0, 10), (None, 10, 0), (9, 10, 90)]
    for start, stop in [(0, 0), (0, 1), (5, 29), (63, 100), (99, 100)]:
        assert file.ids(start, stop).tolist() == ids[start:stop].tolist()
    with pytest.raises(ValueError):
        token_files.make_file([1], np.array([2 ** bits]), np.array([0, 1]), bits, block)


def test_token_files(spark, docs, empty, tmp_path):
    token_files.write_tokens(docs, str(tmp_path / "a"), BYTE, 50_257, 0, file_ids=500, block_ids=64)
    got = token_files.read_tokens(spark, str(tmp_path / "a")).collect()
    want, start = expected(BYTE), 0
    assert len(got) == len(TEXTS) + 1
    by_id = as_dict(got)
    for doc in [None, *range(len(TEXTS))]:  # a missing id comes first
        ids = want[doc] + [0]
        assert np.frombuffer(by_id[doc]["ids"], "<u4").tolist() == ids and by_id[doc]["start"] == start
        start += len(ids)
    token_files.write_tokens(empty, str(tmp_path / "b"), BYTE, 50_257, 0)
    assert token_files.read_tokens(spark, str(tmp_path / "b")).count() == 0


def test_packing(spark, docs, empty):
    packed = packing.pack_documents(docs, BYTE, end_id=1, window=64, open_windows=4, shortest=4, with_ids=True)
    pieces = packed.toPandas()
    want = expected(BYTE)
    pieces["doc"] = pieces["doc_id"].astype("float").fillna(-1)
    assert set(pieces["doc"]) == {-1.0, *map(float, range(len(TEXTS)))}
    for doc, own in pieces.sort_values("start").groupby("doc"):
        ids = want[None if doc < 0 else int(doc)] + [1]
        joined = np.concatenate([np.frombuffer(b, "<u4") for b in own["ids"]])
        assert joined.tolist() == ids and own["start"].tolist() == [0, *own["length"].cumsum().tolist()[:-1]]
        assert (own["doc_tokens"] == len(ids)).all()
    assert all(zlib.crc32(b) == c and len(b) == 4 * n for b, c, n in zip(pieces["ids"], pieces["ids_crc32"], pieces["length"]))
    fills = []
    for _, window in pieces.sort_values("offset").groupby("sequence_id"):
        assert window["offset"].tolist() == [0, *window["length"].cumsum().tolist()[:-1]]
        fills.append(int(window["length"].sum()))
    assert max(fills) <= 64 and sum(fills) / (64 * len(fills)) > 0.95
    assert packing.pack_documents(empty, BYTE, end_id=1).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 200), max_size=60), st.integers(1, 5), st.integers(1, 20))
def test_packer_keeps_every_id(sizes, open_windows, shortest):
    packer, closed, at = packing.Packer(50, open_windows, shortest), [], 0
    for doc, size in enumerate(sizes):
        closed += packer.place(packing.Piece(doc, 0, np.arange(at, at + size), size))
        at += size
        assert len(packer.fills) <= open_windows
        assert {n: sum(len(p.ids) for p in w) for n, w in packer.held.items()} == {n: f for f, n in packer.fills}
    windows = closed + packing.pour(packer.left(), 50)
    assert sorted(i for w in windows for p in w for i in p.ids.tolist()) == list(range(at))
    assert all(0 < sum(len(p.ids) for p in w) <= 50 for w in windows)


def test_token_counts(docs, empty):
    got, want = as_dict(token_counts.count_tokens(docs, WORD, 100, chunk_bytes=200).collect()), expected(WORD)
    assert len(got) == len(TEXTS) + 1
    for doc, ids in want.items():
        text = "no id" if doc is None else TEXTS[doc] or ""
        assert (got[doc]["n_tokens"], got[doc]["n_bytes"]) == (len(ids), len(text.encode())), text[:40]
        assert got[doc]["over_limit"] == (len(ids) > 100)
    assert token_counts.count_tokens(empty, WORD, 100).count() == 0


def test_byte_bpe(docs, empty):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = byte_bpe.encode_corpus(docs, RANKS, public_tokenizers.PATTERN, slice_bytes=200)
    rows = as_dict(byte_bpe.decode_corpus(encoded, RANKS).collect())
    digests = as_dict(byte_bpe.digest(encoded, RANKS).collect())
    assert len(rows) == len(TEXTS) + 1
    for doc in rows:
        text = "no id" if doc is None else TEXTS[doc] or ""
        ids = library.encode_ordinary(text)
        assert np.frombuffer(rows[doc]["ids"], "<u4").tolist() == ids, text[:40]
        assert bytes(rows[doc]["decoded"]) == text.encode()
        assert digests[doc]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert byte_bpe.encode_corpus(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def one_by_one(word, ranks):
    """The textbook loop: merge the leftmost pair of the lowest rank."""
    if word in ranks:
        return [ranks[word]]
    parts = [word[i:i + 1] for i in range(len(word))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 + 97 for x in b)), max_size=8),
       st.permutations([bytes([a, b]) for a in b"abc" for b in b"abc"] + [b"aab", b"abc", b"bca", b"aaaa", b"abab", b"cabc"]))
def test_replay_with_any_order_of_merges(words, order):
    """Vocabularies no training would give, where a merge makes pairs that rank before it."""
    ranks = {bytes([b]): b for b in range(256)} | {token: 256 + i for i, token in enumerate(order)}
    got = merges.replay(words, merges.MergeTable(ranks))
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [one_by_one(w, ranks) if w else [] for w in words]


def test_registered_queries_agree_with_the_libraries(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    byte, word = Tokenizer.from_file(BYTE), Tokenizer.from_file(WORD)
    counts, files = as_dict(queries.op6_token_counts(spark, sf).collect()), as_dict(queries.op4_token_files(spark, sf).collect())
    start = 0
    for doc, text in docs:
        assert counts[doc]["n_tokens"] == len(word.encode(text or "", add_special_tokens=False).ids)
        ids = byte.encode(text or "", add_special_tokens=False).ids + [0]
        assert (files[doc]["start"], files[doc]["n_tokens"]) == (start, len(ids))
        assert files[doc]["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    packed = queries.op1_packing(spark, sf).toPandas()
    assert packed["length"].sum() == start and packed["sequence_id"].nunique() <= start / 2_048 + 2


def test_packing_in_the_pipeline_bounds_what_a_worker_keeps(docs, monkeypatch):
    """A bound on kept stretches changes no id, and the pipeline asks for a lower one than the operator's default."""
    import corpus_pipeline

    small = library_encoder(BYTE, 5)
    texts = pa.array([t or "" for t in TEXTS])
    for got, plain in zip(small(texts), library_encoder(BYTE)(texts)):
        assert np.array_equal(got, plain)
    assert small is not library_encoder(BYTE) and small.most == 5 and library_encoder(BYTE).most == 800_000
    asked = {}
    monkeypatch.setattr(packing, "pack_documents", lambda docs, *a, **more: asked.update(more) or docs.withColumn("ids", docs[docs.columns[0]]))
    corpus_pipeline.packed_documents(docs.sparkSession, docs, "")
    assert asked["stretches"] < 800_000
