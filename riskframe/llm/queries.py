"""The registered queries of this subpackage and, where SQL can say it, their reference SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from riskframe.llm import byte_bpe, cross_align, fill_middle, ngram_join, packing, page_text, quality, secret_scan, token_counts, token_files, top_k, url_rules, vector_dedup
from riskframe.llm.url_rules import GlobRule, HostRule
from riskframe.plans.storage import fresh_path
from riskframe.sources.tables import table

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"
MULTI_BPE = "byte_bpe_multi_50k.tiktoken"

# The rules of the contract.
HOST_RULES = [
    HostRule("allow", "com", "/"),
    HostRule("block", "example.com", "/en/"),
    HostRule("allow", "www.example.com", "/en/"),
    HostRule("block", "net", "/es/"),
    HostRule("block", "net", "/fr/"),
]
#: What is judged beyond them: gambling hosts, programs for download, log-in pages.
GLOB_RULES = [GlobRule("block", "*casino-**"), GlobRule("block", "**.exe"), GlobRule("block", "**/login**")]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in windows of 2048 ids."""
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), end_id=1)
    return packed.drop("ids")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: the patterns' and those that the network adds."""
    docs = table(spark, sf_dir, "documents")
    spans = F.col("spans")

    def joined(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(spans, lambda s: s["kind"].isin(*secret_scan.KINDS))
    return secret_scan.scan(docs, secret_scan.learn(docs)).select(
        "doc_id", *map(count, secret_scan.KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(spans).alias("spans"))


def op3_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), HOST_RULES, GLOB_RULES)


OP3_SQL = r"""
with parts as (
  select page_id,
    case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
split as (
  select page_id, regexp_extract(rest, '^([^/?#]*)', 1) as raw_host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from parts),
named as (
  select page_id, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, path from split),
rules(verdict, host, path) as (
  values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
         ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits as (
  select n.page_id, n.host as h, n.path as p, r.host || r.path as rule, r.verdict,
    row_number() over (partition by n.page_id, n.host, n.path order by length(r.host || r.path) desc) as k
  from named n join rules r on (n.host = r.host or ends_with(n.host, '.' || r.host)) and starts_with(n.path, r.path)),
globs as (
  select *, case when ends_with(host || path, '.exe') then '**.exe' end as g1,
    case when contains(host, 'casino-') then '*casino-**' end as g2,
    case when contains(host || path, '/login') then '**/login**' end as g3 from named)
select g.page_id, g.host, g.path, f.rule,
  coalesce(f.verdict, case when coalesce(g1, g2, g3) is not null then 'block' else 'allow' end) as verdict,
  case when f.rule is null then coalesce(g2, g3, g1) end as glob
from globs g left join (select * from fits where k = 1) f on f.page_id = g.page_id and f.h = g.host and f.p = g.path"""


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every document's ids to packed files and digest what is read back."""
    folder = fresh_path(spark, "token-files")
    token_files.write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(BYTE_BPE),
                             vocabulary=50_257, end_id=0)
    return token_files.read_tokens(spark, folder).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best candidates of every fiftieth vector."""
    return top_k.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP5_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) as q from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as query_id, b.vec_id, list_inner_product(a.q, b.q)::BIGINT as score
  from v a join v b on a.vec_id % 50 = 0 and a.vec_id <> b.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::INTEGER as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5"""


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document and whether they are more than 2048."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), limit=2_048)


def op7_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of every vector at a cosine of 0.98."""
    return vector_dedup.dedup_vectors(table(spark, sf_dir, "embeddings"))


OP7_SQL = """
with recursive v as (
  select vec_id, label, embedding::DOUBLE[] as e from embeddings
  where embedding is not null and label is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.98),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a, min(b) as m from reach group by a),
degree as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(d.n, 0)::BIGINT as n_links, least(e.vec_id, coalesce(l.m, e.vec_id)) as component_id,
  e.vec_id = least(e.vec_id, coalesce(l.m, e.vec_id)) as kept
from embeddings e left join degree d on d.a = e.vec_id left join least l on l.a = e.vec_id"""


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity and decision for every document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_key")


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 3-word shingles have a Jaccard similarity of 0.9."""
    return ngram_join.ngram_jaccard(table(spark, sf_dir, "documents"), words=3, num=90, den=100)


OP9_SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
    lambda w: w <> '') as w from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) end as s
  from words),
sizes as (select doc_id, len(s)::BIGINT as n from sets),
shingles as (select doc_id, unnest(s) as g from sets),
common as (select x.doc_id as a, y.doc_id as b, count(*) as k from shingles x join shingles y
           on x.g = y.g and x.doc_id <> y.doc_id group by all),
links as (select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
          where 100 * k >= 90 * (p.n + q.n - k)),
reach(a, b) as (select a, b from links union select r.a, l.b from reach r join links l on l.a = r.b),
least as (select a, min(b) as m from reach group by a)
select s.doc_id, s.n as n_shingles, least(s.doc_id, coalesce(l.m, s.doc_id)) as component_id
from sizes s left join least l on l.a = s.doc_id"""


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every document, decode the ids, digest both."""
    ranks = public_tokenizers.path(MULTI_BPE)
    encoded = byte_bpe.encode_corpus(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    return byte_bpe.digest(encoded, ranks)


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut into prefix, middle and suffix, rearranged, and rebuilt from that."""
    made = fill_middle.restore(fill_middle.fill_in_middle(table(spark, sf_dir, "documents")))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


OP11_SQL = """
with hashed as (
  select doc_id, coalesce(text, '') as t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) as h from documents),
numbers as (
  select doc_id, t, length(t)::BIGINT as n, ('0x' || h[1:8])::BIGINT as h1, ('0x' || h[9:16])::BIGINT as h2,
    ('0x' || h[17:24])::BIGINT as h3, ('0x' || h[25:32])::BIGINT as h4 from hashed),
cuts as (
  select doc_id, t, n, least(h1 % (n + 1), h2 % (n + 1)) as lo, greatest(h1 % (n + 1), h2 % (n + 1)) as hi,
    case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain'
         when h4 % 100 < 20 then 'spm' else 'psm' end as form from numbers),
pieces as (
  select *, substring(t, 1, lo) as a, substring(t, lo + 1, hi - lo) as b, substring(t, hi + 1, n - hi) as c from cuts)
select doc_id, n, form, case when form <> 'plain' then lo end as prefix_chars,
  case when form <> 'plain' then hi - lo end as middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || a || '<S>' || c || '<M>' || b
         else '<S>' || c || '<P>' || a || '<M>' || b end) as output_sha256, sha256(t) as restored_sha256
from pieces"""


def op12_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return page_text.page_texts(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op13_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens, groups and links of every document under two tokenizers, with the corpus' counts of its pairs."""
    return cross_align.align_tokenizers(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE),
                                        public_tokenizers.path(PIECE_BPE))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_secret_scan": op2_secret_scan,
    "op3_url_rules": op3_url_rules,
    "op4_token_files": op4_token_files,
    "op5_top_k": op5_top_k,
    "op6_token_counts": op6_token_counts,
    "op7_vector_dedup": op7_vector_dedup,
    "op8_quality": op8_quality,
    "op9_ngram_join": op9_ngram_join,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_fill_middle": op11_fill_middle,
    "op12_page_text": op12_page_text,
    "op13_cross_align": op13_cross_align,
}
ORACLE = {"op3_url_rules": OP3_SQL, "op5_top_k": OP5_SQL, "op7_vector_dedup": OP7_SQL, "op9_ngram_join": OP9_SQL,
          "op11_fill_middle": OP11_SQL}
