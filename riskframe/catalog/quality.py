"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.catalog.base import SURVEY, chain, survey
from riskframe.operators import quality as dq
from riskframe.plans.bindings import doc_labels, order_survey
from riskframe.plans.storage import store
from riskframe.sources.tables import table

PROFILED = ["segment", "status", "priority_ord", "acctbal", "totalprice", "n_lines", "qty_sum"]
NULLABLE = ["segment", "acctbal", "n_lines", "qty_sum", "disc_sum", "y"]
NEAR_CONSTANT = ["status", "priority", "n_lines", "has_lines", "absent_column"]


def dq_profile(spark, sf):
    return dq.column_profile(store(order_survey(spark, sf).select(*PROFILED), "survey"), PROFILED)


def dq_shape(spark, sf):
    shape = dq.table_shape(table(spark, sf, "lineitem"))
    return shape.select("rows", "columns", (F.col("bytes") > 0).alias("on_disk"))


def dq_missing(spark, sf):
    return dq.missing_report(order_survey(spark, sf), NULLABLE)


def dq_dropna(spark, sf):
    return dq.drop_missing(order_survey(spark, sf), ["qty_sum"]).select("id", "segment", "qty_sum")


def dq_dedup(spark, sf):
    return dq.drop_duplicates(table(spark, sf, "documents"), ["text"], "doc_id").select("doc_id", "lang", "n_chars")


def dq_dup_report(spark, sf):
    return dq.duplicate_report(table(spark, sf, "documents"), ["text"], "doc_id")


def dq_invalid_value(spark, sf):
    return dq.drop_invalid(order_survey(spark, sf), "n_lines", 1).select("id", "n_lines")


def dq_iqr_outliers(spark, sf):
    return dq.iqr_outliers(table(spark, sf, "events"), ["value"])


def dq_range_filter(spark, sf):
    return dq.in_range(order_survey(spark, sf), "qty_sum", high=200).select("id", "qty_sum")


def dq_flag(spark, sf):
    flagged = dq.flag_rows(order_survey(spark, sf), {
        "negative_balance": F.col("acctbal") < 0, "no_discount": F.col("disc_sum") == 0})
    return flagged.groupBy("negative_balance", "no_discount").agg(F.count(F.lit(1)).alias("n"))


def dq_rare_category(spark, sf):
    df = order_survey(spark, sf).withColumn("size", F.when(F.col("n_lines") <= 8, F.col("n_lines").cast("string")))
    df = store(df.select("id", "status", "size"), "survey")
    return dq.drop_rare(df, ["status", "size"], 0.1).select("id", "status", "size")


def dq_named_category(spark, sf):
    return dq.drop_values(order_survey(spark, sf), {
        "status": ["P"], "segment": ["MACHINERY"]}).select("id", "status", "segment")


def dq_near_zero_variance(spark, sf):
    df = order_survey(spark, sf).withColumn("has_lines", F.col("n_lines").isNotNull())
    return dq.near_zero_variance(df, NEAR_CONSTANT)


def dq_class_balance(spark, sf):
    return dq.class_balance(order_survey(spark, sf), "y")


def ledger_rules():
    return [
        dq.Rule("missing quantity", F.col("qty_sum").isNull()),
        dq.Rule("single line", dq.invalid(F.col("n_lines"), 1)),
        dq.Rule("balance above 9500", F.col("acctbal") > 9500),
        dq.Rule("no discount", F.col("disc_sum") == 0, flag_only=True),
        dq.Rule("status P or machinery", F.col("status").eqNullSafe("P") | F.col("segment").eqNullSafe("MACHINERY")),
    ]


def dq_rule_ledger(spark, sf):
    return dq.rule_ledger(order_survey(spark, sf), ledger_rules())


def dq_clean_rows(spark, sf):
    return dq.apply_rules(order_survey(spark, sf), ledger_rules()).select("id", "segment", "status", "qty_sum")


def dq_null_patterns(spark, sf):
    return dq.null_patterns(order_survey(spark, sf), NULLABLE)


def dq_null_corr(spark, sf):
    df = (doc_labels(spark, sf)
          .withColumn("short_text", F.when(F.col("n_chars") < 500, F.col("n_chars"))))
    return dq.null_correlation(df, ["lang", "quality", "toxic", "short_text"])


QUERIES = {f.__name__: f for f in (
    dq_profile, dq_shape, dq_missing, dq_dropna, dq_dedup, dq_dup_report, dq_invalid_value, dq_iqr_outliers,
    dq_range_filter, dq_flag, dq_rare_category, dq_named_category, dq_near_zero_variance, dq_class_balance,
    dq_rule_ledger, dq_clean_rows, dq_null_patterns, dq_null_corr)}

_TYPES = {"segment": "string", "status": "string", "priority_ord": "int", "acctbal": "double",
          "totalprice": "double", "n_lines": "bigint", "qty_sum": "bigint"}


def _profile_row(c: str) -> str:
    stats = (f"min({c})::DOUBLE as \"min\", max({c})::DOUBLE as \"max\", round(avg({c}::DOUBLE),6) as \"mean\""
             if _TYPES[c] != "string" else
             "null::DOUBLE as \"min\", null::DOUBLE as \"max\", null::DOUBLE as \"mean\"")
    return (f"select '{c}' as \"column\", '{_TYPES[c]}' as dtype, count(*) as \"rows\", count({c}) as non_null, "
            f"count(distinct {c}) as \"distinct\", {stats} from survey")


_LEDGER = """
steps as (select *, qty_sum is null as r1, coalesce(n_lines=1,false) as r2, acctbal>9500 as r3,
    coalesce(disc_sum=0,false) as r4, status='P' or segment='MACHINERY' as r5 from survey)"""


def _ledger_row(i: int, name: str, flag: bool = False) -> str:
    earlier = " and ".join(f"not r{j}" for j in range(1, i) if j != 4) or "true"
    hits = f"count(*) filter (where {earlier} and r{i})"
    before = f"count(*) filter (where {earlier})"
    dropped, flagged = ("0::BIGINT", hits) if flag else (hits, "0::BIGINT")
    return (f"select {i}::INTEGER as step, '{name}' as rule, {before} as rows_before, {dropped} as dropped, "
            f"{flagged} as flagged, {before} - {dropped} as rows_after from steps")


ORACLE = {
    "dq_shape": """select count(*) as "rows", (select count(*)::INT from (describe lineitem)) as columns, true as on_disk from lineitem""",
    "dq_profile": survey(" union all ".join(_profile_row(c) for c in PROFILED)),
    "dq_missing": survey("select * from (" + " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where {c} is null) as missing_count, "
        f"round(count(*) filter (where {c} is null)*100.0::DOUBLE/count(*),2) as missing_pct from survey"
        for c in NULLABLE) + ") where missing_count>0"),
    "dq_dropna": survey("select id, segment, qty_sum from survey where qty_sum is not null"),
    "dq_dedup": """select doc_id, lang, n_chars from (
        select *, row_number() over (partition by text order by doc_id) as rn from documents) where rn=1""",
    "dq_dup_report": """select count(*) as "rows", count(distinct text) as distinct_rows,
        count(*)-count(distinct text) as duplicates from documents""",
    "dq_invalid_value": survey("select id, n_lines from survey where n_lines is distinct from 1"),
    "dq_iqr_outliers": """
        with q as (select count(value) as n, quantile_cont(value,0.25) as a, quantile_cont(value,0.75) as b from events)
        select 'value' as "column", n, round(a,6) as q1, round(b,6) as q3, round(a-1.5::DOUBLE*(b-a),6) as fence_low,
          round(b+1.5::DOUBLE*(b-a),6) as fence_high,
          (select count(*) from events where value<a-1.5::DOUBLE*(b-a) or value>b+1.5::DOUBLE*(b-a)) as outliers from q""",
    "dq_range_filter": survey("select id, qty_sum from survey where qty_sum<=200"),
    "dq_flag": survey("""select acctbal<0 as negative_balance, coalesce(disc_sum=0,false) as no_discount,
        count(*) as n from survey group by 1,2"""),
    "dq_rare_category": chain(SURVEY, """
        sized as (select *, case when n_lines<=8 then n_lines::VARCHAR end as size from survey)""", """
        select id, status, size from sized
        where status in (select status from sized group by status having count(*) >= 0.1*(select count(status) from sized))
          and (size is null or size in (select size from sized group by size having count(*) >= 0.1*(select count(size) from sized)))"""),
    "dq_named_category": survey("select id, status, segment from survey where status<>'P' and segment<>'MACHINERY'"),
    "dq_near_zero_variance": survey(" union all ".join(
        f"select '{c}' as \"column\", round(max(n)/sum(n)::DOUBLE,6) as top_share, max(n)/sum(n)::DOUBLE > 0.95 as flagged "
        f"from (select {e} as v, count(*) as n from survey where {e} is not null group by 1)"
        for c, e in (("status", "status"), ("priority", "priority"), ("n_lines", "n_lines"),
                     ("has_lines", "(n_lines is not null)")))),
    "dq_class_balance": survey("""select y as class, count(*) as n,
        round(count(*)*100.0::DOUBLE/(select count(*) from survey),2) as pct from survey group by y"""),
    "dq_rule_ledger": chain(SURVEY, _LEDGER, " union all ".join([
        _ledger_row(1, "missing quantity"), _ledger_row(2, "single line"), _ledger_row(3, "balance above 9500"),
        _ledger_row(4, "no discount", flag=True), _ledger_row(5, "status P or machinery")])),
    "dq_clean_rows": chain(SURVEY, _LEDGER, """select id, segment, status, qty_sum from steps
        where not (r1 or r2 or r3 or r5)"""),
    "dq_null_patterns": survey("select " + "||".join(
        f"(case when {c} is null then '1' else '0' end)" for c in NULLABLE) + " as pattern, count(*) as n from survey group by 1"),
    "dq_null_corr": """
        with d as (select (quality is null)::INT::DOUBLE as quality, (toxic is null)::INT::DOUBLE as toxic,
            (n_chars>=500)::INT::DOUBLE as short_text from documents left join labels using (doc_id))
        select 'quality' as a, 'toxic' as b, round(corr(quality,toxic),6) as r from d
        union all select 'quality', 'short_text', null from d where false
        union all select 'quality', 'short_text', round(corr(quality,short_text),6) from d
        union all select 'short_text', 'toxic', round(corr(toxic,short_text),6) from d""",
}
