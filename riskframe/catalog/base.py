"""SQL text of the input bindings, shared by the reference queries (DuckDB dialect)."""

from __future__ import annotations

import textwrap


def hash_sql(salt: str, key: str = "id") -> str:
    """Twin of ``keyed_hash``; ``salt`` is SQL text when it starts with a quote or bracket."""
    return f"('0x'||substr(md5(concat('{salt}:',{key})),1,8))::BIGINT"


SURVEY = f"""
li as (select l_orderkey, count(*) as n_lines, sum(cast(round(l_quantity) as bigint))::BIGINT as qty_sum,
         sum(cast(round(l_discount*100) as bigint))::BIGINT as disc_sum from lineitem group by l_orderkey),
sv0 as (select o.o_orderkey as id, c.c_mktsegment as segment, o.o_orderpriority as priority,
         cast(substr(o.o_orderpriority,1,1) as int) as priority_ord, o.o_orderstatus as status,
         r.r_name as region_name, c.c_acctbal as acctbal, o.o_totalprice as totalprice,
         li.n_lines as n_lines, li.qty_sum as qty_sum, li.disc_sum as disc_sum
       from orders o join customer c on o.o_custkey=c.c_custkey
         join nation n on c.c_nationkey=n.n_nationkey join region r on n.n_regionkey=r.r_regionkey
         left join li on li.l_orderkey=o.o_orderkey),
sv1 as (select *, 0.9::DOUBLE*(priority_ord-3) + 0.02::DOUBLE*(coalesce(qty_sum,100)-100)
         - 0.0002::DOUBLE*acctbal + (case when status='F' then 0.8::DOUBLE else 0::DOUBLE end) as z0
       from sv0),
survey as (select *, cast(case when {hash_sql('y')}/4294967296::DOUBLE < 1::DOUBLE/(1::DOUBLE+exp(-z0))
         then 1 else 0 end as int) as y from sv1)"""

SCORED = SURVEY + f""",
sc0 as (select *, round(1::DOUBLE/(1::DOUBLE+exp(-(z0+2::DOUBLE*({hash_sql('a')}/4294967296::DOUBLE-0.5::DOUBLE)))),4) as score_a,
         round(1::DOUBLE/(1::DOUBLE+exp(-(z0+4::DOUBLE*({hash_sql('b')}/4294967296::DOUBLE-0.5::DOUBLE)))),4) as score_b
       from survey),
scored as (select *, cast(case when score_a>=0.5::DOUBLE then 1 else 0 end as int) as pred_a,
         cast(case when score_b>=0.5::DOUBLE then 1 else 0 end as int) as pred_b from sc0)"""

SAMPLED = SCORED + f""",
classes as (select y, count(*) as n_class, floor(round(0.2::DOUBLE*count(*),6)) as whole,
         round(0.2::DOUBLE*count(*),6) - floor(round(0.2::DOUBLE*count(*),6)) as rest from scored group by y),
tests as (select y as y_class, whole + case when row_number() over (order by rest desc, y)
         <= (select ceil(round(0.2::DOUBLE*sum(n_class),6)) - sum(whole) from classes) then 1 else 0 end as n_test from classes),
sampled as (select *,
         cast(floor((row_number() over (partition by y order by {hash_sql('fold')}, id)-1)*5.0::DOUBLE
              / count(*) over (partition by y)) as int) as fold,
         case when row_number() over (partition by y order by {hash_sql('split')}, id)
              <= n_test then 'test' else 'train' end as split
       from scored join tests on y=y_class)"""


def with_tables(ctes: str, sql: str) -> str:
    return "with " + ctes.strip() + "\n" + textwrap.dedent(sql).strip()


def survey(sql: str) -> str:
    return with_tables(SURVEY, sql)


def scored(sql: str) -> str:
    return with_tables(SCORED, sql)


def sampled(sql: str) -> str:
    return with_tables(SAMPLED, sql)


def chain(base: str, extra: str, sql: str) -> str:
    """``base`` bindings, then further named tables, then the final select."""
    return with_tables(base + ",\n" + textwrap.dedent(extra).strip(), sql)


def rate(num: str, den: str) -> str:
    return f"coalesce(({num})/nullif(({den})::DOUBLE,0),0)"


def rates(tp="tp", fp="fp", fn="fn", tn="tn") -> dict[str, str]:
    """SQL text of the metrics, from textbook definitions."""
    p1, r1 = rate(tp, f"{tp}+{fp}"), rate(tp, f"{tp}+{fn}")
    p0, r0 = rate(tn, f"{tn}+{fn}"), rate(tn, f"{tn}+{fp}")
    f1, f0 = rate(f"2*{tp}", f"2*{tp}+{fp}+{fn}"), rate(f"2*{tn}", f"2*{tn}+{fp}+{fn}")
    n = f"({tp}+{fp}+{fn}+{tn})"
    h1, h0 = f"(case when {tp}+{fp}+{fn}>0 then 1 else 0 end)", f"(case when {tn}+{fp}+{fn}>0 then 1 else 0 end)"

    def macro(a: str, b: str) -> str:
        return rate(f"{a}*{h0}+{b}*{h1}", f"{h0}+{h1}")

    return {"n": n, "prevalence": rate(f"{tp}+{fn}", n), "accuracy": rate(f"{tp}+{tn}", n),
            "f1_macro": macro(f0, f1), "precision_macro": macro(p0, p1), "recall_macro": macro(r0, r1),
            "precision_pos": p1, "recall_pos": r1, "f1_pos": f1, "precision_neg": p0, "recall_neg": r0,
            "f1_neg": f0, "sensitivity": r1, "specificity": r0}


def counts(y: str = "y", pred: str = "pred_a") -> str:
    return (f"count(*) filter (where {y}=1 and {pred}=1) as tp, count(*) filter (where {y}=0 and {pred}=1) as fp, "
            f"count(*) filter (where {y}=1 and {pred}=0) as fn, count(*) filter (where {y}=0 and {pred}=0) as tn")


def metric_list(names: list[str], digits: int = 6) -> str:
    r = rates()
    return ", ".join(f"{r[n]} as {n}" if n == "n" else f"round({r[n]},{digits}) as {n}" for n in names)
