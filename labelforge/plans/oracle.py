"""Independent DuckDB SQL for the query catalogue (same column names as the Spark side).

Of ML fits SQL states what is certain: rows per split, known classes, a floor of accuracy,
equal predictions after loading, the threshold of a tree of one split.
"""

from __future__ import annotations

TREE = ("(select cast(r_regionkey as bigint) id, cast(-1 as bigint) pid, r_name as name, "
        "4 as level from region union all select cast(100+n_nationkey as bigint), "
        "cast(n_regionkey as bigint), n_name, 5 from nation)")

SEG_VALUES = ("(values ('BUILDING','builder'),('FURNITURE','home'),('HOUSEHOLD','home2'),"
              "('MACHINERY','industry')) r(rule,name)")
SEG_VALUES_S = SEG_VALUES.replace(" r(rule,name)", " s(rule,name)")
SEG = (f'(select c_custkey as "userId", r.name as segment from customer join {SEG_VALUES} '
       "on c_mktsegment=r.rule)")


def _acct(values: str) -> str:
    return (f'(select c_custkey as "userId", r.name as acct from customer join (values {values}) '
            "r(name,s,e) on c_acctbal>r.s and c_acctbal<=r.e)")


ACCT = _acct("('debt',-1000.0,0.0),('mid',0.0,5000.0),('rich',5000.0,10000.0)")
ACCT_NEW = _acct("('mid',0.0,5000.0),('rich',5000.0,10000.0)")

MODE = ("(select o_custkey, o_orderpriority, row_number() over(partition by o_custkey "
        "order by count(*) desc, o_orderpriority) rn from orders group by 1,2)")

CYCLE = ('select "userId", r.name as cycle from (select o_custkey as "userId", '
         "date_diff('day', max(o_orderdate), timestamp '2001-08-02') d from orders group by 1) "
         "join (values ('d0-30',0,30),('d31-90',31,90),('d91-180',91,180)) r(name,s,e) "
         "on d between r.s and r.e")

PRIO_EMPTIED = "case when o_orderstatus='P' then '' else o_orderpriority end"

MERGED = (f'(select coalesce(a."userId",b."userId") as "userId", segment, acct from {SEG} a '
          f'full join {ACCT} b on a."userId"=b."userId")')

_CORR = {"qty": "l_quantity", "price": "l_extendedprice", "disc": "l_discount", "tax": "l_tax"}
CORR = " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({ca},{cb}),6) as r from lineitem"
    for a, ca in _CORR.items() for b, cb in _CORR.items())

_SUMMARY_COLS = ["l_quantity", "l_extendedprice", "l_discount"]
SUMMARY = " union all ".join(
    f"""select '{c}' as "column", count({c}) as "count", round(avg({c}),6) as mean, """
    f"""round(stddev_samp({c}),6) as stddev, min({c}) as "min", max({c}) as "max" from lineitem"""
    for c in _SUMMARY_COLS)

_SCALES = {
    "s1": (1.0, 1.0, 0.8, 0.7, 0.6, 0.5, 0.2, 0.2, 0.2, 0.2),
    "s2": (1.0, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.4, 0.4, 0.4),
    "s3": (1.0, 0.8, 0.8, 0.7, 0.5, 0.5, 0.3, 0.3, 0.3, 0.1),
}
_LETTERS = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC", "CC", "C", "D")
_LETTER_OF = ("case cast(l_quantity as bigint) % 11 " + " ".join(
    f"when {i} then '{x}'" for i, x in enumerate(_LETTERS)) + " end")
RATING = ("select l_orderkey, l_linenumber, rating, " + ", ".join(
    f"10.0::double * case rating " + " ".join(
        f"when '{x}' then {v}::double" for x, v in zip(_LETTERS, vals)) + f" end as {name}"
    for name, vals in _SCALES.items()) + f" from (select *, {_LETTER_OF} as rating from lineitem)")

def _pick(key: str, n: int) -> str:
    """First 32 bits of the MD5 of the key's text, modulo n."""
    return f"(('0x' || substr(md5(cast({key} as varchar)), 1, 8))::bigint % {n})"


_PAY = ("case when o_orderpriority in ('alipay','wxpay','chinapay','cod') then o_orderpriority "
        f"else case {_pick('o_orderkey', 4)} when 0 then 'alipay' when 1 then 'wxpay' when 2 then 'chinapay' "
        "else 'cod' end end")
ORDER_CLEANUP = (
    "select o_orderkey, case when o_custkey>=950 then " + _pick("o_orderkey", 950) + "+1 else o_custkey end "
    f"as member, {_PAY} as pay_code, case {_PAY} when 'alipay' then '支付宝' when 'wxpay' then "
    "'微信支付' when 'chinapay' then '银联支付' when 'cod' then '货到付款' end as pay_name, "
    "cast(epoch(date_trunc('day',o_orderdate)+interval 350 day) as bigint) as ft from orders")

TAG_PATHS = (
    "with r as (select distinct r_name from region), "
    "l1 as (select cast(row_number() over (order by r_name) as bigint) id, cast(-1 as bigint) pid, "
    "1 as level, r_name as name from r), "
    "p as (select distinct l1.id pid, n_name from nation join region on n_regionkey=r_regionkey "
    "join l1 on l1.name=r_name), "
    "l2 as (select cast((select max(id) from l1) + row_number() over (order by pid, n_name) "
    "as bigint) id, pid, 2 as level, n_name as name from p) "
    "select * from l1 union all select * from l2")

SCORE_LETTER = ("select l_orderkey, l_linenumber, case " + " ".join(
    f"when abs(l_quantity-{k})<0.1 then '{x}'" for k, x in
    [(10, "AAA"), (9, "AA"), (8, "A"), (7, "BBB"), (6, "BB"), (5, "B"), (4, "CCC")])
    + " else '' end as letter from lineitem")

MODE_S = ("(select cast(o_custkey as varchar) as \"userId\", o_orderpriority, row_number() "
          "over(partition by cast(o_custkey as varchar) order by count(*) desc, o_orderpriority) "
          "rn from orders group by 1,2)")
MODEL_MODE = (f'select m."userId", r.name as payment from {MODE_S} m join (values '
              "('1-URGENT','urgent'),('2-HIGH','high'),('5-LOW','low')) r(rule,name) "
              "on m.o_orderpriority=r.rule where rn=1")
MODEL_CYCLE = ('select "userId", r.name as cycle from (select cast(o_custkey as varchar) as '
               "\"userId\", date_diff('day', max(o_orderdate), timestamp '2001-08-02') d from "
               "orders group by 1) join (values ('d0-30',0,30),('d31-90',31,90),"
               "('d91-180',91,180)) r(name,s,e) on d between r.s and r.e")
_RATIO = {"l_quantity": "l_quantity", "l_extendedprice": "l_extendedprice",
          "l_discount": "l_discount", "l_tax": "l_tax",
          "score": "10.0::double * case rating " + " ".join(
              f"when '{x}' then {v}::double" for x, v in zip(
                  _LETTERS, (1.0, 1.0, 0.8, 0.7, 0.6, 0.5, 0.2, 0.2, 0.2, 0.2))) + " end"}
RATIO_CORR = " union all ".join(
    f"select '{a}' as a, '{b}' as b, round(corr({ca},{cb}),6) as r from "
    f"(select *, {_LETTER_OF} as rating from lineitem)"
    for a, ca in _RATIO.items() for b, cb in _RATIO.items())

_SPLIT80 = f"case when {_pick('vec_id', 100)}<80 then 'train' else 'test' end"
# 25 columns as the query derives them
_WIDE = {"qty": "l_quantity", "price": "l_extendedprice", "disc": "l_discount", "tax": "l_tax"} | {
    f"m{k}": f"nullif((l_orderkey * {k + 3} + l_partkey * {k % 5 + 1} + l_linenumber) % {k + 7}, {k % 4})"
    for k in range(21)}
WIDE = ("with w as (select " + ", ".join(f"{e} as {n}" for n, e in _WIDE.items()) + " from lineitem), c as (select "
        + ", ".join(f"corr({a},{b}) as {a}__{b}" for a in _WIDE for b in _WIDE) + " from w), u as (unpivot c on "
        "columns(*) into name k value r) select split_part(k,'__',1) as a, split_part(k,'__',2) as b, "
        "round(r,6) as r from u")

ORACLE = {
    "tag_rules_for": f"select id,name,level from {TREE} where id=2 union "
                     f"select id,name,level from {TREE} where pid=2",
    "tag_children": f"select id,pid,name,level from {TREE} where pid=3",
    "tag_model_left_join": f"select t.id,t.name,m.cnt from {TREE} t left join "
                           "(select cast(100+c_nationkey as bigint) id, count(*) cnt from customer "
                           "group by 1) m on t.id=m.id",
    "tag_insert_if_absent": f"select name,level,pid from {TREE} union all select n.name,n.level,"
                            "n.pid from (values ('CHINA_X',5,cast(2 as bigint)),"
                            "('AFRICA',4,cast(-1 as bigint))) n(name,level,pid) where not exists "
                            f"(select 1 from {TREE} o where o.name=n.name and o.level=n.level "
                            "and o.pid=n.pid)",
    "rule_kv_parse": "select event_id, event_type as kind, cast(user_id as varchar) as usr "
                     "from events",
    "wide_read_union_schema": "select cast(o_orderkey as varchar) id, case when o_orderstatus = 'F' then 'F' end st, "
        "case o_orderstatus when 'O' then cast(o_custkey as varchar) when 'P' then 'c' || o_custkey end cust "
        "from orders where o_orderkey <> 1",
    "wide_read_conditions": "select cast(o_orderkey as varchar) id, o_orderstatus st from orders "
                            "where strftime(o_orderdate,'%Y-%m-%d')>='1997-01-01' and "
                            "strftime(o_orderdate,'%Y-%m-%d')<='1997-03-31' and o_orderstatus<>'F'",
    "wide_read_relative_window": "select cast(o_orderkey as varchar) id from orders where "
                                 "strftime(o_orderdate,'%Y-%m-%d') between '2001-07-01' and "
                                 "'2001-07-31'",
    "rule_match_inner": f"select * from {SEG}",
    "rule_match_lookup": 'select c_custkey as "userId", coalesce(r.name,\'other\') as segment '
                         f"from customer left join {SEG_VALUES} on c_mktsegment=r.rule",
    "copy_tag": 'select c_custkey as "userId", c_name as name from customer',
    "range_tag_inclusive": 'select o_orderkey as "userId", r.name as era from orders join '
                           "(values ('y95',19950101,19951231),('y96-97',19960101,19971231),"
                           "('y98-01',19980101,20011231)) r(name,s,e) on "
                           "cast(strftime(o_orderdate,'%Y%m%d') as int) between r.s and r.e",
    "range_tag_half_open": f"select * from {ACCT}",
    "recency_tag": CYCLE,
    "mode_category": f'select o_custkey as "userId", o_orderpriority as mode from {MODE} '
                     "where rn=1",
    "mode_category_tag": f'select o_custkey as "userId", r.name as payment from {MODE} join '
                         "(values ('1-URGENT','urgent'),('2-HIGH','high'),('5-LOW','low')) "
                         "r(rule,name) on o_orderpriority=r.rule where rn=1",
    "top1_per_group": "select p_brand,p_partkey,p_retailprice from (select *,row_number() "
                      "over(partition by p_brand order by p_retailprice desc,p_partkey) rn "
                      "from part) where rn=1",
    "top1_per_group_sql": "with t as (select *,row_number() over(partition by o_custkey order by "
                          "o_totalprice desc,o_orderkey) rn from orders) select o_custkey,"
                          "o_orderkey,o_totalprice from t where rn=1",
    "tag_distribution": f"select segment,count(*) as cnt from {SEG} group by 1",
    "filtered_count": "select count(*) as total from orders where "
                      "strftime(o_orderdate,'%Y-%m-%d')<'1996-09-01'",
    "row_get": "select * from customer where c_custkey=42",
    "profile_merge_wide": f"select * from {MERGED}",
    "profile_upsert": 'select coalesce(n."userId",o."userId") as "userId", '
                      'coalesce(n.acct,o.acct) as acct from (select "userId", \'stale\' as acct '
                      f'from {SEG}) o full join {ACCT_NEW} n on o."userId"=n."userId"',
    "profile_long_pivot": 'select "userId", max(value) filter (where tag=\'segment\') as segment, '
                          "max(value) filter (where tag='acct') as acct from "
                          f'(select "userId",\'segment\' tag,segment as value from {SEG} '
                          f'union all select "userId",\'acct\',acct from {ACCT}) group by 1',
    "profile_search": f"select * from {ACCT} where acct='rich'",
    "tsv_ingest_strict": f"select cast(o_orderkey as varchar) id, o_orderstatus st, {PRIO_EMPTIED} "
                         "prio from orders where o_orderpriority<>'5-LOW'",
    "tsv_ingest_trim_trailing": "select cast(o_orderkey as varchar) id, o_orderstatus st, "
                                "o_orderpriority prio from orders where o_orderpriority<>'5-LOW' "
                                "and o_orderstatus<>'P'",
    "cells_melt": "select cast(n_nationkey as varchar) rowkey,'detail' as family,q as qualifier,"
                  "v as value from (select n_nationkey,'name' q,n_name v from nation union all "
                  "select n_nationkey,'region',cast(n_regionkey as varchar) from nation)",
    "cells_sorted_rank": "select rowkey, c_name, c_mktsegment, c_acctbal, row_number() over(order by "
                         "rowkey) as pos from (select *, cast(c_custkey as varchar) rowkey from customer)",
    "kv_tags_explode": "select c_custkey id,'seg' as tag,c_mktsegment as value from customer "
                       "union all select c_custkey,'nat',cast(c_nationkey as varchar) from customer",
    "conditional_replace": f"select o_orderkey, case when o_custkey>=950 then {_pick('o_orderkey', 950)}+1 "
                           "else o_custkey end as member, case when o_orderpriority in "
                           "('1-URGENT','2-HIGH','5-LOW') then o_orderpriority else case "
                           f"{_pick('o_orderkey', 3)} when 0 then '1-URGENT' when 1 then '2-HIGH' else '5-LOW' "
                           "end end as pay from orders",
    "code_name_map": "select o_orderkey, case o_orderstatus when 'F' then 'finished' when 'O' then "
                     "'open' when 'P' then 'pending' end as st from orders",
    "date_shift_epoch": "select o_orderkey, cast(epoch(date_trunc('day',o_orderdate)+interval 350 "
                        "day) as bigint) as ft from orders",
    "date_window_bounds": "select n_nationkey, strftime(date '2019-09-01' - 1 - "
                          "cast(n_nationkey*30 as int),'%Y-%m-%d') as ago from nation",
    "letter_to_score": "select o_orderkey, 10.0::double*case o_orderpriority when '1-URGENT' then "
                       "1.0::double when '2-HIGH' then 0.8::double when '3-MEDIUM' then "
                       "0.7::double when '4-NOT SPECIFIED' then 0.5::double when '5-LOW' then "
                       "0.5::double end as score from orders",
    "score_to_letter": SCORE_LETTER,
    "cast_features_double": "select cast(o_orderkey as varchar) id, cast(o_totalprice as double) "
                            "price, try_cast(o_orderpriority as double) prio from orders",
    "corr_matrix": CORR,
    "string_index": "select o_orderkey, cast(ix as double) as label from orders join "
                    "(select o_orderpriority p,row_number() over(order by count(*) desc,"
                    "o_orderpriority)-1 ix from orders group by 1) on o_orderpriority=p",
    "index_to_string": "select o_orderkey, o_orderpriority as restored from orders",
    "assemble_max_abs": "select l_orderkey,l_linenumber, round(l_quantity/(select "
                        "max(abs(l_quantity)) from lineitem),6) f0, round(l_extendedprice/"
                        "(select max(abs(l_extendedprice)) from lineitem),6) f1 from lineitem",
    "l2_normalize": "select vec_id, slot, round(embedding[slot+1]::double/len,4) as x from (select vec_id, embedding, "
                    "sqrt(list_sum(list_transform(embedding, lambda x: x::double*x::double))) as len, "
                    "unnest(range(len(embedding)))::integer as slot from embeddings)",
    "vector_index_kinds": "select 'linenumber' f, count(distinct l_linenumber)<=20 as categorical "
                          "from lineitem union all select 'price', count(distinct "
                          "l_extendedprice)<=20 from lineitem",
    "split_deterministic": f"select case when {_pick('o_orderkey', 100)}<80 then 'train' else 'test' "
                           "end as part, count(*) as cnt from orders group by 1",
    "accuracy": "select round(avg(case when o_orderstatus='F' then 1.0 else 0.0 end),6) as "
                "accuracy from orders",
    "tolerance_accuracy": "select round(avg(case when abs(l_quantity-25)<=1 then 1.0 else 0.0 "
                          "end),6) as accuracy from lineitem",
    "csv_export_import": "select n_nationkey,n_name from nation",
    "table_append": "select n_nationkey,n_name from nation union all "
                    "select n_nationkey,n_name from nation",
    # beyond the first fifty
    "tag_level_lookup": f"select id,pid,name,level from {TREE} where level=5 and pid=2 union all "
                        f"select id,pid,name,level from {TREE} where name='ASIA' and level=4 "
                        "and pid=-1",
    "tag_path_insert": TAG_PATHS,
    "range_rule_parse": "select n_nationkey, n_nationkey*10 as lo, n_nationkey*10+9 as hi, "
                        "-(n_nationkey+0.5)::double as dlo, (n_nationkey+0.25)::double as dhi "
                        "from nation",
    "recency_tag_epoch": CYCLE,
    "top3_per_group": "select p_brand,p_partkey,p_retailprice,cast(rn as integer) as rnk from "
                      "(select *,row_number() over(partition by p_brand order by p_retailprice "
                      "desc,p_partkey) rn from part) where rn<=3",
    "cells_pivot_back": "select cast(n_nationkey as varchar) rowkey, n_name as name, "
                        "cast(n_regionkey as varchar) as region from nation",
    "sorted_order_check": "select count(*) as rows, cast(0 as bigint) as breaks_inside, cast(0 as bigint) as "
                          "breaks_between, true as hot_row_cut from lineitem",
    "bulk_load_cells": "select cast(o_orderkey as varchar) rowkey, 'detail' as family, 'st' as "
                       "qualifier, o_orderstatus as value from orders where "
                       "o_orderpriority<>'5-LOW' union all select cast(o_orderkey as varchar), "
                       f"'detail', 'prio', {PRIO_EMPTIED} from orders where "
                       "o_orderpriority<>'5-LOW'",
    "point_get": "select '42' as rowkey, 'detail' as family, 'c_mktsegment' as qualifier, "
                 "c_mktsegment as value from customer where c_custkey=42 union all "
                 "select '42', 'detail', 'c_name', c_name from customer where c_custkey=42",
    "order_cleanup": ORDER_CLEANUP,
    "date_text_to_int": "select o_orderkey, cast(strftime(o_orderdate,'%Y%m%d') as int) as d, "
                        "strftime(date_trunc('day',o_orderdate),'%Y-%m-%d %H:%M:%S') as txt "
                        "from orders",
    "rating_letter_score": RATING,
    "numeric_summary": SUMMARY,
    "profile_search_export": f"select * from {MERGED} where segment='builder'",
    "aggregate_models_one_scan": 'select coalesce(a."userId",b."userId") as "userId", payment, '
                                 f'cycle from (select o_custkey as "userId", r.name as payment '
                                 f"from {MODE} join (values ('1-URGENT','urgent'),('2-HIGH',"
                                 "'high'),('5-LOW','low')) r(rule,name) on o_orderpriority="
                                 f'r.rule where rn=1) a full join ({CYCLE}) b on '
                                 'a."userId"=b."userId"',
    "stream_profile_models": 'select c.c_custkey as "userId", s.name as segment, a.name as acct, '
                             f"c.c_name as name from customer c left join {SEG_VALUES_S} "
                             "on c.c_mktsegment=s.rule left join (values ('debt',-1000.0,0.0),"
                             "('mid',0.0,5000.0),('rich',5000.0,10000.0)) a(name,s,e) on "
                             "c.c_acctbal>a.s and c.c_acctbal<=a.e",
    "stream_bulk_load": "select cast(o_orderkey as varchar) rowkey, 'detail' as family, 'st' as "
                        "qualifier, o_orderstatus as value from orders where "
                        "o_orderpriority<>'5-LOW' union all select cast(o_orderkey as varchar), "
                        f"'detail', 'prio', {PRIO_EMPTIED} from orders where "
                        "o_orderpriority<>'5-LOW'",
    "model_mode_from_catalog": MODEL_MODE,
    "model_recency_from_catalog": MODEL_CYCLE,
    "model_date_range_from_catalog": 'select cast(o_orderkey as varchar) as "userId", r.name as '
                                     "era from orders join (values ('y95',19950101,19951231),"
                                     "('y96-97',19960101,19971231),('y98-01',19980101,20011231))"
                                     " r(name,s,e) on cast(strftime(o_orderdate,'%Y%m%d') as int)"
                                     " between r.s and r.e where o_orderstatus<>'P'",
    "model_ratio_from_catalog": ACCT.replace('c_custkey as "userId"',
                                             'cast(c_custkey as varchar) as "userId"')[1:-1],
    "model_copy_from_catalog": 'select cast(c_custkey as varchar) as "userId", c_name as name '
                               "from customer",
    "model_window_match_from_catalog": 'select cast(o_orderkey as varchar) as "userId", case '
                                       "o_orderstatus when 'F' then 'finished' when 'O' then "
                                       "'open' when 'P' then 'pending' end as status from orders "
                                       "where strftime(o_orderdate,'%Y-%m-%d') between "
                                       "'2000-07-31' and '2001-07-31'",
    "model_distribution": f"select payment, count(*) as cnt from ({MODEL_MODE}) group by 1",
    "model_save_profile": 'select coalesce(a."userId",b."userId") as "userId", payment, cycle '
                          f'from ({MODEL_MODE}) a full join ({MODEL_CYCLE}) b '
                          'on a."userId"=b."userId"',
    "ratio_correlation": RATIO_CORR,
    "catalog_table_append": "select n_nationkey,n_name from nation union all "
                            "select n_nationkey,n_name from nation",
    "profile_table_upsert": 'select coalesce(n."userId",o."userId") as "userId", '
                            'coalesce(n.acct,o.acct) as acct from (select "userId", \'stale\' '
                            f'as acct from {SEG}) o full join {ACCT_NEW} n on '
                            'o."userId"=n."userId"',
    "cell_scan_count": "select count(distinct c_custkey) as \"rows\" from customer",
    "model_match_from_catalog": 'select cast(c_custkey as varchar) as "userId", n_name as nation '
                                "from customer join nation on c_nationkey=n_nationkey "
                                "where n_regionkey=2",
    "models_one_scan": 'select c.c_custkey as "userId", s.name as segment, a.name as acct, '
                       f"c.c_name as name, n.n_name as nation from customer c left join {SEG_VALUES
                       .replace(' r(rule,name)', ' s(rule,name)')} on c.c_mktsegment=s.rule "
                       "left join (values ('debt',-1000.0,0.0),('mid',0.0,5000.0),"
                       "('rich',5000.0,10000.0)) a(name,s,e) on c.c_acctbal>a.s and "
                       "c.c_acctbal<=a.e left join nation n on c.c_nationkey=n.n_nationkey",
    "logistic_predict_tag": f"select {_SPLIT80} as split, count(*) as n, true as letters_known, case when "
                            f"{_SPLIT80}='train' then true end as gradient_small from embeddings group by 1",
    "decision_tree_predict": "select case when l_quantity>25 then 'large' else 'small' end as "
                             "\"predictedLabel\", count(*) as n, true as right, (select (max(l_quantity) filter "
                             "(where l_quantity<=25)+min(l_quantity) filter (where l_quantity>25))/2.0 from "
                             "lineitem)::double as threshold from lineitem group by 1",
    "model_save_load": "select count(*) as n, true as same from embeddings",
    "rating_logistic_eval": f"select {_SPLIT80} as split, count(*) as n, case when {_SPLIT80}='train' "
                            "then true end as gradient_small, true as within_one_more from embeddings group by 1",
    "rating_predict_profile": "select count(*) as n, true as letters_known from embeddings",
    "rating_tree_eval": f"select split, count(*) as n, true as known, case split when 'train' then true end as "
                        "splits_best, case split when 'train' then count(*) end as root_rows from (select "
                        f"{_SPLIT80.replace('<80', '<70').replace('vec_id', 'l_orderkey')} as split from lineitem) "
                        "group by 1",
    "normalised_classify": f"select {_SPLIT80} as split, count(*) as n, true as known_class, true as "
                           f"unit_length, case when {_SPLIT80}='train' then true end as gradient_small from embeddings "
                           "group by 1 union all "
                           "select 'literal', 1, true, true, null",
    "rule_text_edges": "select n_nationkey, 'x' as kind, n_name as fam, case n_nationkey%3 when 0 then "
                       "-n_nationkey when 1 then -9 end as lo, case n_nationkey%3 when 0 then 5 when 1 then "
                       "-n_nationkey end as hi, case when n_nationkey=1 then 'one' end as named from nation",
    "top1_nulls": "select g, o_orderkey, v from (select *, row_number() over(partition by g order by v desc "
                  "nulls last, o_orderkey) rn from (select o_custkey%700 as g, o_orderkey, case when "
                  "o_orderkey%3<>0 then o_totalprice end as v from orders)) where rn=1",
    "corr_matrix_wide": WIDE,
    "profile_empty_run": f"select \"userId\", 'acct' as tag, acct as value from {ACCT}",
    "profile_latest_wins": "select o_custkey as \"userId\", 'status' as tag, coalesce(arg_max(o_orderstatus, "
                           "o_orderkey) filter (where o_orderkey%2=0), arg_max(o_orderstatus, o_orderkey)) "
                           "as value from orders group by 1",
    "kv_tags_key_cell": "select c_custkey id,'seg' as tag,c_mktsegment as value from customer "
                        "union all select c_custkey,'userId',cast(c_custkey as varchar) from customer",
    "cell_scan_listing": "select cast(c_custkey as varchar) rowkey, 'detail' as family, 'c_name' as qualifier, "
                         "c_name as value, cast(1 as bigint) as version from customer union all select "
                         "cast(c_custkey as varchar), 'detail', 'c_mktsegment', c_mktsegment, 1 from customer",
    "tsv_ingest_wide": "select printf('f%03d', k) as qualifier, count(*) as n, cast(sum((o_orderkey*k+o_custkey)"
                       "%97) as bigint) as total from orders, range(1,112) t(k) group by 1",
    "positional_features": "select p_partkey, cast(p_size as double)+cast(p_retailprice as double) as total "
                           "from part",
    "tolerance_flag": "select l_orderkey, l_linenumber, case when abs(25-l_quantity)<=3 then 0.0::double "
                      "else 1.0::double end as flag from lineitem",
}
