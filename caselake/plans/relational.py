"""Single relational operators on the driver tables, with SQL twins: name -> (make, tables, SQL)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import partial_date, ratio, surrogate_key

QUERIES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...], str]] = {}


def _add(name: str, tables: str, sql: str) -> Callable:
    def keep(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        QUERIES[name] = (make, tuple(tables.split()), sql)
        return make

    return keep


# --- projection and expressions --------------------------------------------------------------
_add("p01_projection_rename", "region", "select r_regionkey as id, r_name as name from region")(lambda r: r.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")))
_add("p02_exclude", "nation", "select * exclude (n_regionkey) from nation")(lambda n: n.drop("n_regionkey"))
_add("p03_p04_lateral_alias", "lineitem", "select l_orderkey, l_quantity * 2 as dbl, l_quantity * 2 + 1 as nxt from lineitem where l_quantity * 2 > 90")(
    lambda t: t.withColumn("dbl", F.col("l_quantity") * 2).withColumn("nxt", F.col("dbl") + 1).where("dbl > 90").select("l_orderkey", "dbl", "nxt")
)
_add("p05_p06_case", "orders", "select o_orderkey, case when o_totalprice > 200000 then 'big' when o_totalprice > 100000 then 'mid' else 'small' end as size, case o_orderstatus when 'F' then 1 when 'O' then 2 else 0 end as code from orders")(
    lambda o: o.select("o_orderkey", F.when(F.col("o_totalprice") > 200000, "big").when(F.col("o_totalprice") > 100000, "mid").otherwise("small").alias("size"), F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(0).alias("code"))
)
_add("p07_p08_coalesce_nullif", "orders", "select o_orderkey, coalesce(nullif(o_orderpriority, '1-URGENT'), 'urgent') as priority from orders")(lambda o: o.select("o_orderkey", F.coalesce(F.nullif("o_orderpriority", F.lit("1-URGENT")), F.lit("urgent")).alias("priority")))
_add("p09_p10_casts", "orders", "select o_orderkey, try_cast(left(o_orderpriority, 1) as int) as level, try_cast(o_orderstatus as bigint) as bad, o_orderdate::date as day, try_cast(o_totalprice::varchar as double) as price from orders")(
    lambda o: o.select("o_orderkey", F.left("o_orderpriority", F.lit(1)).try_cast("int").alias("level"), F.col("o_orderstatus").try_cast("bigint").alias("bad"), F.col("o_orderdate").cast("date").alias("day"), F.col("o_totalprice").cast("string").try_cast("double").alias("price"))
)
_add("p11_p12_nulls", "orders", "select o_orderkey, nullif(o_orderstatus, 'F') is null as is_f, nullif(o_orderstatus, 'F') is distinct from 'O' as not_o from orders where nullif(o_orderstatus, 'P') is not null")(
    lambda o: o.where(F.nullif("o_orderstatus", F.lit("P")).isNotNull()).select("o_orderkey", F.nullif("o_orderstatus", F.lit("F")).isNull().alias("is_f"), (~F.nullif("o_orderstatus", F.lit("F")).eqNullSafe(F.lit("O"))).alias("not_o"))
)
_add("p13_p14_like", "part", "select p_partkey, p_name like '%red%' as a, p_name ilike '%RED %' as b, p_type like '%Y' as c from part")(lambda p: p.select("p_partkey", F.col("p_name").like("%red%").alias("a"), F.col("p_name").ilike("%RED %").alias("b"), F.col("p_type").like("%Y").alias("c")))
_add("p15_p16_in_boolean", "orders", "select o_orderkey, o_totalprice > 100000 and o_orderstatus in ('F', 'O') as hit from orders where o_orderpriority not in ('1-URGENT', '5-LOW')")(
    lambda o: o.where(~F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).select("o_orderkey", ((F.col("o_totalprice") > 100000) & F.col("o_orderstatus").isin("F", "O")).alias("hit"))
)
_add("p17_p19_equals_concat", "nation", "select n_nationkey, 'n:' || n_name as label from nation where n_regionkey == 2")(lambda n: n.where("n_regionkey = 2").select("n_nationkey", F.concat(F.lit("n:"), "n_name").alias("label")))
_add("p18_parameters", "customer", "select c_custkey, c_acctbal from customer where c_mktsegment = 'FURNITURE' and c_acctbal > 5000")(lambda c: c.sparkSession.sql("select c_custkey, c_acctbal from {c} where c_mktsegment = :segment and c_acctbal > :least", args={"segment": "FURNITURE", "least": 5000}, c=c))
_add("p20_p21_filled_typed_null", "orders", "select o_orderkey, (o_custkey is not null)::int + (nullif(o_orderstatus, 'F') is not null)::int as filled, cast(null as varchar) as note from orders")(
    lambda o: o.select("o_orderkey", (F.col("o_custkey").isNotNull().cast("int") + F.nullif("o_orderstatus", F.lit("F")).isNotNull().cast("int")).alias("filled"), F.lit(None).cast("string").alias("note"))
)

# --- joins -----------------------------------------------------------------------------------
_add("j01_j02_inner", "orders customer", "select o_orderkey, c_name from orders join customer on o_custkey = c_custkey")(lambda o, c: o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name"))
_add("j03_j04_left", "customer orders", "select c_custkey, o_orderkey from customer left join orders on c_custkey = o_custkey and o_orderstatus = 'P'")(lambda c, o: c.join(o.where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey"))
_add("j05_multi_key", "lineitem", "select a.l_orderkey, a.l_linenumber, n from lineitem a left join (select l_orderkey, l_linenumber, count(*) as n from lineitem where l_returnflag = 'A' group by 1, 2) b using (l_orderkey, l_linenumber)")(
    lambda t: t.select("l_orderkey", "l_linenumber").join(t.where("l_returnflag = 'A'").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")), ["l_orderkey", "l_linenumber"], "left")
)
_add("j06_expression_key", "part nation", "select p_partkey, n_name from part join nation on p_partkey % 25 = n_nationkey and upper(left(p_type, 1)) = chr(65 + n_regionkey + 11)")(
    lambda p, n: p.join(n, (F.col("p_partkey") % 25 == F.col("n_nationkey")) & (F.upper(F.left("p_type", F.lit(1))) == F.char(F.col("n_regionkey") + 76))).select("p_partkey", "n_name")
)
_add("j07_cross_total", "region nation", "select r_name, n from region cross join (select count(*) as n from nation)")(lambda r, n: r.select("r_name").crossJoin(F.broadcast(n.agg(F.count("*").alias("n")))))  # one row
_add("j08_j09_semi", "orders lineitem", "select o_orderkey from orders semi join (select * from lineitem where l_returnflag = 'R') l on o_orderkey = l_orderkey")(lambda o, t: o.join(t.where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_semi").select("o_orderkey"))
_add("j10_j13_anti", "customer orders", "select c_custkey from customer left join (select * from orders where o_orderpriority = '1-URGENT') on c_custkey = o_custkey where o_orderkey is null")(
    lambda c, o: c.join(o.where("o_orderpriority = '1-URGENT'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")
)
_add("j11_not_in", "customer orders", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'F')")(lambda c, o: c.sparkSession.sql("select c_custkey from {c} where c_custkey not in (select o_custkey from {o} where o_orderstatus = 'F')", c=c, o=o))
_add("j12_in_case", "part lineitem", "select p_partkey, case when p_partkey in (select l_partkey from lineitem where l_discount > 0.09) then 'cut' else 'full' end as kind from part")(
    lambda p, t: p.join(t.where("l_discount > 0.09").select(F.col("l_partkey").alias("p_partkey")).distinct().withColumn("hit", F.lit(True)), "p_partkey", "left").select("p_partkey", F.when(F.col("hit"), "cut").otherwise("full").alias("kind"))
)

# --- aggregation -----------------------------------------------------------------------------
_add("a01_a03_counts", "orders", "select o_orderstatus, count(*) as n, count(nullif(o_orderpriority, '5-LOW')) as filled, count(distinct o_custkey) as cases from orders group by 1")(
    lambda o: o.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count(F.nullif("o_orderpriority", F.lit("5-LOW"))).alias("filled"), F.countDistinct("o_custkey").alias("cases"))
)
_add("a04_distinct_filter", "orders", "select o_orderstatus, count(distinct o_custkey) filter (where o_orderpriority <> '1-URGENT') as n from orders group by 1")(lambda o: o.groupBy("o_orderstatus").agg(F.countDistinct(F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_custkey"))).alias("n")))
_add("a05_a06_filtered", "lineitem", "select l_returnflag, count(*) filter (where l_discount > 0.05) as n, round(sum(l_quantity) filter (where l_tax < 0.04), 2) as q, count_if(l_linenumber = 1)::bigint as first from lineitem group by 1")(
    lambda t: t.groupBy("l_returnflag").agg(F.count(F.when(F.col("l_discount") > 0.05, 1)).alias("n"), F.round(F.sum(F.when(F.col("l_tax") < 0.04, F.col("l_quantity"))), 2).alias("q"), F.count_if(F.col("l_linenumber") == 1).alias("first"))
)
_add("a07_a16_share", "lineitem", "select l_returnflag, round(max(n) / sum(n), 6) as purity, sum(n)::bigint as total from (select l_returnflag, l_linestatus, count(*) as n from lineitem group by 1, 2) group by 1")(
    lambda t: t.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")).groupBy("l_returnflag").agg(F.round(ratio(F.max("n"), F.sum("n")), 6).alias("purity"), F.sum("n").alias("total"))
)
_add("a08_arg_max", "customer", "select c_mktsegment, max_by(c_name, (c_acctbal, c_name)) as top from customer group by 1")(lambda c: c.groupBy("c_mktsegment").agg(F.max_by("c_name", F.struct("c_acctbal", "c_name")).alias("top")))
_add("a09_a10_any_bool", "orders", "select o_custkey, bool_or(o_orderstatus = 'F') as some_f, bool_and(o_totalprice > 1000) as all_big, any_value(o_custkey * 2) as twice from orders group by 1")(
    lambda o: o.groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "F").alias("some_f"), F.bool_and(F.col("o_totalprice") > 1000).alias("all_big"), F.any_value(F.col("o_custkey") * 2, True).alias("twice"))
)
_add("a11_lists", "nation", "select n_regionkey, array_to_string(list_sort(list_distinct(list(n_name))), '|') as names, len(list(n_name))::int as n from nation group by 1")(lambda n: n.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_set("n_name")), "|").alias("names"), F.size(F.collect_list("n_name")).alias("n")))
_add("a12_flags", "orders", "select o_custkey, max(case when o_orderstatus = 'F' then 1 else 0 end) as has_f, max(case when o_orderstatus = 'O' then 1 else 0 end) as has_o from orders group by 1")(
    lambda o: o.groupBy("o_custkey").agg(*(F.max(F.when(F.col("o_orderstatus") == s, 1).otherwise(0)).alias(f"has_{s.lower()}") for s in "FO"))
)
_add("a13_a14_alias_having", "orders", "select year(o_orderdate)::int as yr, count(*) as n from orders group by yr having count(*) > 100")(lambda o: o.groupBy(F.year("o_orderdate").alias("yr")).agg(F.count("*").alias("n")).where("n > 100"))
_add("a15_group_distinct", "orders", "select o_orderstatus, o_orderpriority from orders group by 1, 2")(lambda o: o.select("o_orderstatus", "o_orderpriority").dropDuplicates())
_add("a17_a18_global", "events", "select count(*) as n, count(distinct user_id) as users, max(event_id) as last, min(event_id) as first from events")(lambda e: e.agg(F.count("*").alias("n"), F.countDistinct("user_id").alias("users"), F.max("event_id").alias("last"), F.min("event_id").alias("first")))

# --- windows ---------------------------------------------------------------------------------
_by = lambda *keys: W.partitionBy(*keys)
_add("w01_w02_row_number", "orders", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_totalprice desc, o_orderkey) = 1")(
    lambda o: o.withColumn("rk", F.row_number().over(_by("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))).where("rk = 1").select("o_custkey", "o_orderkey")
)
_add("w03_w05_max_min_ties", "orders", "select o_custkey, o_orderkey from orders qualify year(o_orderdate) = max(year(o_orderdate)) over (partition by o_custkey) or o_totalprice = min(o_totalprice) over (partition by o_custkey)")(
    lambda o: o.select("o_custkey", "o_orderkey", (F.year("o_orderdate") == F.max(F.year("o_orderdate")).over(_by("o_custkey"))).alias("a"), (F.col("o_totalprice") == F.min("o_totalprice").over(_by("o_custkey"))).alias("b")).where("a or b").select("o_custkey", "o_orderkey")
)
_add("w04_count_over", "lineitem", "select l_orderkey, l_linenumber from lineitem qualify count(*) over (partition by l_orderkey, l_linenumber) > 1")(lambda t: t.select("l_orderkey", "l_linenumber", F.count("*").over(_by("l_orderkey", "l_linenumber")).alias("n")).where("n > 1").drop("n"))
_add("w10_window_over_aggregate", "lineitem", "select l_returnflag, l_linestatus, round(100.0 * count(*) / sum(count(*)) over (partition by l_returnflag), 6)::double as pct from lineitem group by 1, 2")(
    lambda t: t.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")).select("l_returnflag", "l_linestatus", F.round(100.0 * F.col("n") / F.sum("n").over(_by("l_returnflag")), 6).alias("pct"))
)

# --- order, sets, nested data ----------------------------------------------------------------
_add("o01_o02_o03_top", "orders", "select o_custkey, count(*) as n from orders group by 1 order by n desc, o_custkey limit 15")(lambda o: o.groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(15))
_add("o04_distinct", "orders", "select distinct o_orderstatus, o_custkey from orders")(lambda o: o.select("o_orderstatus", "o_custkey").distinct())
_add("u01_u02_union", "customer supplier", "select c_name as name, c_nationkey as nation, 'c' as kind from customer union all by name select s_name as name, 's' as kind, s_nationkey as nation from supplier")(
    lambda c, s: c.select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation"), F.lit("c").alias("kind")).unionByName(s.select(F.col("s_name").alias("name"), F.lit("s").alias("kind"), F.col("s_nationkey").alias("nation")))
)
_add("u03_except", "customer orders", "select c_custkey as k from customer except select o_custkey as k from orders where o_orderstatus = 'P'")(lambda c, o: c.select(F.col("c_custkey").alias("k")).subtract(o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k"))))
_add("n01_n05_split_explode", "part", "select p_partkey, unnest(string_split(p_name, ' ')) as word from part")(lambda p: p.select("p_partkey", F.explode(F.split("p_name", " ")).alias("word")))
_add("n03_struct_path", "events", "select event_id, (json_extract(props, '$.k'))::int as k from events")(lambda e: e.select("event_id", F.from_json("props", "struct<k:int>")["k"].alias("k")))
_add("n04_extract_all", "part", "select p_partkey, unnest(regexp_extract_all(p_type || ' (' || p_name || ')', '\\(([^()]*)\\)', 1)) as inner_text from part")(
    lambda p: p.select("p_partkey", F.explode(F.regexp_extract_all(F.concat("p_type", F.lit(" ("), "p_name", F.lit(")")), F.lit(r"\(([^()]*)\)"), F.lit(1))).alias("inner_text"))
)

# --- functions -------------------------------------------------------------------------------
_add("f01_f04_strings", "part", "select p_partkey, upper(p_name) as up, lower(p_type) as low, trim('  ' || p_name || ' ') as trimmed, length(p_name)::int as n, replace(p_name, 'widget', 'gadget') as swapped, string_split(p_name, ' ')[1] as head from part")(
    lambda p: p.select("p_partkey", F.upper("p_name").alias("up"), F.lower("p_type").alias("low"), F.trim(F.concat(F.lit("  "), "p_name", F.lit(" "))).alias("trimmed"), F.length("p_name").alias("n"), F.replace("p_name", F.lit("widget"), F.lit("gadget")).alias("swapped"), F.get(F.split("p_name", " "), F.lit(0)).alias("head"))
)
_add("f05_f10_regex", "part", "select p_partkey, regexp_replace(p_name, '[a-z]+$', '') as a, regexp_replace(p_name, '([aeiou])', '<\\1>', 'g') as b, regexp_replace(p_name, 'RED', 'x', 'gi') as c, regexp_matches(p_name, 'w.dget') as d, contains(p_name, 'old') as e from part")(
    lambda p: p.select("p_partkey", F.regexp_replace("p_name", "[a-z]+$", "").alias("a"), F.regexp_replace("p_name", "([aeiou])", "<$1>").alias("b"), F.regexp_replace("p_name", "(?i)RED", "x").alias("c"), F.col("p_name").rlike("w.dget").alias("d"), F.contains("p_name", F.lit("old")).alias("e"))
)
_add("f11_d07_partial_date", "orders", "select o_orderkey, case length(s) when 8 then try_strptime(s, '%Y%m%d')::date when 6 then try_strptime(s || '01', '%Y%m%d')::date when 4 then try_strptime(s || '0101', '%Y%m%d')::date end as day from (select o_orderkey, case o_orderkey % 4 when 0 then strftime(o_orderdate, '%Y%m%d') when 1 then strftime(o_orderdate, '%Y%m') when 2 then strftime(o_orderdate, '%Y') else '2015317' end as s from orders)")(
    lambda o: o.select("o_orderkey", partial_date(F.when(F.col("o_orderkey") % 4 == 0, F.date_format("o_orderdate", "yyyyMMdd")).when(F.col("o_orderkey") % 4 == 1, F.date_format("o_orderdate", "yyyyMM")).when(F.col("o_orderkey") % 4 == 2, F.date_format("o_orderdate", "yyyy")).otherwise("2015317")).alias("day"))
)
_add("f12_f14_dates_round", "orders", "select o_orderkey, date_trunc('quarter', o_orderdate)::date as q, year(o_orderdate)::int as y, round(o_totalprice / 1000, 1) as k from orders")(lambda o: o.select("o_orderkey", F.trunc("o_orderdate", "quarter").alias("q"), F.year("o_orderdate").alias("y"), F.round(F.col("o_totalprice") / 1000, 1).alias("k")))
_add("f15_f18_maths", "lineitem", "select l_orderkey, l_partkey, l_linenumber, round(log2(l_quantity), 6) as a, round(ln(l_quantity), 6) as b, round(exp(l_discount), 6) as c, round(sqrt(l_quantity), 6) as d, round(pow(l_quantity, -0.5), 6) as e, abs(l_linenumber - 4) as f, greatest(l_linenumber, 3) as g, round(l_linenumber / 3, 6) as h from lineitem")(
    lambda t: t.select("l_orderkey", "l_partkey", "l_linenumber", F.round(F.log2("l_quantity"), 6).alias("a"), F.round(F.log("l_quantity"), 6).alias("b"), F.round(F.exp("l_discount"), 6).alias("c"), F.round(F.sqrt("l_quantity"), 6).alias("d"), F.round(F.pow("l_quantity", F.lit(-0.5)), 6).alias("e"), F.abs(F.col("l_linenumber") - 4).alias("f"), F.greatest("l_linenumber", F.lit(3)).alias("g"), F.round(F.col("l_linenumber") / 3.0, 6).alias("h"))
)
_add("f19_f20_keys", "nation", "select n_nationkey, md5(n_name || '-' || coalesce(nullif(n_regionkey, 1)::varchar, '_dbt_utils_surrogate_key_null_')) as k, sha1(n_name) as s from nation")(
    lambda n: n.select("n_nationkey", surrogate_key(F.col("n_name"), F.nullif("n_regionkey", F.lit(1))).alias("k"), F.sha1("n_name").alias("s"))
)
