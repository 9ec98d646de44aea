"""Registered queries: each operator on the test tables, beside SQL that says the same to another engine.

``query`` registers a function of a table loader with its SQL; the loader reads a table by name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.udfs import detect_language, token_set_ratio
from ..operators import clusters as C
from ..operators import gate, matching, quality
from ..operators import relational as R
from ..session import materialise
from . import facts, marts, serving, staging

Load = Callable[[str], DataFrame]
_queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Callable[[Load], DataFrame]):
        _queries[f.__name__] = lambda spark, sf_dir: f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))
        if sql:
            _sql[f.__name__] = sql
        return f

    return register


def queries():
    from . import catalog_star  # noqa: F401  registers more

    return dict(_queries)


def oracle_sql():
    queries()
    return dict(_sql)


c = F.col
PRIMARY = "row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)"
PRIMARY_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice"]


# --- aggregates, shares, spines ---------------------------------------------------------------------------------------


@query(f"""
WITH p AS (SELECT * FROM (SELECT l_orderkey, l_suppkey, {PRIMARY} AS n FROM lineitem) WHERE n = 1),
k AS (SELECT n_regionkey AS region, l_suppkey, count(*) AS n FROM p JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY 1, 2),
t AS (SELECT region, sum(n) AS total FROM k GROUP BY 1)
SELECT k.region, max(t.total)::BIGINT AS n_orders, count(*)::BIGINT AS n_suppliers,
       CASE WHEN max(t.total) >= 10 THEN round(sum((n::DOUBLE / total) * (n::DOUBLE / total)), 4) END AS hhi, max(t.total) >= 10 AS hhi_reportable
FROM k JOIN t ON t.region = k.region GROUP BY 1""")
def hhi_by_region(t: Load) -> DataFrame:
    primary = R.first_per_key(t("lineitem").select("l_orderkey", *PRIMARY_ORDER), "l_orderkey", [c(x) for x in PRIMARY_ORDER])
    regions = t("supplier").select("s_suppkey", "s_nationkey").join(t("nation").select(c("n_nationkey").alias("s_nationkey"), c("n_regionkey").alias("region")), "s_nationkey")
    found = R.concentration(primary.select(c("l_suppkey").alias("s_suppkey")).join(regions, "s_suppkey"), "region", "s_suppkey")
    return found.select("region", c("total").alias("n_orders"), c("n_entities").alias("n_suppliers"), R.reported(c("hhi"), c("resolved"), 10).alias("hhi"), (c("resolved") >= 10).alias("hhi_reportable"))


@query("""
WITH k AS (SELECT c_mktsegment AS segment, c_nationkey AS nation, count(DISTINCT o_orderkey) AS doc_count FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
t AS (SELECT segment, sum(doc_count) AS total FROM k GROUP BY 1)
SELECT k.segment, nation, doc_count, round(doc_count::DOUBLE / total, 4) AS share,
       row_number() OVER (PARTITION BY k.segment ORDER BY doc_count DESC, nation)::INT AS rnk FROM k JOIN t ON t.segment = k.segment""")
def share_rank_by_segment(t: Load) -> DataFrame:
    joined = t("orders").select("o_orderkey", c("o_custkey").alias("c_custkey")).join(t("customer").select("c_custkey", c("c_mktsegment").alias("segment"), c("c_nationkey").alias("nation")), "c_custkey")
    counts = joined.groupBy("segment", "nation").agg(F.countDistinct("o_orderkey").alias("doc_count"))
    totals = counts.groupBy("segment").agg(F.sum("doc_count").alias("total"))
    shares = counts.join(totals, "segment").select("segment", "nation", "doc_count", R.ratio(c("doc_count"), c("total"), 4).alias("share"))
    return R.ranked(shares, "segment", [c("doc_count").desc(), c("nation")])


@query("""
WITH a AS (SELECT o_orderstatus AS status, year(o_orderdate)::INT AS year, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1, 2),
b AS (SELECT l_linestatus AS status, year(l_shipdate)::INT AS year, count(DISTINCT l_orderkey) AS n FROM lineitem GROUP BY 1, 2),
s AS (SELECT status, year FROM a UNION SELECT status, year FROM b)
SELECT s.status, s.year, coalesce(a.n, 0) AS ordered, coalesce(b.n, 0) AS shipped FROM s
LEFT JOIN a ON a.status = s.status AND a.year = s.year LEFT JOIN b ON b.status = s.status AND b.year = s.year""")
def velocity_spine(t: Load) -> DataFrame:
    a = t("orders").groupBy(c("o_orderstatus").alias("status"), F.year("o_orderdate").alias("year")).agg(F.countDistinct("o_orderkey").alias("ordered"))
    b = t("lineitem").groupBy(c("l_linestatus").alias("status"), F.year("l_shipdate").alias("year")).agg(F.countDistinct("l_orderkey").alias("shipped"))
    return R.year_spine([(a, "ordered"), (b, "shipped")], ["status", "year"])


@query("""
WITH f(family_id, sort) AS (VALUES ('ECONOMY', 1), ('LARGE', 2), ('NONE', 3)),
l AS (SELECT p_type, l_partkey, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) / 365.25::DOUBLE AS lag FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey),
k AS (SELECT p_type, count(DISTINCT l_partkey) AS n, round(median(lag), 2) AS med, round(avg(lag), 2) AS mean FROM l GROUP BY 1),
t AS (SELECT sum(n) AS total FROM k)
SELECT family_id, sort::INT AS sort, coalesce(n, 0) AS n_parts, round(coalesce(n, 0)::DOUBLE / nullif(total, 0), 3) AS share, med AS median_lag, mean AS mean_lag
FROM f LEFT JOIN k ON p_type = family_id CROSS JOIN t""")
def family_scorecard(t: Load) -> DataFrame:
    lines = t("lineitem").select("l_orderkey", c("l_partkey").alias("p_partkey"), "l_shipdate").join(t("part").select("p_partkey", c("p_type").alias("family_id")), "p_partkey").join(t("orders").select(c("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    lag = F.datediff("l_shipdate", "o_orderdate") / F.lit(365.25)
    sums = lines.groupBy("family_id").agg(F.countDistinct("p_partkey").alias("n_parts"), F.round(F.median(lag), 2).alias("median_lag"), F.round(F.avg(lag), 2).alias("mean_lag"))
    spine = sums.sparkSession.createDataFrame([("ECONOMY", 1), ("LARGE", 2), ("NONE", 3)], "family_id string, sort int")
    total = sums.agg(F.sum("n_parts").alias("total"))
    out = marts.joined(spine, [sums], "family_id").crossJoin(F.broadcast(total))  # one row
    return out.select("family_id", "sort", marts.zero("n_parts"), R.ratio(F.coalesce("n_parts", F.lit(0)), c("total"), 3).alias("share"), "median_lag", "mean_lag")


@query("""
WITH v AS (SELECT l_suppkey AS g, CASE WHEN p_brand LIKE 'Brand#1%' THEN 'one' WHEN p_brand LIKE 'Brand#2%' THEN 'two' WHEN p_brand LIKE 'Brand#9%' THEN 'nine' ELSE 'mixed' END AS vote FROM lineitem JOIN part ON p_partkey = l_partkey),
k AS (SELECT g, vote, count(*) AS n FROM v GROUP BY 1, 2),
t AS (SELECT g, sum(n) AS total, sum(n) FILTER (vote <> 'mixed') AS real FROM k GROUP BY 1),
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY n DESC, vote) AS r FROM k WHERE vote <> 'mixed') WHERE r = 1)
SELECT t.g AS l_suppkey, CASE WHEN d.n::DOUBLE / real >= 0.58 AND real::DOUBLE / total >= 0.7 THEN d.vote ELSE 'mixed' END AS label FROM t LEFT JOIN d ON d.g = t.g""")
def dominant_vote_floor(t: Load) -> DataFrame:
    brand = c("p_brand")
    vote = F.when(brand.startswith("Brand#1"), "one").when(brand.startswith("Brand#2"), "two").when(brand.startswith("Brand#9"), "nine").otherwise("mixed")
    votes = t("lineitem").select("l_suppkey", c("l_partkey").alias("p_partkey")).join(t("part").select("p_partkey", vote.alias("vote")), "p_partkey")
    return marts.dominant_votes(votes, "l_suppkey", "vote", "mixed", 0.58, 0.7)


@query("""
SELECT l_returnflag, count(*) AS n_links, sum(d)::BIGINT AS days, round(median(round(d / 365.25::DOUBLE, 2)), 2) AS median_years, min(d)::INT AS fastest
FROM (SELECT l_returnflag, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS d FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderdate < l_shipdate) GROUP BY 1""")
def lag_link(t: Load) -> DataFrame:
    dated = t("lineitem").select("l_orderkey", "l_returnflag", "l_shipdate").join(t("orders").select(c("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey").where("o_orderdate < l_shipdate")
    d = F.datediff("l_shipdate", "o_orderdate")
    return dated.groupBy("l_returnflag").agg(F.count("*").alias("n_links"), F.sum(d).alias("days"), F.round(F.median(F.round(d / F.lit(365.25), 2)), 2).alias("median_years"), F.min(d).alias("fastest"))


@query("""
WITH p AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_linenumber = 1),
m AS (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_orderkey NOT IN (SELECT l_orderkey FROM p)),
u AS (SELECT *, 'published' AS source FROM p UNION ALL SELECT *, 'matched' FROM m)
SELECT source, count(*) AS n, count(DISTINCT l_orderkey) AS n_orders FROM u GROUP BY 1""")
def source_seam(t: Load) -> DataFrame:
    lines = t("lineitem")
    p = lines.where("l_returnflag = 'R' and l_linenumber = 1").select("l_orderkey", "l_partkey")
    m = R.not_in(lines.where("l_returnflag = 'A'").select("l_orderkey", "l_partkey"), p.distinct(), "l_orderkey")
    return p.withColumn("source", F.lit("published")).unionByName(m.withColumn("source", F.lit("matched"))).groupBy("source").agg(F.count("*").alias("n"), F.countDistinct("l_orderkey").alias("n_orders"))


@query("""
WITH a AS (SELECT c_mktsegment AS segment, median(year(o_orderdate)) AS ordered FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1),
b AS (SELECT c_mktsegment AS segment, median(year(l_shipdate)) AS shipped FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey GROUP BY 1)
SELECT a.segment, round(ordered, 1) AS ordered, round(shipped, 1) AS shipped, round(shipped - ordered, 1) AS lag FROM a JOIN b ON a.segment = b.segment""")
def cohort_median_lag(t: Load) -> DataFrame:
    o = t("orders").select("o_orderkey", c("o_custkey").alias("c_custkey"), "o_orderdate").join(t("customer").select("c_custkey", c("c_mktsegment").alias("segment")), "c_custkey")
    a = o.groupBy("segment").agg(F.median(F.year("o_orderdate")).alias("ordered"))
    b = o.join(t("lineitem").select(c("l_orderkey").alias("o_orderkey"), "l_shipdate"), "o_orderkey").groupBy("segment").agg(F.median(F.year("l_shipdate")).alias("shipped"))
    return a.join(b, "segment").select("segment", F.round("ordered", 1).alias("ordered"), F.round("shipped", 1).alias("shipped"), F.round(c("shipped") - c("ordered"), 1).alias("lag"))


@query("""
SELECT l_linestatus, count(*) AS n, count(*) FILTER (l_quantity > 25) AS n_large, sum(l_linenumber) FILTER (l_returnflag = 'R')::BIGINT AS returned,
       round(count(*) FILTER (l_quantity > 25) * 100.0::DOUBLE / nullif(count(*), 0), 1) AS pct_large, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem GROUP BY 1""")
def filter_agg(t: Load) -> DataFrame:
    large = F.count(F.when(c("l_quantity") > 25, 1))
    return t("lineitem").groupBy("l_linestatus").agg(F.count("*").alias("n"), large.alias("n_large"), F.sum(F.when(c("l_returnflag") == "R", c("l_linenumber"))).alias("returned"), F.round(large * F.lit(100.0) / F.nullif(F.count("*"), F.lit(0)), 1).alias("pct_large"), F.countDistinct("l_partkey").alias("n_parts"), F.countDistinct("l_suppkey").alias("n_suppliers"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def having_dupes(t: Load) -> DataFrame:
    return quality.repeated(t("lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_orderpriority, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM orders), 1) AS pct, count(*) AS n, (SELECT count(*) FROM orders) AS total FROM orders GROUP BY 1""")
def cross_totals_pct(t: Load) -> DataFrame:
    o = t("orders")
    counts, total = o.groupBy("o_orderpriority").agg(F.count("*").alias("n")), o.agg(F.count("*").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("o_orderpriority", F.round(c("n") * F.lit(100.0) / c("total"), 1).alias("pct"), "n", "total")  # one row


@query("""
SELECT (SELECT count(DISTINCT doc_id) FROM labels WHERE toxic = 1) AS n_toxic, (SELECT count(DISTINCT doc_id) FROM labels WHERE quality = 0) AS n_poor,
       (SELECT count(DISTINCT doc_id) FROM documents WHERE lang IS NULL) AS n_no_lang""")
def scalar_subquery_counts(t: Load) -> DataFrame:
    one = lambda df, name: df.agg(F.countDistinct("doc_id").alias(name))
    return one(t("labels").where("toxic = 1"), "n_toxic").crossJoin(one(t("labels").where("quality = 0"), "n_poor")).crossJoin(one(t("documents").where("lang is null"), "n_no_lang"))  # one row each


# --- joins ---------------------------------------------------------------------------------------------------------------


@query("""
SELECT p_type, count(*) AS n FROM part WHERE (p_type LIKE 'ECO%' OR p_type LIKE 'PRO%') AND p_partkey IN
 (SELECT l_partkey FROM lineitem WHERE l_linenumber <= 4 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1998-12-31') GROUP BY 1""")
def scope_prefix_top5(t: Load) -> DataFrame:
    hit = t("lineitem").where((c("l_linenumber") <= 4) & c("l_shipdate").between("1996-01-01", "1998-12-31")).select(c("l_partkey").alias("p_partkey"))
    return R.semi(t("part").where(X.starts_with_any(c("p_type"), ("ECO", "PRO"))), hit, "p_partkey").groupBy("p_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') GROUP BY 1")
def semi_scope(t: Load) -> DataFrame:
    ids = t("customer").where("c_mktsegment = 'BUILDING'").select(c("c_custkey").alias("o_custkey"))
    return R.semi(t("orders"), ids, "o_custkey").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("SELECT c_custkey, c_name FROM customer LEFT JOIN orders ON o_custkey = c_custkey WHERE o_orderkey IS NULL")
def anti_left(t: Load) -> DataFrame:
    return t("customer").join(t("orders"), c("c_custkey") == c("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query("SELECT doc_id, n_chars FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)")
def not_in_nullaware(t: Load) -> DataFrame:
    return R.not_in(t("documents").select("doc_id", "n_chars"), t("labels"), "doc_id")


@query("""
SELECT doc_id FROM documents d WHERE (lang = 'en' AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1))
 OR (lang <> 'en' AND EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND quality = 0))""")
def exists_or(t: Load) -> DataFrame:
    d = t("documents").select("doc_id", "lang")
    return R.semi(d.where("lang = 'en'"), t("labels").where("toxic = 1"), "doc_id").unionByName(R.semi(d.where("lang <> 'en'"), t("labels").where("quality = 0"), "doc_id")).select("doc_id")


@query("SELECT o_orderstatus, count(*) AS n, count(c_custkey) AS n_building FROM orders LEFT JOIN customer ON c_mktsegment = 'BUILDING' AND c_custkey = o_custkey GROUP BY 1")
def left_const_on(t: Load) -> DataFrame:
    own = t("customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return t("orders").join(own, c("c_custkey") == c("o_custkey"), "left").groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.count("c_custkey").alias("n_building"))


@query("SELECT o_orderpriority, count(*) AS n, count(l_partkey) AS n_lines FROM orders LEFT JOIN (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_linenumber = 1) f ON l_orderkey = o_orderkey GROUP BY 1")
def left_filtered(t: Load) -> DataFrame:
    first = t("lineitem").where("l_linenumber = 1").select("l_orderkey", "l_partkey")
    return t("orders").join(first, c("l_orderkey") == c("o_orderkey"), "left").groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count("l_partkey").alias("n_lines"))


@query("""
SELECT s_nationkey, count(DISTINCT o_orderkey) AS n_orders FROM customer JOIN orders ON o_custkey = c_custkey JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON s_suppkey = l_suppkey
WHERE c_nationkey = 3 GROUP BY 1 ORDER BY n_orders DESC, s_nationkey LIMIT 10""")
def fact_fact_bridge(t: Load) -> DataFrame:
    own = t("customer").where("c_nationkey = 3").select(c("c_custkey").alias("o_custkey"))
    orders = R.semi(t("orders").select("o_custkey", "o_orderkey"), own, "o_custkey")
    lines = t("lineitem").select(c("l_orderkey").alias("o_orderkey"), c("l_suppkey").alias("s_suppkey")).distinct()
    counts = orders.join(lines, "o_orderkey").join(t("supplier").select("s_suppkey", "s_nationkey"), "s_suppkey").groupBy("s_nationkey").agg(F.countDistinct("o_orderkey").alias("n_orders"))
    return R.top_k(counts, [c("n_orders").desc(), c("s_nationkey")], 10)


@query("""
WITH b AS (SELECT item_id, list_distinct(list_transform(regexp_extract_all(text, '[a-zA-Z]{5,}'), lambda x: lower(x))) AS w FROM benchmark),
p AS (SELECT a.item_id, b.item_id AS other, len(list_intersect(a.w, b.w)) AS shared FROM b a JOIN b b ON b.item_id = a.item_id + 1)
SELECT item_id, other, shared::INT AS shared FROM p""")
def token_set_overlap(t: Load) -> DataFrame:
    b = t("benchmark").select("item_id", X.late_tokens(c("text")).alias("w"))
    after = b.select((c("item_id") - 1).alias("item_id"), c("item_id").alias("other"), c("w").alias("v"))
    return b.join(after, "item_id").select("item_id", "other", F.size(F.array_intersect("w", "v")).alias("shared"))


_SHORT = "SELECT p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN split_part(p_name, ' ', 1) WHEN p_partkey % 3 = 1 THEN p_name ELSE p_name || ' limited' END AS name FROM part"


@query(f"""
WITH a AS ({_SHORT}), b AS (SELECT s_suppkey AS rid, p_name || CASE WHEN s_suppkey % 2 = 0 THEN ' company' ELSE '' END AS name FROM supplier JOIN part ON p_partkey = s_suppkey),
x AS (SELECT id, rid, list_distinct(string_split(a.name, ' ')) AS u, list_distinct(string_split(b.name, ' ')) AS v FROM a JOIN b ON split_part(a.name, ' ', 1) = split_part(b.name, ' ', 1)),
y AS (SELECT id, rid, row_number() OVER (PARTITION BY id ORDER BY rid) AS n FROM x WHERE list_has_all(u, v) OR list_has_all(v, u))
SELECT id, rid, 100.0::DOUBLE AS similarity, 'fuzzy_high' AS match_method FROM y WHERE n = 1""")
def blocked_subset_bridge(t: Load) -> DataFrame:
    p = t("part").select("p_partkey", "p_name")
    k = c("p_partkey") % 3
    name = F.when(k == 0, F.split_part("p_name", F.lit(" "), F.lit(1))).when(k == 1, c("p_name")).otherwise(F.concat("p_name", F.lit(" limited")))
    left = t("part").select(c("p_partkey").alias("id"), name.alias("normalized_name"))
    right = t("supplier").select(c("s_suppkey").alias("p_partkey")).join(p, "p_partkey").select(c("p_partkey").alias("rid"), F.concat("p_name", F.when(c("p_partkey") % 2 == 0, " company").otherwise("")).alias("normalized_name"))
    return matching.blocked_bridge(left, right, "id", "rid").select("id", "rid", "similarity", "match_method")


@query(f"""
WITH q AS (SELECT item_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '[a-zA-Z]{{5,}}'), lambda x: lower(x)))) AS tok FROM benchmark),
d AS (SELECT doc_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '[a-zA-Z]{{5,}}'), lambda x: lower(x)))) AS tok FROM documents),
k AS (SELECT tok FROM d GROUP BY 1 HAVING count(*) <= {matching.MOST_POSTINGS}),
s AS (SELECT item_id, doc_id, count(*) AS shared FROM q JOIN d ON d.tok = q.tok WHERE d.tok IN (SELECT tok FROM k) GROUP BY 1, 2)
SELECT item_id, doc_id, shared FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY shared DESC, doc_id) AS n FROM s) WHERE n <= {matching.MOST_CANDIDATES}""")
def inverted_index_topk(t: Load) -> DataFrame:
    tokens = lambda df, key: df.select(key, X.late_tokens(c("text")).alias("tokens"))
    return matching.candidates(tokens(t("benchmark"), "item_id"), tokens(t("documents"), "doc_id"), "item_id", "doc_id")


# --- ordering, lists, windows --------------------------------------------------------------------------------------------


@query("SELECT p_brand, array_to_string(list(p_type || ':' || n ORDER BY n DESC, p_type), '|') AS types FROM (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) GROUP BY 1")
def ordered_list(t: Load) -> DataFrame:
    counts = t("part").groupBy("p_brand", "p_type").agg(F.count("*").alias("n"))
    return counts.groupBy("p_brand").agg(F.array_join(R.ordered_list([-c("n"), c("p_type")], F.concat("p_type", F.lit(":"), c("n").cast("string"))), "|").alias("types"))


@query("SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def ordered_string_agg(t: Load) -> DataFrame:
    return t("nation").groupBy("n_regionkey").agg(R.ordered_string([c("n_name")], c("n_name")).alias("names"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY nullif(o_orderstatus, 'P') NULLS LAST, o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def distinct_on_first(t: Load) -> DataFrame:
    order = [F.nullif(c("o_orderstatus"), F.lit("P")).asc_nulls_last(), c("o_orderdate"), c("o_orderkey")]
    return R.first_per_key(t("orders"), "o_custkey", order).select("o_custkey", "o_orderkey", "o_totalprice")


@query("""
SELECT l_returnflag, l_suppkey, qty, rnk::INT AS rnk FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY qty DESC, l_suppkey) AS rnk
 FROM (SELECT l_returnflag, l_suppkey, sum(l_quantity) AS qty FROM lineitem GROUP BY 1, 2)) WHERE rnk <= 3""")
def top_k_per_group(t: Load) -> DataFrame:
    sums = t("lineitem").groupBy("l_returnflag", "l_suppkey").agg(F.sum("l_quantity").alias("qty"))
    return R.ranked(sums, "l_returnflag", [c("qty").desc(), c("l_suppkey")]).where("rnk <= 3")


@query("SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 30")
def top_k_global(t: Load) -> DataFrame:
    return R.top_k(t("lineitem").groupBy("l_partkey").agg(F.count("*").alias("n")), [c("n").desc(), c("l_partkey")], 30)


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%Ring%' ORDER BY p_name, p_partkey LIMIT 50")
def ilike_search(t: Load) -> DataFrame:
    return R.top_k(t("part").where(R.contains_ignoring_case(c("p_name"), "Ring")).select("p_partkey", "p_name"), [c("p_name"), c("p_partkey")], 50)


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY 1")
def filter_scope_params(t: Load) -> DataFrame:
    return t("orders").where(R.within({"o_orderpriority": ["1-URGENT", "2-HIGH"], "o_orderstatus": None})).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


@query("SELECT n_regionkey AS year FROM nation UNION SELECT s_nationkey FROM supplier")
def union_distinct(t: Load) -> DataFrame:
    return t("nation").select(c("n_regionkey").alias("year")).union(t("supplier").select("s_nationkey")).distinct()


# --- text ----------------------------------------------------------------------------------------------------------------


@query("""
WITH e AS (SELECT lang, doc_id, unnest(list_distinct(list_transform(regexp_extract_all(text, '[a-zA-Z]{5,}'), lambda x: lower(x)))) AS token FROM documents),
k AS (SELECT lang, token, count(*) AS n FROM e GROUP BY 1, 2)
SELECT lang, token, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS r FROM k) WHERE r <= 20""")
def explode_tokens(t: Load) -> DataFrame:
    each = t("documents").select("lang", F.explode(X.late_tokens(c("text"))).alias("token"))
    return R.first_per_key(each.groupBy("lang", "token").agg(F.count("*").alias("n")), "lang", [c("n").desc(), c("token")], 20)


@query("""
SELECT vec_id, count(*) AS n, count(b) AS n_paired, round(sum(a::DOUBLE), 4) AS total
FROM (SELECT vec_id, unnest(embedding) AS a, unnest(embedding[1:20]) AS b FROM embeddings) GROUP BY 1""")
def parallel_unnest(t: Load) -> DataFrame:
    pairs = t("embeddings").select("vec_id", c("embedding").alias("a"), F.slice("embedding", 1, 20).alias("b")).select("vec_id", F.explode(F.arrays_zip("a", "b")).alias("p"))
    return pairs.groupBy("vec_id").agg(F.count("*").alias("n"), F.count("p.b").alias("n_paired"), F.round(F.sum(c("p.a").cast("double")), 4).alias("total"))


@query("SELECT min(s_name) AS name, s_nationkey, count(*) AS n FROM supplier WHERE s_acctbal > 0 AND trim(s_name) <> '' GROUP BY 2")
def org_layer1_dedup(t: Load) -> DataFrame:
    return t("supplier").where((c("s_acctbal") > 0) & (F.trim("s_name") != "")).groupBy("s_nationkey").agg(F.min("s_name").alias("name"), F.count("*").alias("n"))


@query("""
SELECT p_partkey, rtrim(ltrim(regexp_replace(array_to_string(list_slice(string_split(lower(p_name || ' & ' || p_brand || ' of ' || p_type), ' '), 1, 4), '_'), '[^a-z0-9]+', '_', 'g'), '_'), '_') AS slug FROM part""")
def slugify(t: Load) -> DataFrame:
    return t("part").select("p_partkey", X.slug(F.concat("p_name", F.lit(" & "), "p_brand", F.lit(" of "), "p_type")).alias("slug"))


@query("""
WITH n AS (SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN s_name || ' Co., Ltd.' WHEN 1 THEN s_name || ' N.V.' WHEN 2 THEN 'The ' || s_name || ' Holdings Group' ELSE s_name || ' Labs-GmbH' END AS name FROM supplier),
a AS (SELECT s_suppkey, regexp_replace(lower(name), '\\bn\\.v\\.?', 'nv', 'g') AS x FROM n),
b AS (SELECT s_suppkey, trim(regexp_replace(regexp_replace(x, '[^a-z0-9\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS x FROM a)
SELECT s_suppkey, regexp_replace(x, '( (co|ltd|nv|holdings|group|gmbh))+$', '') AS name FROM b""".replace("\\\\", "\\"))
def normalize_name(t: Load) -> DataFrame:
    k = c("s_suppkey") % 4
    name = F.when(k == 0, F.concat("s_name", F.lit(" Co., Ltd."))).when(k == 1, F.concat("s_name", F.lit(" N.V."))).when(k == 2, F.concat(F.lit("The "), "s_name", F.lit(" Holdings Group"))).otherwise(F.concat("s_name", F.lit(" Labs-GmbH")))
    return t("supplier").select("s_suppkey", X.organisation_name(name).alias("name"))


_GATE = """SELECT doc_id, lang, trim(split_part(text, chr(10), 1)) AS title, trim(substr(text, length(split_part(text, chr(10), 1)) + 2)) AS abstract FROM documents"""


@query(f"""
WITH d AS ({_GATE}) SELECT doc_id, CASE WHEN length(abstract) < 50 THEN CASE WHEN title <> '' THEN 'title' END WHEN lang = 'en' THEN 'abstract' END AS text_source,
 CASE WHEN length(abstract) < 50 AND title = '' THEN 'no_usable_text' WHEN length(abstract) >= 50 AND lang <> 'en' THEN 'non_english_content' END AS reason FROM d""")
def gate_text_source(t: Load) -> DataFrame:
    first = F.split_part("text", F.lit("\n"), F.lit(1))
    rest = F.substr("text", F.length(first) + 2)
    g = t("documents").select("doc_id", gate.gated_text(first, rest, lambda _: c("lang")).alias("g"))
    return g.select("doc_id", "g.text_source", "g.reason")


_TITLES = "SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN replace(p_name, ' ', '-') || ' v' || p_size || '.' || p_partkey % 10 WHEN 1 THEN p_brand || ' 1.2' WHEN 2 THEN 'lib' || p_size || ': other 2.0.1 (beta)' ELSE p_name END AS title FROM part"


@query(f"""SELECT p_partkey, title FROM ({_TITLES}) WHERE NOT regexp_matches(title, '{X.STAGED_VERSION_TITLE}')""")
def version_title_regex(t: Load) -> DataFrame:
    k, name = c("p_partkey") % 4, c("p_name")
    title = F.when(k == 0, F.concat(F.replace(name, F.lit(" "), F.lit("-")), F.lit(" v"), c("p_size").cast("string"), F.lit("."), (c("p_partkey") % 10).cast("string"))).when(k == 1, F.concat("p_brand", F.lit(" 1.2"))).when(k == 2, F.concat(F.lit("lib"), c("p_size").cast("string"), F.lit(": other 2.0.1 (beta)"))).otherwise(name)
    return t("part").select("p_partkey", title.alias("title")).where(~X.staged_version_title(c("title")))


@query("SELECT page_id, lower(regexp_extract(url, 'https?://([^/?]+)', 1)) AS host, coalesce(nullif(rtrim(regexp_extract(url, '[0-9]+', 0), '07'), ''), 'none') AS code FROM pages")
def host_extract(t: Load) -> DataFrame:
    return t("pages").select("page_id", F.lower(F.regexp_extract("url", "https?://([^/?]+)", 1)).alias("host"), F.coalesce(F.nullif(F.rtrim(F.regexp_extract("url", "[0-9]+", 0), F.lit("07")), F.lit("")), F.lit("none")).alias("code"))


@query(f"""
WITH r AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN p_name ELSE 'See ' || p_name || ', doi:10.' || (1000 + p_size) || '/X' || p_partkey || '(A).;' END AS ref FROM part)
SELECT p_partkey, nullif(rtrim(lower(regexp_extract(ref, '{X.DOI_PATTERN}', 0)), '.,;:'), '') AS doi, lower(regexp_replace('https://dx.doi.org/10.1/' || p_partkey, '{X.DOI_PREFIX}', '')) AS bare FROM r""")
def doi_extract(t: Load) -> DataFrame:
    key = c("p_partkey").cast("string")
    ref = F.when(c("p_partkey") % 3 == 0, c("p_name")).otherwise(F.concat(F.lit("See "), "p_name", F.lit(", doi:10."), (c("p_size") + 1000).cast("string"), F.lit("/X"), key, F.lit("(A).;")))
    return t("part").select("p_partkey", X.doi_in(ref).alias("doi"), X.bare_doi(F.concat(F.lit("https://dx.doi.org/10.1/"), key)).alias("bare"))


@query("SELECT item_id, text AS abstract FROM (SELECT item_id, array_to_string(list_filter(string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' '), lambda x: x <> ''), ' ') AS text FROM benchmark)".replace("\\\\", "\\"))
def abstract_reconstruct(t: Load) -> DataFrame:
    words = t("benchmark").select("item_id", F.posexplode(F.array_remove(F.split("text", r"\s+"), "")).alias("at", "word"))
    places = words.groupBy("item_id", "word").agg(F.collect_list("at").alias("places"))
    inverted = places.groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "places"))).alias("inverted"))
    return inverted.select("item_id", X.abstract_of(c("inverted")).alias("abstract"))


@query("WITH b AS (SELECT substr(md5(id), 1, 3) AS bucket, sha256(string_agg(id, chr(10) ORDER BY id)) AS digest FROM (SELECT DISTINCT doc_id::VARCHAR AS id FROM documents WHERE doc_id IS NOT NULL) GROUP BY 1) SELECT substr(sha256(string_agg(digest, '' ORDER BY bucket)), 1, 16) AS signature FROM b")
def corpus_signature(t: Load) -> DataFrame:
    return R.signature(t("documents"), "doc_id")


_CLASSES = "CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 ELSE -1 END"


@query(f"""
WITH d AS (SELECT doc_id, {_CLASSES} AS label, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}]{{2,}}'), lambda x: x NOT IN ({", ".join("'" + w + "'" for w in C.STOP_WORDS)})) AS w FROM documents WHERE {_CLASSES} >= 0),
p AS (SELECT doc_id, label, w, unnest(range(1, len(w)::BIGINT)) AS i FROM d),
e AS (SELECT label, unnest(w) AS term FROM d UNION ALL SELECT label, w[i] || ' ' || w[i + 1] FROM p),
k AS (SELECT label, term, count(*) AS n FROM e GROUP BY 1, 2),
v AS (SELECT term, sum(n) AS total, count(*) AS df FROM k GROUP BY 1 ORDER BY total DESC, term LIMIT {C.FEATURES}),
x AS (SELECT k.label, k.term, k.n, v.df, sum(k.n) OVER (PARTITION BY k.label) AS tot FROM k JOIN v ON v.term = k.term),
s AS (SELECT label, term, n / (tot + 1e-9::DOUBLE) * ln((SELECT count(DISTINCT label) FROM d) / (df + 1e-9::DOUBLE)) AS weight FROM x)
SELECT label, term, round(weight, 6) AS weight, rank::INT AS rank FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(weight, 12) DESC, term) AS rank FROM s) WHERE rank <= 15""")
def ctfidf_terms(t: Load) -> DataFrame:
    label = F.when(c("lang") == "en", 0).when(c("lang") == "de", 1).when(c("lang") == "fr", 2).otherwise(-1)
    return C.terms(t("documents").select(label.alias("label"), "text")).select("label", "term", F.round("weight", 6).alias("weight"), "rank")


# --- numbers, rules, evaluation ------------------------------------------------------------------------------------------


@query("""
WITH m AS (SELECT label, list(x ORDER BY i) AS m FROM (SELECT label, i, avg(embedding[i]::DOUBLE) AS x FROM embeddings, range(1, 65) r(i) GROUP BY 1, 2) GROUP BY 1)
SELECT vec_id, e.label, round(list_dot_product(embedding::DOUBLE[], m) / (sqrt(list_dot_product(m, m)) * sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))), 4) AS cos FROM embeddings e JOIN m ON m.label = e.label""")
def cosine_centroid(t: Load) -> DataFrame:
    e = t("embeddings")
    means = F.broadcast(C.centroids(e, "label"))  # one row a label
    return e.join(means, "label").select("vec_id", "label", F.round(C.cosine(c("embedding"), c("centroid")), 4).alias("cos"))


@query("""
WITH y AS (SELECT year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY 1), m AS (SELECT max(year) AS top, 2.5::DOUBLE AS lag FROM y)
SELECT year, n, CASE WHEN year <= top - greatest(1, round_even(lag, 0)) THEN n END AS solid, CASE WHEN year >= top - greatest(1, round_even(lag, 0)) THEN n END AS provisional FROM y, m WHERE year >= 1996""")
def grant_cutoff_split(t: Load) -> DataFrame:
    years = t("orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.count("*").alias("n"))
    top = years.agg(F.max("year").alias("top"))
    shown = serving.velocity_series(years.crossJoin(F.broadcast(top)).withColumnRenamed("n", "patent_count"), c("top"), F.lit(2.5), 1996)  # one row
    return shown.select("year", c("patent_count").alias("n"), "solid", "provisional")


@query("""
WITH k AS (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'O') AS a, count(*) FILTER (o_orderstatus = 'F') AS b FROM orders GROUP BY 1)
SELECT o_custkey, CASE WHEN coalesce(b::DOUBLE / nullif(a + b, 0), 0) >= 0.7 THEN 'Primarily an IP holder' WHEN coalesce(b::DOUBLE / nullif(a + b, 0), 0) <= 0.3 THEN 'Primarily a research institution' ELSE 'Both researcher and IP holder' END AS role FROM k""")
def role_label(t: Load) -> DataFrame:
    counts = t("orders").groupBy("o_custkey").agg(F.count(F.when(c("o_orderstatus") == "O", 1)).alias("a"), F.count(F.when(c("o_orderstatus") == "F", 1)).alias("b"))
    return counts.select("o_custkey", X.role_of(c("a"), c("b")).alias("role"))


@query("""
WITH f AS (SELECT DISTINCT doc_id FROM documents WHERE regexp_matches(lower(text), 'idiot|scum|moron')), g AS (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1),
k AS (SELECT (SELECT count(*) FROM f WHERE doc_id IN (SELECT doc_id FROM g)) AS tp, (SELECT count(*) FROM f) AS nf, (SELECT count(*) FROM g) AS ng)
SELECT tp AS true_positives, nf - tp AS false_positives, ng - tp AS false_negatives, round(coalesce(tp::DOUBLE / nullif(nf, 0), 0), 6) AS precision, round(coalesce(tp::DOUBLE / nullif(ng, 0), 0), 6) AS recall FROM k""")
def prf_eval(t: Load) -> DataFrame:
    found = t("documents").where(F.lower("text").rlike("idiot|scum|moron"))
    out = R.precision_recall(found, t("labels").where("toxic = 1"), ["doc_id"])
    return out.select("true_positives", "false_positives", "false_negatives", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"))


@query("""
SELECT 'accepted_status' AS check, count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS violations FROM orders
UNION ALL SELECT 'customer_exists', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 5 <> 0)
UNION ALL SELECT 'discount_in_range', count(*) FROM lineitem WHERE l_discount < 0 OR l_discount > 0.05
UNION ALL SELECT 'order_known', count(*) FROM orders WHERE o_orderkey IS NULL
UNION ALL SELECT 'order_once', count(*) FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'line_once', count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)""")
def quality_report(t: Load) -> DataFrame:
    o, l = t("orders"), t("lineitem")
    return quality.report({
        "accepted_status": quality.unaccepted(o, "o_orderstatus", ["O", "F"]),
        "customer_exists": quality.orphans(o, "o_custkey", t("customer").where("c_custkey % 5 <> 0"), "c_custkey"),
        "discount_in_range": quality.outside(l, "l_discount", 0, 0.05),
        "order_known": quality.missing(o, "o_orderkey"),
        "order_once": quality.repeated(o, ["o_orderkey"]),
        "line_once": quality.repeated(l, ["l_orderkey", "l_linenumber"]),
    })


@query("""
WITH s AS (SELECT s_suppkey AS id, lower(split_part(p_name, ' ', 1)) || s_nationkey AS name FROM supplier JOIN part ON p_partkey = s_suppkey),
i AS (SELECT n_nationkey AS id, lower(n_name) || ' labs' AS name FROM nation),
rows AS (
  SELECT 0 AS layer, 'org_seed_' || id AS org_id, 'patentsview' AS source, 'A' || id AS source_id, 'Seed ' || id AS canonical_name, 'seed_crosswalk' AS match_method, 'high' AS confidence FROM s WHERE id % 10 = 0
  UNION ALL SELECT 1, 'org_seed_' || id, 'openalex', 'I' || id, name, 'seed_crosswalk', 'high' FROM i WHERE id % 6 = 0
  UNION ALL SELECT 3, CASE WHEN s.id % 10 = 0 THEN 'org_seed_' || s.id ELSE 'org_pv_' || coalesce(replace(s.name, ' ', '_'), 'a' || i.id) END, 'openalex', 'I' || i.id, i.name, 'fuzzy_high', 'high' FROM i LEFT JOIN s ON s.id = i.id WHERE i.id % 6 <> 0 AND i.id % 2 = 0
  UNION ALL SELECT 3, 'org_pv_' || coalesce(replace(s.name, ' ', '_'), 'a' || i.id), 'patentsview', 'A' || i.id, coalesce(s.name, 'A' || i.id), 'fuzzy_high', 'high' FROM i LEFT JOIN s ON s.id = i.id WHERE i.id % 6 <> 0 AND i.id % 2 = 0 AND (s.id IS NULL OR s.id % 10 <> 0)
  UNION ALL SELECT 4, 'org_pv_' || replace(name, ' ', '_'), 'patentsview', 'A' || id, name, 'native_id', 'high' FROM s
  UNION ALL SELECT 5, 'org_oa_' || replace(name, ' ', '_'), 'openalex', 'I' || id, name, 'ror', 'high' FROM i)
SELECT org_id, source, source_id, canonical_name, match_method, confidence FROM (SELECT *, row_number() OVER (PARTITION BY source, source_id ORDER BY layer) AS n FROM rows) WHERE n = 1""")
def crosswalk_cascade(t: Load) -> DataFrame:
    s = t("supplier").select(c("s_suppkey").alias("id"), "s_nationkey").join(t("part").select(c("p_partkey").alias("id"), "p_name"), "id").select("id", F.concat(F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))), c("s_nationkey").cast("string")).alias("name"))
    i = t("nation").select(c("n_nationkey").cast("bigint").alias("id"), F.concat(F.lower("n_name"), F.lit(" labs")).alias("name"))
    pv = s.select(F.concat(F.lit("A"), c("id").cast("string")).alias("assignee_id"), c("name").alias("display_name"), c("name").alias("normalized_name"), "id")
    oa = i.select(F.concat(F.lit("I"), c("id").cast("string")).alias("institution_id"), c("name").alias("display_name"), c("name").alias("normalized_name"), "id")
    org = F.concat(F.lit("org_seed_"), c("id").cast("string"))
    how = [F.lit("seed_crosswalk").alias("match_method"), F.lit("high").alias("confidence")]
    seed = pv.where("id % 10 = 0").select(org.alias("org_id"), F.concat(F.lit("Seed "), c("id").cast("string")).alias("canonical_name"), "assignee_id", "display_name", *how)
    seed_oa = oa.where("id % 6 = 0").select(org.alias("org_id"), F.lit("x").alias("canonical_name"), "institution_id", "display_name", *how)
    bridge = oa.where("id % 2 = 0").select("institution_id", F.concat(F.lit("A"), c("id").cast("string")).alias("assignee_id"), F.lit(100.0).alias("similarity"), F.lit("fuzzy_high").alias("match_method"), F.lit("high").alias("confidence"))
    return matching.crosswalk(seed, seed_oa, seed_oa.limit(0), bridge, pv, oa)


# --- the star schema over the test tables --------------------------------------------------------------------------------

#: Relations shaped like the facts, in SQL that both engines read; {name} is a test table.
_SHAPES = {
    "filings": """
SELECT concat('P', o_orderkey) AS patent_id, cast(o_orderdate AS date) AS filing_date,
       CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE cast(cast(o_orderdate AS date) + INTERVAL '900' DAY AS date) END AS grant_date,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'G03F7/20' WHEN '2-HIGH' THEN 'H01S5/10' WHEN '3-MEDIUM' THEN 'G02B6/12' WHEN '5-LOW' THEN 'G11C13/00' ELSE 'A61K9/00' END AS primary_cpc,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'euv' WHEN '2-HIGH' THEN 'lasers' WHEN '3-MEDIUM' THEN 'si_photonics' WHEN '5-LOW' THEN 'in_memory' END AS family_id,
       l_linenumber - 1 AS assignee_sequence, CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE concat('org_', l_suppkey % 40) END AS org_id,
       CASE WHEN o_custkey % 11 = 0 THEN NULL WHEN o_custkey % 11 = 1 THEN 'c_noise' ELSE concat('c_', o_custkey % 11) END AS cluster_id
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey""",
    "publications": """
SELECT concat('W', c_custkey) AS work_id, cast(1993 + c_custkey % 8 AS int) AS publication_year, make_date(cast(1993 + c_custkey % 8 AS int), cast(1 + c_custkey % 12 AS int), 1) AS publication_date,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'euv' WHEN 'MACHINERY' THEN 'neuromorphic' WHEN 'HOUSEHOLD' THEN 'si_photonics' WHEN 'FURNITURE' THEN 'in_memory' END AS family_id,
       institution_id, CASE WHEN c_nationkey % 4 = 0 THEN NULL ELSE concat('org_', c_nationkey) END AS org_id,
       CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 13 = 1 THEN 'c_noise' ELSE concat('c_', c_custkey % 13) END AS cluster_id
FROM (SELECT *, concat('I', c_nationkey) AS institution_id FROM {customer} UNION ALL SELECT *, concat('J', c_custkey % 5) AS institution_id FROM {customer} WHERE c_custkey % 2 = 0) x""",
    "links": """
SELECT DISTINCT concat('P', o_orderkey) AS patent_id, concat('W', c_custkey) AS work_id, CASE WHEN l_partkey % 2 = 0 THEN 'high' ELSE 'medium' END AS confidence,
       round(cast(datediff('day', make_date(cast(1993 + c_custkey % 8 AS int), cast(1 + c_custkey % 12 AS int), 1), cast(o_orderdate AS date)) AS double) / cast(365.25 AS double), 2) AS citation_lag_years
FROM {lineitem} JOIN {orders} ON l_orderkey = o_orderkey JOIN {customer} ON c_custkey = l_partkey
WHERE make_date(cast(1993 + c_custkey % 8 AS int), cast(1 + c_custkey % 12 AS int), 1) < cast(o_orderdate AS date)""",
    "clusters": "SELECT concat('c_', n_nationkey) AS cluster_id, concat('Tag ', n_name) AS tagline FROM {nation} WHERE n_nationkey < 12 UNION ALL SELECT 'c_noise', 'Noise' FROM {nation} WHERE n_nationkey = 0",
    "orgs": "SELECT concat('org_', s_suppkey) AS org_id, concat('Org ', s_name) AS canonical_name, 'native_id' AS primary_match_method, 'high' AS primary_confidence FROM {supplier} WHERE s_suppkey < 35",
}
_SPARK_WORDS = (("datediff('day', ", "datediff(DAY, "), ("list_value(", "array("))
_TABLES = ("lineitem", "orders", "customer", "nation", "supplier")


def shaped(t: Load, name: str) -> DataFrame:
    frames = {k: t(k) for k in _TABLES if "{" + k + "}" in _SHAPES[name]}
    text = _SHAPES[name]
    for theirs, ours in _SPARK_WORDS:
        text = text.replace(theirs, ours)
    return next(iter(frames.values())).sparkSession.sql(text, **frames)


def _with(names: str, rest: str) -> str:
    parts = ", ".join(f"{n} AS ({_SHAPES[n].format(**{k: k for k in _TABLES})})" for n in names.split())
    return f"WITH {parts}, {rest}"


@query(_with("filings publications clusters", """
a AS (SELECT cluster_id, publication_year AS year, count(DISTINCT work_id) AS n FROM publications WHERE cluster_id IS NOT NULL GROUP BY 1, 2),
b AS (SELECT cluster_id, year(filing_date)::INT AS year, count(DISTINCT patent_id) AS n FROM filings WHERE cluster_id IS NOT NULL GROUP BY 1, 2),
s AS (SELECT cluster_id, year FROM a UNION SELECT cluster_id, year FROM b)
SELECT s.cluster_id, tagline, s.cluster_id = 'c_noise' AS is_noise, s.year, coalesce(a.n, 0) AS paper_count, coalesce(b.n, 0) AS patent_count
FROM s JOIN clusters c ON c.cluster_id = s.cluster_id LEFT JOIN a ON a.cluster_id = s.cluster_id AND a.year = s.year LEFT JOIN b ON b.cluster_id = s.cluster_id AND b.year = s.year"""))
def mart_velocity(t: Load) -> DataFrame:
    return marts.velocity(shaped(t, "publications"), shaped(t, "filings"), shaped(t, "clusters"))


@query(_with("filings publications clusters orgs", """
d AS (SELECT cluster_id, 'patent' AS side, org_id, family_id, patent_id AS doc FROM filings WHERE cluster_id IS NOT NULL UNION ALL SELECT cluster_id, 'paper', org_id, family_id, work_id FROM publications WHERE cluster_id IS NOT NULL),
k AS (SELECT cluster_id, side, coalesce(org_id, 'unresolved') AS org_id_key, org_id, coalesce(family_id, 'unattributed') AS family_id_key, family_id, count(DISTINCT doc) AS doc_count FROM d GROUP BY ALL),
t AS (SELECT cluster_id, side, count(DISTINCT doc) AS cluster_total FROM d GROUP BY ALL),
q AS (SELECT cluster_id, side, org_id_key, sum(doc_count) AS n FROM k GROUP BY 1, 2, 3),
r AS (SELECT cluster_id, side, org_id_key, row_number() OVER (PARTITION BY cluster_id, side ORDER BY n DESC, org_id_key)::INT AS rank_in_cluster FROM q)
SELECT k.cluster_id, tagline, k.side, k.org_id_key, k.org_id, family_id_key, family_id, coalesce(canonical_name, 'Unresolved') AS canonical_name, coalesce(primary_match_method, 'none') AS match_method,
       coalesce(primary_confidence, 'low') AS confidence, doc_count, round(doc_count::DOUBLE / cluster_total, 4) AS share, cluster_total, rank_in_cluster
FROM k JOIN clusters c ON c.cluster_id = k.cluster_id JOIN t ON t.cluster_id = k.cluster_id AND t.side = k.side JOIN r ON r.cluster_id = k.cluster_id AND r.side = k.side AND r.org_id_key = k.org_id_key LEFT JOIN orgs o ON o.org_id = k.org_id"""))
def mart_competitive(t: Load) -> DataFrame:
    return marts.competitive(shaped(t, "publications"), shaped(t, "filings"), shaped(t, "clusters"), shaped(t, "orgs"))


def _bridge(t: Load) -> DataFrame:
    return shaped(t, "filings").select(c("patent_id").alias("doc_id"), F.lit("patent").alias("doc_type"), "cluster_id").distinct()


@query(_with("filings publications links clusters", """
p AS (SELECT cluster_id, org_id FROM (SELECT *, row_number() OVER (PARTITION BY patent_id ORDER BY CASE WHEN assignee_sequence = 0 THEN 0 WHEN assignee_sequence IS NULL THEN 2 ELSE 1 END, assignee_sequence, org_id NULLS LAST) AS n FROM filings WHERE cluster_id IS NOT NULL) WHERE n = 1),
k AS (SELECT cluster_id, org_id, count(*) AS n FROM p GROUP BY 1, 2),
s AS (SELECT cluster_id, sum(n) AS total, sum(n) FILTER (org_id IS NULL) AS un, sum(n) FILTER (org_id IS NOT NULL) AS res FROM k GROUP BY 1),
h AS (SELECT k.cluster_id, round(sum((n::DOUBLE / res) * (n::DOUBLE / res)), 4) AS hhi, count(DISTINCT org_id) AS n_assignees, max(total) AS total, max(un) AS un, max(res) AS res FROM k JOIN s ON s.cluster_id = k.cluster_id WHERE org_id IS NOT NULL GROUP BY 1),
b AS (SELECT cluster_id, count(DISTINCT institution_id) AS n_inst, count(DISTINCT org_id) AS n_org, count(DISTINCT work_id) AS n_papers, median(publication_year) AS pub FROM publications WHERE cluster_id IS NOT NULL GROUP BY 1),
f AS (SELECT cluster_id, median(year(filing_date)) AS filed FROM filings WHERE cluster_id IS NOT NULL GROUP BY 1),
g AS (SELECT DISTINCT patent_id, cluster_id FROM filings WHERE cluster_id IS NOT NULL),
l AS (SELECT cluster_id, count(*) AS n, round(median(citation_lag_years), 2) AS med FROM links JOIN g ON g.patent_id = links.patent_id GROUP BY 1)
SELECT c.cluster_id, tagline, c.cluster_id = 'c_noise' AS is_noise, coalesce(h.total, 0)::BIGINT AS n_patents, coalesce(n_assignees, 0) AS n_assignees, round(coalesce(un, 0) * 100.0::DOUBLE / nullif(coalesce(h.total, 0), 0), 1) AS pct_unresolved_patents,
       CASE WHEN coalesce(res, 0) >= 10 THEN hhi END AS hhi, coalesce(res, 0) >= 10 AS hhi_reportable, coalesce(n_inst, 0) AS n_oa_institutions, coalesce(n_org, 0) AS n_research_orgs, coalesce(n_papers, 0) AS n_papers,
       CASE WHEN coalesce(l.n, 0) >= 20 THEN med END AS npl_median_lag_years, coalesce(l.n, 0) AS npl_n_links, coalesce(l.n, 0) >= 20 AS npl_reportable,
       CASE WHEN filed IS NOT NULL THEN round(pub, 1) END AS cohort_med_pub_year, CASE WHEN pub IS NOT NULL THEN round(filed, 1) END AS cohort_med_filing_year, round(filed - pub, 1) AS cohort_lag_years
FROM clusters c LEFT JOIN h ON h.cluster_id = c.cluster_id LEFT JOIN b ON b.cluster_id = c.cluster_id LEFT JOIN f ON f.cluster_id = c.cluster_id LEFT JOIN l ON l.cluster_id = c.cluster_id"""))
def mart_gap(t: Load) -> DataFrame:
    return marts.gap(shaped(t, "publications"), shaped(t, "filings"), shaped(t, "links"), _bridge(t), shaped(t, "clusters"))


@query(_with("filings publications links", """
m(family_id, family_name, family_sort_order) AS (VALUES ('euv', 'EUV Lithography', 1), ('lasers', 'Lasers', 2), ('si_photonics', 'Silicon Photonics', 3), ('neuromorphic', 'Neuromorphic', 4), ('in_memory', 'In-Memory Compute', 5)),
p AS (SELECT family_id, count(DISTINCT patent_id) AS n, count(DISTINCT org_id) AS o FROM filings WHERE family_id IS NOT NULL GROUP BY 1),
w AS (SELECT family_id, count(DISTINCT work_id) AS n, count(DISTINCT org_id) AS o FROM publications WHERE family_id IS NOT NULL GROUP BY 1),
g AS (SELECT DISTINCT patent_id, family_id, filing_date, grant_date FROM filings WHERE family_id IS NOT NULL),
l AS (SELECT family_id, count(*) AS n, round(median(citation_lag_years), 2) AS med FROM links JOIN g ON g.patent_id = links.patent_id GROUP BY 1),
a AS (SELECT family_id, round(avg(date_diff('day', filing_date, grant_date) / 365.25::DOUBLE), 2) AS lag FROM g WHERE grant_date IS NOT NULL GROUP BY 1)
SELECT m.family_id, family_name, family_sort_order::INT AS family_sort_order, coalesce(w.n, 0) AS n_papers, coalesce(p.n, 0) AS n_patents, round(coalesce(p.n, 0)::DOUBLE / nullif((SELECT sum(n) FROM p), 0), 3) AS patent_share,
       coalesce(w.o, 0) AS n_research_orgs_sum, coalesce(p.o, 0) AS n_assignees_sum, CASE WHEN coalesce(l.n, 0) >= 20 THEN med END AS median_lag_years_weighted, coalesce(l.n, 0) AS total_npl_links, a.lag AS avg_grant_lag_years
FROM m LEFT JOIN p ON p.family_id = m.family_id LEFT JOIN w ON w.family_id = m.family_id LEFT JOIN l ON l.family_id = m.family_id LEFT JOIN a ON a.family_id = m.family_id"""))
def mart_family(t: Load) -> DataFrame:
    filings = shaped(t, "filings")
    return marts.family(shaped(t, "publications"), filings, shaped(t, "links"), filings.select("patent_id", "filing_date", "grant_date").distinct())


@query(_with("filings clusters", """
v AS (SELECT cluster_id, CASE WHEN primary_cpc LIKE 'G03F%' THEN 'euv' WHEN primary_cpc LIKE 'H01S%' OR primary_cpc LIKE 'G02B%' THEN 'silicon_photonics' WHEN primary_cpc LIKE 'G11C%' THEN 'neuromorphic_in_memory' ELSE 'mixed' END AS vote
      FROM (SELECT DISTINCT cluster_id, patent_id, primary_cpc FROM filings WHERE cluster_id <> 'c_noise')),
k AS (SELECT cluster_id, vote, count(*) AS n FROM v GROUP BY 1, 2)
SELECT c.cluster_id, coalesce((SELECT arg_min(vote, (-n, vote)) FROM k WHERE k.cluster_id = c.cluster_id AND vote <> 'mixed'
  HAVING max(n)::DOUBLE / sum(n) >= 0.45 AND sum(n)::DOUBLE / (SELECT sum(n) FROM k k2 WHERE k2.cluster_id = c.cluster_id) >= 0.5), 'mixed') AS label
FROM clusters c WHERE c.cluster_id <> 'c_noise'"""))
def cluster_family_votes(t: Load) -> DataFrame:
    votes = shaped(t, "filings").where("cluster_id is not null and cluster_id <> 'c_noise'").select("cluster_id", "patent_id", "primary_cpc").distinct().select("cluster_id", X.patent_vote(c("primary_cpc")).alias("vote"))
    label = marts.dominant_votes(votes, "cluster_id", "vote", "mixed", 0.45, 0.5)
    return shaped(t, "clusters").where("cluster_id <> 'c_noise'").select("cluster_id").join(label, "cluster_id", "left").select("cluster_id", F.coalesce("label", F.lit("mixed")).alias("label"))


def star(t: Load) -> serving.Star:
    filings, publications, links, names, orgs = (shaped(t, k) for k in ("filings", "publications", "links", "clusters", "orgs"))
    named = names.withColumn("summary_friendly", F.lit("s")).withColumn("top_terms", F.array(F.lit("t")))
    dim_patent = filings.select("patent_id", F.concat(F.lit("Title of "), "patent_id").alias("title"), "filing_date", "grant_date").distinct()
    dim_paper = publications.select("work_id", F.concat(F.lit("Paper "), "work_id").alias("title"), "publication_date", F.lit("a").alias("abstract"), F.lit("topic").alias("primary_topic_name")).distinct()
    families = named.where("cluster_id <> 'c_noise'").select("cluster_id", F.lit("mixed").alias("family_id"), F.lit("Mixed").alias("family_name"))
    return serving.Star(
        publications, filings, links, orgs, dim_paper, dim_patent, named, marts.competitive(publications, filings, named, orgs),
        marts.gap(publications, filings, links, _bridge(t), named), marts.family(publications, filings, links, dim_patent), families,
    )


@query(_with("filings publications clusters orgs", """
d AS (SELECT f.cluster_id, 'patent' AS side, org_id, family_id, patent_id AS doc FROM filings f JOIN clusters c ON c.cluster_id = f.cluster_id UNION ALL SELECT f.cluster_id, 'paper', org_id, family_id, work_id FROM publications f JOIN clusters c ON c.cluster_id = f.cluster_id),
k AS (SELECT cluster_id, side, org_id, family_id, count(DISTINCT doc) AS n FROM d WHERE family_id IS NOT NULL AND cluster_id <> 'c_noise' GROUP BY ALL),
s AS (SELECT family_id, side, canonical_name, sum(n)::BIGINT AS doc_count FROM k JOIN orgs ON orgs.org_id = k.org_id GROUP BY ALL)
SELECT family_id, side, canonical_name, doc_count, rnk::INT AS rnk FROM (SELECT *, row_number() OVER (PARTITION BY family_id, side ORDER BY doc_count DESC, canonical_name) AS rnk FROM s) WHERE rnk <= 3"""))
def family_top_orgs(t: Load) -> DataFrame:
    return serving.family_top_orgs(star(t))


@query(_with("filings publications links", """
a AS (SELECT patent_id, cluster_id, org_id, assignee_sequence FROM filings WHERE family_id = 'euv' AND cluster_id IS NOT NULL AND cluster_id <> 'c_noise')
SELECT (SELECT count(DISTINCT work_id) FROM publications WHERE family_id = 'euv') AS n_papers, (SELECT count(DISTINCT patent_id) FROM filings WHERE family_id = 'euv') AS n_patents,
  round((SELECT count(DISTINCT patent_id) FROM filings WHERE family_id = 'euv')::DOUBLE / (SELECT count(DISTINCT patent_id) FROM filings WHERE family_id IS NOT NULL), 3) AS patent_share,
  (SELECT count(DISTINCT org_id) FROM publications WHERE family_id = 'euv') AS n_research_orgs_sum, (SELECT count(DISTINCT org_id) FROM filings WHERE family_id = 'euv') AS n_assignees_sum,
  (SELECT CASE WHEN count(*) >= 20 THEN round(median(citation_lag_years), 2) END FROM links WHERE patent_id IN (SELECT patent_id FROM filings WHERE family_id = 'euv')) AS median_lag_years_weighted,
  (SELECT count(*) FROM links WHERE patent_id IN (SELECT patent_id FROM filings WHERE family_id = 'euv')) AS total_npl_links,
  (SELECT round(avg(date_diff('day', filing_date, grant_date) / 365.25::DOUBLE), 2) FROM (SELECT DISTINCT patent_id, filing_date, grant_date FROM filings WHERE family_id = 'euv' AND grant_date IS NOT NULL)) AS avg_grant_lag_years"""))
def family_metrics(t: Load) -> DataFrame:
    return serving.family_metrics(star(t), "euv")


@query(_with("filings publications links clusters", """
a AS (SELECT patent_id, cluster_id, org_id, assignee_sequence FROM filings WHERE family_id = 'euv' AND cluster_id <> 'c_noise'),
b AS (SELECT work_id, cluster_id, org_id FROM publications WHERE family_id = 'euv' AND cluster_id <> 'c_noise'),
s AS (SELECT cluster_id FROM a UNION SELECT cluster_id FROM b),
d AS (SELECT cluster_id, family_id, patent_id AS doc FROM filings UNION ALL SELECT cluster_id, family_id, work_id FROM publications),
o AS (SELECT cluster_id, string_agg(family_id, ',' ORDER BY n DESC, family_id) AS others FROM (SELECT cluster_id, family_id, count(DISTINCT doc) AS n FROM d WHERE family_id IS NOT NULL AND family_id <> 'euv' GROUP BY 1, 2) GROUP BY 1),
k AS (SELECT cluster_id, org_id, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY patent_id ORDER BY CASE WHEN assignee_sequence = 0 THEN 0 WHEN assignee_sequence IS NULL THEN 2 ELSE 1 END, assignee_sequence, org_id NULLS LAST) AS r FROM a) WHERE r = 1 GROUP BY 1, 2),
t AS (SELECT cluster_id, sum(n)::BIGINT AS n_patents, sum(n) FILTER (org_id IS NOT NULL) AS res, count(org_id) AS n_assignees FROM k GROUP BY 1),
h AS (SELECT k.cluster_id, round(sum((n::DOUBLE / res) * (n::DOUBLE / res)), 4) AS hhi FROM k JOIN t ON t.cluster_id = k.cluster_id WHERE org_id IS NOT NULL GROUP BY 1),
p AS (SELECT cluster_id, count(DISTINCT work_id) AS n_papers, count(DISTINCT org_id) AS n_research_orgs FROM b GROUP BY 1),
l AS (SELECT cluster_id, count(*) AS n, round(median(citation_lag_years), 2) AS med FROM links JOIN a ON a.patent_id = links.patent_id GROUP BY 1)
SELECT s.cluster_id, tagline, coalesce(n_papers, 0) AS n_papers, coalesce(n_patents, 0) AS n_patents, CASE WHEN coalesce(res, 0) >= 10 THEN hhi END AS hhi, coalesce(res, 0) >= 10 AS hhi_reportable, coalesce(n_research_orgs, 0) AS n_research_orgs,
       coalesce(n_assignees, 0) AS n_assignees, CASE WHEN coalesce(l.n, 0) >= 20 THEN med END AS npl_median_lag_years, coalesce(l.n, 0) AS npl_n_links, coalesce(l.n, 0) >= 20 AS npl_reportable, others AS spillover
FROM s JOIN clusters c ON c.cluster_id = s.cluster_id LEFT JOIN t ON t.cluster_id = s.cluster_id LEFT JOIN h ON h.cluster_id = s.cluster_id LEFT JOIN p ON p.cluster_id = s.cluster_id LEFT JOIN l ON l.cluster_id = s.cluster_id LEFT JOIN o ON o.cluster_id = s.cluster_id"""))
def family_clusters(t: Load) -> DataFrame:
    return serving.family_clusters(star(t), "euv").withColumn("spillover", F.array_join("spillover_family_ids", ",")).drop("top_terms", "spillover_family_ids")


@query(_with("filings publications links orgs", """
x AS (SELECT p.org_id, count(DISTINCT l.work_id) AS n FROM filings f JOIN links l ON l.patent_id = f.patent_id JOIN publications p ON p.work_id = l.work_id WHERE f.org_id = 'org_3' GROUP BY 1)
SELECT x.org_id AS paper_org_id, canonical_name AS paper_org_name, n AS n_papers_cited FROM x JOIN orgs ON orgs.org_id = x.org_id ORDER BY n DESC, x.org_id LIMIT 10"""))
def org_intake(t: Load) -> DataFrame:
    return serving.org_intake(star(t), "org_3")


@query(_with("filings publications links orgs", """
x AS (SELECT f.org_id, count(DISTINCT l.patent_id) AS n FROM publications p JOIN links l ON l.work_id = p.work_id JOIN filings f ON f.patent_id = l.patent_id WHERE p.org_id = 'org_3' GROUP BY 1)
SELECT x.org_id AS patenter_org_id, canonical_name AS patenter_name, n AS n_patents FROM x JOIN orgs ON orgs.org_id = x.org_id ORDER BY n DESC, x.org_id LIMIT 10"""))
def org_influence(t: Load) -> DataFrame:
    return serving.org_influence(star(t), "org_3")


@query(_with("filings links orgs", """
b AS (SELECT patent_id, confidence, citation_lag_years FROM (SELECT *, row_number() OVER (PARTITION BY patent_id ORDER BY CASE confidence WHEN 'high' THEN 0 WHEN 'medium' THEN 1 ELSE 2 END, citation_lag_years NULLS LAST) AS n FROM links WHERE work_id = 'W42') WHERE n = 1),
a AS (SELECT f.patent_id, string_agg(canonical_name, ', ' ORDER BY assignee_sequence NULLS LAST, canonical_name) AS assignee FROM filings f JOIN orgs ON orgs.org_id = f.org_id GROUP BY 1)
SELECT b.patent_id, confidence, citation_lag_years, 'Title of ' || b.patent_id AS patent_title, a.assignee FROM b LEFT JOIN a ON a.patent_id = b.patent_id"""))
def trace_links(t: Load) -> DataFrame:
    s = star(t)
    return serving.trace_links(serving.Star(**vars(s) | {"fact_npl_link": s.fact_npl_link.withColumn("link_source", F.lit("doi"))}), "W42").drop("link_source", "filing_date")


@query(_with("filings publications", """
z AS (SELECT 1)
SELECT (SELECT count(DISTINCT work_id) FROM publications WHERE coalesce(family_id, 'unattributed') IN ('euv', 'unattributed') AND cluster_id IN ('c_2', 'c_3')) AS total_papers,
       (SELECT count(DISTINCT patent_id) FROM filings WHERE coalesce(family_id, 'unattributed') IN ('euv', 'unattributed') AND cluster_id IN ('c_2', 'c_3')) AS total_patents"""))
def dataset_totals(t: Load) -> DataFrame:
    return serving.dataset_totals(star(t), ["euv", "unattributed"], ["c_2", "c_3"])


# --- without SQL ---------------------------------------------------------------------------------------------------------


@query()
def plane_by_pca_density_by_grid(t: Load) -> DataFrame:
    points = materialise(C.plane(t("embeddings"), "vec_id"))
    labels = C.dense_clusters(points, "vec_id", radius=0.25, least=40, smallest=40)
    return points.join(labels, "vec_id").select("vec_id", F.round("umap_x", 4).alias("umap_x"), F.round("umap_y", 4).alias("umap_y"), X.cluster_name(c("label")).alias("cluster_id"))


@query()
def cluster_labels(t: Load) -> DataFrame:
    label = F.when(c("lang") == "en", 0).when(c("lang") == "de", 1).when(c("lang") == "fr", 2).when(c("lang") == "es", 3).otherwise(-1)
    return C.labelled(C.cluster_terms(t("documents").select(label.alias("label"), "text")))


@query()
def text_embedding(t: Load) -> DataFrame:
    e = C.embedded(t("documents").select("doc_id", "text"))
    return e.select("doc_id", F.size("embedding").alias("dims"), F.round(F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x)), 3).alias("norm"), F.round(F.array_max("embedding"), 4).alias("largest"), "truncated")


@query()
def language_guess(t: Load) -> DataFrame:
    return t("documents").select("doc_id", "lang", detect_language("text").alias("guess"))


@query()
def title_scores(t: Load) -> DataFrame:
    """Scores of each benchmark text with the five others that share most tokens with it."""
    b = t("benchmark").select("item_id", F.lower("text").alias("a"), X.late_tokens(c("text")).alias("tokens"))
    other = b.select(c("item_id").alias("other"), c("a").alias("b"), "tokens")
    pairs = matching.candidates(b.select("item_id", "tokens"), other.select("other", "tokens"), "item_id", "other", most=6).where("item_id <> other")
    return pairs.join(b.drop("tokens"), "item_id").join(other.drop("tokens"), "other").select("item_id", "other", F.round(token_set_ratio("a", "b"), 4).alias("score"))
