"""The operators' shapes on the synthetic star schema, each with equivalent DuckDB SQL.

Every query runs over its whole tables.  Results are unordered, so none sorts but for a top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import encode_component, escape_html, format_date, format_range, game_outcome, nz, rank_class, rank_label, safe_int, split_members, utrim
from ..operators import geometry, postings, search
from ..sources import Store, scratch_folder
from ..streaming import landing

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _t(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _long(c):
    return F.col(c).cast("bigint") if isinstance(c, str) else c.cast("bigint")


_DAY = "yyyy-MM-dd"


@_query("""SELECT o_orderkey, strftime(o_orderdate,'%Y-%m-%d') AS day FROM orders
WHERE o_orderstatus='F' AND strftime(o_orderdate,'%Y-%m-%d') LIKE '1997%' AND substr(strftime(o_orderdate,'%Y-%m-%d'),6,2)='03' AND contains(o_orderpriority,'H')""")
def list_filter(spark, sf_dir):
    """Equality, year by range (so that it reaches the scan), month by substring, keyword by contains."""
    o = _t(spark, sf_dir, "orders")
    day = F.date_format("o_orderdate", _DAY)
    year = (F.col("o_orderdate") >= F.lit("1997-01-01").cast("timestamp_ntz")) & (F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return o.where((F.col("o_orderstatus") == "F") & year & (F.substring(day, 6, 2) == "03") & F.col("o_orderpriority").contains("H")).select("o_orderkey", day.alias("day"))


@_query("SELECT p_partkey, p_name FROM part WHERE NOT regexp_matches(p_name,'a[nr]|ea|oo')")
def exclude_regex(spark, sf_dir):
    return _t(spark, sf_dir, "part").where(~F.col("p_name").rlike("a[nr]|ea|oo")).select("p_partkey", "p_name")


@_query("""SELECT c_custkey, coalesce(n_name,'other') AS nation FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey<3) n ON c_nationkey=n_nationkey""")
def lookup_default(spark, sf_dir):
    n = _t(spark, sf_dir, "nation").where("n_regionkey < 3").select("n_nationkey", "n_name")
    return _t(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").select("c_custkey", F.coalesce("n_name", F.lit("other")).alias("nation"))


@_query("""WITH f AS (SELECT DISTINCT o_custkey k FROM orders WHERE o_orderstatus='F' AND o_totalprice>300000),
p AS (SELECT DISTINCT o_custkey k FROM orders WHERE o_orderstatus='P')
SELECT k, 'F' AS origin FROM f UNION ALL SELECT k, 'P' FROM p WHERE k NOT IN (SELECT k FROM f)""")
def anti_precedence(spark, sf_dir):
    """Keys of one origin come first; of the other only those that the first lacks."""
    o = _t(spark, sf_dir, "orders")
    first = o.where("o_orderstatus = 'F' AND o_totalprice > 300000").select(F.col("o_custkey").alias("k")).distinct()
    second = o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")).distinct()
    return first.withColumn("origin", F.lit("F")).unionByName(second.join(first, "k", "left_anti").withColumn("origin", F.lit("P")))


@_query("""SELECT o_custkey, o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END, o_orderkey) r FROM orders) WHERE r=1""")
def first_status_dedupe(spark, sf_dir):
    """The first row of a key by status order: a minimum, combined before the shuffle."""
    order = F.struct(F.when(F.col("o_orderstatus") == "O", 1).when(F.col("o_orderstatus") == "P", 2).otherwise(3).alias("s"), "o_orderkey", "o_orderstatus")
    return _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(order).alias("m")).select("o_custkey", "m.o_orderkey", "m.o_orderstatus")


@_query("""WITH s AS (SELECT o_orderkey k, CASE WHEN o_orderkey%3=0 THEN 'F' ELSE o_orderstatus END st, count(l_orderkey) n FROM orders LEFT JOIN lineitem ON l_orderkey=o_orderkey WHERE o_totalprice<400000 GROUP BY 1,2)
SELECT o_orderkey, o_orderstatus FROM orders LEFT JOIN s ON k=o_orderkey WHERE k IS NULL OR st<>o_orderstatus OR o_orderstatus='P' OR (o_orderstatus='F' AND n=0)""")
def need_predicate(spark, sf_dir):
    """Rows to fetch again: unknown, changed, going on, or finished without details; items are counted before the join."""
    o = _t(spark, sf_dir, "orders")
    n = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    s = o.where("o_totalprice < 400000").select(F.col("o_orderkey").alias("k"), F.when(F.col("o_orderkey") % 3 == 0, "F").otherwise(F.col("o_orderstatus")).alias("st"))
    s = s.join(n, F.col("k") == F.col("l_orderkey"), "left").select("k", "st", F.coalesce("n", F.lit(0)).alias("n"))
    need = F.col("k").isNull() | (F.col("st") != F.col("o_orderstatus")) | (F.col("o_orderstatus") == "P") | ((F.col("o_orderstatus") == "F") & (F.col("n") == 0))
    return o.join(s, F.col("o_orderkey") == F.col("k"), "left").where(need).select("o_orderkey", "o_orderstatus")


@_query("""SELECT c.c_custkey, coalesce(nullif(s.seg,''), c.c_mktsegment) AS segment, coalesce(s.bal, c.c_acctbal) AS balance FROM customer c
LEFT JOIN (SELECT c_custkey k, CASE WHEN c_custkey%4=0 THEN '' ELSE 'KEPT' END seg, CASE WHEN c_acctbal>0 THEN c_acctbal+1 END bal FROM customer WHERE c_custkey%2=0) s ON s.k=c.c_custkey""")
def upsert_coalesce(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    s = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("k"), F.when(F.col("c_custkey") % 4 == 0, "").otherwise("KEPT").alias("seg"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") + 1).alias("bal"))
    return c.join(s, F.col("c_custkey") == F.col("k"), "left").select("c_custkey", F.coalesce(F.nullif("seg", F.lit("")), "c_mktsegment").alias("segment"), F.coalesce("bal", "c_acctbal").alias("balance"))


@_query("""WITH x AS (SELECT p_partkey, p_brand, string_split(p_name,' ') a, string_split(p_type,' ') b FROM part), y AS (SELECT *, unnest(range(1,len(a)+1)) i FROM x)
SELECT p_partkey, CAST(i-1 AS BIGINT) AS pos, a[i] AS member, coalesce(b[i], p_brand) AS unit FROM y""")
def positional_zip(spark, sf_dir):
    p = _t(spark, sf_dir, "part").select("p_partkey", "p_brand", F.posexplode(F.split("p_name", " ")).alias("pos", "member"), F.split("p_type", " ").alias("b"))
    return p.select("p_partkey", _long("pos").alias("pos"), "member", F.coalesce(F.get("b", F.col("pos")), "p_brand").alias("unit"))


@_query("""SELECT p_partkey, x AS name FROM (SELECT p_partkey, trim(unnest(string_split(replace(replace(replace(p_brand,'#',','),'-',','),'/',',') || ', ' || replace(p_name,' ','-'), ','))) x FROM part)
WHERE x<>'' AND NOT contains(x,'-') UNION ALL SELECT p_partkey, unnest(string_split(replace(p_name,' ','-'),'-')) FROM part""")
def split_names(spark, sf_dir):
    """Splitting a text of joined names, trimming, dropping empties."""
    text = F.concat(F.replace("p_brand", F.lit("#"), F.lit(",")), F.lit(", "), F.replace("p_name", F.lit(" "), F.lit("-")))
    return _t(spark, sf_dir, "part").select("p_partkey", F.explode(split_members(text)).alias("name"))


@_query(r"""SELECT p_partkey, trim(regexp_replace(p_name || ' [' || p_brand || '] ', '\[[^\]]*\]\s*$', '')) AS base FROM part""")
def base_group_strip(spark, sf_dir):
    from ..functions import base_group

    return _t(spark, sf_dir, "part").select("p_partkey", base_group(F.concat("p_name", F.lit(" ["), "p_brand", F.lit("] "))).alias("base"))


@_query("""SELECT p_partkey, nullif(regexp_extract(p_type,'ECONOMY|STANDARD|SMALL|LARGE|PROMO|MEDIUM',0),'') AS level,
CASE WHEN regexp_matches(p_type,'BRUSHED|BURNISHED') THEN 'b' WHEN regexp_matches(p_type,'ANODI[SZ]ED') THEN 'a' WHEN regexp_matches(p_name,'^[a-m]') THEN 'front' WHEN p_size>25 THEN 'big' END AS event FROM part""")
def tag_chain(spark, sf_dir):
    """First match of an alternation, and an ordered chain of tests that ends in null."""
    level = F.nullif(F.regexp_extract("p_type", "ECONOMY|STANDARD|SMALL|LARGE|PROMO|MEDIUM", 0), F.lit(""))
    event = F.when(F.col("p_type").rlike("BRUSHED|BURNISHED"), "b").when(F.col("p_type").rlike("ANODI[SZ]ED"), "a").when(F.col("p_name").rlike("^[a-m]"), "front").when(F.col("p_size") > 25, "big")
    return _t(spark, sf_dir, "part").select("p_partkey", level.alias("level"), event.alias("event"))


@_query("""SELECT page_id, CASE WHEN regexp_matches(coalesce(url,'')||' '||coalesce(html,''),'/de/|/fr/') THEN 'first' WHEN contains(coalesce(url,'')||' '||coalesce(html,''),'<nav>') THEN 'second' ELSE 'other' END AS kind FROM pages""")
def classify_pages(spark, sf_dir):
    text = F.concat(nz(F.col("url")), F.lit(" "), nz(F.col("html")))
    return _t(spark, sf_dir, "pages").select("page_id", F.when(text.rlike("/de/|/fr/"), "first").when(text.contains("<nav>"), "second").otherwise("other").alias("kind"))


@_query("""SELECT o_orderkey, coalesce(o_orderstatus='F' AND starts_with(o_orderpriority,'1') AND ((ends_with(o_orderpriority,'T') AND r<=4) OR (ends_with(o_orderpriority,'H') AND r<=3)),false) AS promoted FROM
(SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) r FROM orders)""")
def promotion_rule(spark, sf_dir):
    r = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderkey"))
    p = F.col("o_orderpriority")
    rule = (F.col("o_orderstatus") == "F") & p.startswith("1") & ((p.endswith("T") & (F.col("r") <= 4)) | (p.endswith("H") & (F.col("r") <= 3)))
    return _t(spark, sf_dir, "orders").withColumn("r", r).select("o_orderkey", F.coalesce(rule, F.lit(False)).alias("promoted"))


@_query("""WITH c AS (SELECT l_orderkey k, count(*) FILTER (l_returnflag='R') f, count(*) FILTER (l_returnflag='A') t FROM lineitem GROUP BY 1),
f AS (SELECT l_orderkey k, max(l_partkey) w, max(l_suppkey) l FROM lineitem JOIN c ON k=l_orderkey WHERE f=1 AND l_returnflag='R' GROUP BY 1),
t AS (SELECT l_orderkey k, max(l_partkey) w, max(l_suppkey) l FROM lineitem JOIN c ON k=l_orderkey WHERE f=1 AND t=1 AND l_returnflag='A' GROUP BY 1)
SELECT k, CAST(1 AS BIGINT) AS rank, w AS entry FROM f UNION ALL SELECT k, 2, l FROM f UNION ALL SELECT k, 3, w FROM t UNION ALL SELECT k, 4, l FROM t""")
def podium(spark, sf_dir):
    """Exactly-one tests by conditional counts, and winner and loser of the single final and third-place row: one shuffle."""
    l = _t(spark, sf_dir, "lineitem")  # noqa: E741
    of = lambda flag, c: F.max(F.when(F.col("l_returnflag") == flag, F.col(c)))
    g = l.groupBy(F.col("l_orderkey").alias("k")).agg(F.count_if(F.col("l_returnflag") == "R").alias("f"), F.count_if(F.col("l_returnflag") == "A").alias("t"), of("R", "l_partkey").alias("w1"), of("R", "l_suppkey").alias("w2"), of("A", "l_partkey").alias("w3"), of("A", "l_suppkey").alias("w4"))
    row = lambda r: F.struct(F.lit(r).cast("bigint").alias("rank"), F.col(f"w{r}").alias("entry"))
    places = F.when(F.col("t") == 1, F.array(*map(row, (1, 2, 3, 4)))).otherwise(F.array(row(1), row(2)))
    return g.where("f = 1").select("k", F.inline(places))


@_query("""WITH e AS (SELECT event_type, user_id, sum(CASE WHEN value>50 THEN 1 ELSE 0 END) wins, sum(coalesce(try_cast(round(value) AS BIGINT)-50,0)) diff, min(event_id) ord FROM events GROUP BY 1,2)
SELECT event_type, user_id, CAST(wins AS BIGINT) AS wins, CAST(diff AS BIGINT) AS diff, row_number() OVER (PARTITION BY event_type ORDER BY wins DESC, diff DESC, ord) AS rank FROM e""")
def round_robin(spark, sf_dir):
    """Wins, difference and first appearance of each entry, then ranks without sharing."""
    e = _t(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(
        F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).cast("bigint").alias("wins"), F.sum(F.coalesce(_long(F.round("value")) - 50, F.lit(0))).cast("bigint").alias("diff"), F.min("event_id").alias("ord")
    )
    # few types, many entries: entries are counted by score first, and ranked inside one score
    score = ["event_type", "wins", "diff"]
    better = Window.partitionBy("event_type").orderBy(F.desc("wins"), F.desc("diff")).rowsBetween(Window.unboundedPreceding, -1)
    base = e.groupBy(*score).agg(F.count("*").alias("c")).select(*score, F.coalesce(F.sum("c").over(better), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy(*score).orderBy("ord"))
    return e.withColumn("inside", inside).join(base, score).select("event_type", "user_id", "wins", "diff", (F.col("base") + F.col("inside")).alias("rank"))


@_query("""SELECT o_custkey, strftime(o_orderdate,'%Y') AS year, array_to_string(list_sort(list(DISTINCT o_orderpriority)),',') AS priorities FROM orders GROUP BY 1,2""")
def index_sets(spark, sf_dir):
    return _t(spark, sf_dir, "orders").groupBy("o_custkey", F.date_format("o_orderdate", "yyyy").alias("year")).agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), ",").alias("priorities"))


@_query("""SELECT p_brand, unnest(string_split(p_name,' ')) AS name, p_size FROM part""")
def bag_refs(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_brand", F.explode(F.split("p_name", " ")).alias("name"), "p_size")


@_query("SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def distinct_counts(spark, sf_dir):
    """Each pair is made distinct before the shuffle by supplier; two distinct counts in one aggregation would double all rows."""
    l = _t(spark, sf_dir, "lineitem")  # noqa: E741
    of = lambda c, name: l.select("l_suppkey", c).distinct().groupBy("l_suppkey").agg(F.count("*").alias(name))
    return of("l_partkey", "parts").join(of("l_orderkey", "orders"), "l_suppkey")


@_query("""WITH d AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) k FROM orders GROUP BY 1,2), r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY k) n FROM d)
SELECT o_custkey, string_agg(o_orderpriority,'、' ORDER BY k) AS firsts FROM r WHERE n<=3 GROUP BY 1""")
def first_three(spark, sf_dir):
    """Distinct values by first appearance; each is reduced to its first key before they are collected."""
    d = _t(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.min("o_orderkey").alias("k"))
    first = F.row_number().over(Window.partitionBy("o_custkey").orderBy("k"))
    d = d.withColumn("n", first).where("n <= 3")  # three rows a key at most are collected
    return d.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "o_orderpriority"))), lambda x: x["o_orderpriority"]), "、").alias("firsts"))


@_query("""SELECT o_custkey, bool_or(o_orderstatus='P') AS any_open, bool_and(o_orderstatus='F') AS all_done, bool_or(o_totalprice>400000) AS any_large FROM orders GROUP BY 1""")
def exists_flags(spark, sf_dir):
    return _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.bool_or(F.col("o_orderstatus") == "P").alias("any_open"), F.bool_and(F.col("o_orderstatus") == "F").alias("all_done"), F.bool_or(F.col("o_totalprice") > 400000).alias("any_large"))


@_query("SELECT count(*) AS n, max(strftime(o_orderdate,'%Y-%m-%d')) AS latest, min(strftime(o_orderdate,'%Y-%m-%d')) AS earliest FROM orders")
def max_string_date(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").agg(F.count("*").alias("n"), F.max("o_orderdate").alias("a"), F.min("o_orderdate").alias("b"))
    return o.select("n", F.date_format("a", _DAY).alias("latest"), F.date_format("b", _DAY).alias("earliest"))


@_query("""WITH u AS (SELECT DISTINCT p_name u FROM part UNION SELECT DISTINCT p_brand FROM part)
SELECT a.u AS focus, b.u AS unit FROM u a, u b WHERE a.u<>b.u AND (contains(b.u,a.u) OR (length(a.u)>=2 AND contains(a.u,b.u)))""")
def variants_theta(spark, sf_dir):
    """Names contained in one another: an equi join on bigrams, then the exact test."""
    p = _t(spark, sf_dir, "part")
    return search.variants(p.select(F.col("p_name").alias("unit")).union(p.select("p_brand")))


@_query("SELECT p_partkey, p_name FROM part WHERE contains(p_name,'o') ORDER BY p_name, p_partkey LIMIT 60")
def search_top60(spark, sf_dir):
    """Top 60 by name: the feature is the limit."""
    return _t(spark, sf_dir, "part").where(F.col("p_name").contains("o")).select("p_partkey", "p_name").orderBy("p_name", "p_partkey").limit(60)


@_query("SELECT count(*) AS found, CAST(least(count(*),60) AS BIGINT) AS shown, count(*)>60 AS more FROM part WHERE contains(p_name,'o')")
def search_total(spark, sf_dir):
    return _t(spark, sf_dir, "part").where(F.col("p_name").contains("o")).agg(F.count("*").alias("found")).select("found", F.least("found", F.lit(60)).cast("bigint").alias("shown"), (F.col("found") > 60).alias("more"))


@_query("""SELECT o_orderkey, coalesce(c_name, CAST(o_custkey AS VARCHAR)) AS customer, coalesce(c_mktsegment,'') AS segment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal>0) c ON c_custkey=o_custkey""")
def profile_join(spark, sf_dir):
    c = _t(spark, sf_dir, "customer").where("c_acctbal > 0").select("c_custkey", "c_name", "c_mktsegment")
    return _t(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left").select("o_orderkey", F.coalesce("c_name", F.col("o_custkey").cast("string")).alias("customer"), nz(F.col("c_mktsegment")).alias("segment"))


@_query("""SELECT a.l_partkey AS part, count(DISTINCT b.l_partkey) AS partners, count(*) AS meetings FROM (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) a JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) b ON a.l_orderkey=b.l_orderkey AND a.l_partkey<>b.l_partkey GROUP BY 1""")
def partners(spark, sf_dir):
    """Others in the same group; a large group's rows are split by the adaptive skew join, and meetings need no pairs."""
    d = _t(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_partkey").alias("part")).distinct()
    pairs = d.join(d.withColumnRenamed("part", "partner"), "l_orderkey").where("part <> partner").select("part", "partner").distinct()
    size = d.groupBy("l_orderkey").agg((F.count("*") - 1).alias("others")).where("others > 0")
    meetings = d.join(size, "l_orderkey").groupBy("part").agg(F.sum("others").alias("meetings"))
    return pairs.groupBy("part").agg(F.count("*").alias("partners")).join(meetings, "part")


@_query("""WITH d AS (SELECT DISTINCT 'o'||l_orderkey AS g, l_partkey AS part FROM lineitem UNION SELECT DISTINCT 'q'||CAST(l_quantity AS BIGINT), l_partkey FROM lineitem)
SELECT a.part, count(DISTINCT b.part) AS partners FROM d a JOIN d b ON a.g=b.g AND a.part<>b.part GROUP BY 1""")
def crowd_partners(spark, sf_dir):
    """Others in the same order or with the same quantity: few members a group, and many."""
    rows = _t(spark, sf_dir, "lineitem")
    group = lambda kind, c: rows.select(F.concat(F.lit(kind), c.cast("string")).alias("g"), F.col("l_partkey").alias("part"))
    both = group("o", F.col("l_orderkey")).unionByName(group("q", F.col("l_quantity").cast("bigint")))
    return search.partner_counts(both, "g", "part", heavy=50)


@_query("""SELECT l_orderkey, arg_min(l_returnflag, (l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag)) AS side FROM lineitem WHERE l_returnflag IN ('A','R') GROUP BY 1""")
def side_choice(spark, sf_dir):
    """The flag of the earliest row; line numbers repeat, so more columns decide ties."""
    order = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag")
    return _t(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("A", "R")).groupBy("l_orderkey").agg(F.min(order)["l_returnflag"].alias("side"))


@_query("""SELECT n_regionkey, array_to_string(list_sort(list(DISTINCT c_mktsegment)),',') AS segments, array_to_string(list_sort(list(DISTINCT n_name)),',') AS nations FROM customer JOIN nation ON c_nationkey=n_nationkey WHERE n_nationkey IN (1,2,3,5,8,13,21) GROUP BY 1""")
def unit_merge(spark, sf_dir):
    n = _t(spark, sf_dir, "nation").where(F.col("n_nationkey").isin(1, 2, 3, 5, 8, 13, 21))
    s = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")
    return _t(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).groupBy("n_regionkey").agg(s("c_mktsegment").alias("segments"), s("n_name").alias("nations"))


@_query("""WITH g AS (SELECT user_id, epoch_us(ts) t, CASE WHEN epoch_us(ts)-lag(epoch_us(ts)) OVER w > 21600000000 THEN 1 ELSE 0 END n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts))),
c AS (SELECT user_id, t, sum(n) OVER (PARTITION BY user_id ORDER BY t ROWS UNBOUNDED PRECEDING) k FROM g)
SELECT user_id, CAST(k AS BIGINT) AS cluster, count(*) AS n, min(t) AS low, max(t) AS high FROM c GROUP BY 1,2""")
def gap_cluster(spark, sf_dir):
    """Gaps and islands by time: a new cluster after six hours without an event."""
    e = _t(spark, sf_dir, "events").select("user_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    return geometry.clusters(e, "user_id", "t", 21_600_000_000).select("user_id", _long("cluster").alias("cluster"), "n", "low", "high")


@_query("""WITH c AS (SELECT user_id, epoch_us(ts) t, event_id FROM events) SELECT user_id, event_id, lead(t) OVER (PARTITION BY user_id ORDER BY t, event_id) - t AS wait FROM c""")
def adjacent_pairs(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("t"))
    rows = geometry.following(e, "user_id", ["t", "event_id"], "t", "next")
    return rows.select("user_id", "event_id", (F.col("next") - F.col("t")).alias("wait"))


@_query("""WITH x AS (SELECT p_partkey, p_size t, p_partkey%7 a, p_partkey%11 b, p_partkey%5 c FROM part), y AS (SELECT p_partkey, t, list_concat(CASE WHEN a<=b THEN range(a,b+1) ELSE [] END,[c]) l FROM x)
SELECT p_partkey, array_to_string([q-1 FOR q IN l IF q>=1 AND q<=t],',') AS pages FROM y""")
def page_ranges(spark, sf_dir):
    spec = F.concat((F.col("p_partkey") % 7).cast("string"), F.lit("-"), (F.col("p_partkey") % 11).cast("string"), F.lit(","), (F.col("p_partkey") % 5).cast("string"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.array_join(geometry.pages(spec, F.col("p_size")), ",").alias("pages"))


@_query("""WITH d AS (SELECT *, strftime(o_orderdate,'%Y-%m-%d') a, CASE WHEN o_orderkey%4=0 THEN '0000-00-00' WHEN o_orderkey%4=1 THEN strftime(o_orderdate,'%Y-%m-%d') WHEN o_orderkey%4=2 THEN '' ELSE '2002-01-01' END b, o_orderkey%6+1 r FROM orders)
SELECT o_orderkey, replace(a,'-','/') AS day, CASE WHEN b IN ('','0000-00-00') OR a=b THEN replace(a,'-','/') ELSE replace(a,'-','/')||' ~ '||replace(b,'-','/') END AS span,
CASE r WHEN 1 THEN '冠軍' WHEN 2 THEN '亞軍' WHEN 3 THEN '季軍' WHEN 4 THEN '殿軍' ELSE '第'||r||'名' END AS place, CASE WHEN r<=3 THEN 'rank-'||r ELSE '' END AS class FROM d""")
def label_map(spark, sf_dir):
    a = F.date_format("o_orderdate", _DAY)
    k = F.col("o_orderkey") % 4
    b = F.when(k == 0, "0000-00-00").when(k == 1, a).when(k == 2, "").otherwise("2002-01-01")
    r = F.col("o_orderkey") % 6 + 1
    return _t(spark, sf_dir, "orders").select("o_orderkey", format_date(a).alias("day"), format_range(a, b).alias("span"), rank_label(r).alias("place"), rank_class(r).alias("class"))


@_query("""SELECT event_id, try_cast(json_extract_string(props,'$.k') AS BIGINT) AS k FROM events""")
def json_lenient(spark, sf_dir):
    k = F.get(F.array(F.from_json("props", "k bigint", {"allowUnquotedControlChars": "true"})), 0)["k"]
    return _t(spark, sf_dir, "events").select("event_id", k.alias("k"))


@_query("""SELECT o_orderkey, (CASE WHEN o_orderkey%3=0 THEN NULL ELSE o_orderpriority END) IS DISTINCT FROM (CASE WHEN o_orderkey%2=0 THEN o_orderpriority END) AS changed FROM orders""")
def change_detect(spark, sf_dir):
    a, b = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority")), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    return _t(spark, sf_dir, "orders").select("o_orderkey", (~F.array(F.struct(a)).eqNullSafe(F.array(F.struct(b)))).alias("changed"))


@_query("""SELECT DISTINCT c_mktsegment AS city FROM customer""")
def distinct_list(spark, sf_dir):
    return _t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("city")).distinct()


@_query("""SELECT CASE WHEN o_totalprice>200000 THEN 'new' WHEN o_orderstatus='P' THEN 'updated' ELSE 'skipped' END AS action, count(*) AS n FROM orders GROUP BY 1""")
def run_counters(spark, sf_dir):
    action = F.when(F.col("o_totalprice") > 200000, "new").when(F.col("o_orderstatus") == "P", "updated").otherwise("skipped")
    return _t(spark, sf_dir, "orders").groupBy(action.alias("action")).agg(F.count("*").alias("n"))


@_query("""SELECT o_custkey, arg_min(o_orderpriority,o_orderkey) AS first_head, arg_max(o_orderpriority,o_orderkey) AS last_head FROM orders GROUP BY 1""")
def first_value(spark, sf_dir):
    return _t(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min_by("o_orderpriority", "o_orderkey").alias("first_head"), F.max_by("o_orderpriority", "o_orderkey").alias("last_head"))


@_query("""SELECT o_custkey, o_orderkey FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) r FROM orders) WHERE r BETWEEN 3 AND 4""")
def paging(spark, sf_dir):
    """The second page of two rows of each key."""
    return search.group_pages(_t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), ["o_custkey"], ["o_orderkey"], 2, 2)


@_query("""SELECT page_id, replace(replace(replace(replace(replace(coalesce(url,''),'&','&amp;'),'<','&lt;'),'>','&gt;'),'"','&quot;'),'''','&#39;') AS shown, url_encode(coalesce(url,'')) AS encoded FROM pages""")
def link_texts(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", escape_html(F.col("url")).alias("shown"), encode_component(F.col("url")).alias("encoded"))


@_query("""SELECT event_id, coalesce(try_cast(a AS DOUBLE) > try_cast(b AS DOUBLE), false) AS won, CAST(CASE WHEN regexp_full_match(a,'[+-]?[0-9]+') THEN a END AS BIGINT) AS own FROM
(SELECT event_id, CASE WHEN event_id%5=0 THEN '棄' ELSE CAST(event_id%21 AS VARCHAR) END a, CASE WHEN event_id%7=0 THEN NULL ELSE CAST(event_id%19 AS VARCHAR) END b FROM events)""")
def score_compare(spark, sf_dir):
    """Scores are texts and may be forfeits or missing."""
    e = F.col("event_id")
    a, b = F.when(e % 5 == 0, "棄").otherwise((e % 21).cast("string")), F.when(e % 7 != 0, (e % 19).cast("string"))
    return _t(spark, sf_dir, "events").select("event_id", game_outcome(a, b).alias("won"), safe_int(a).alias("own"))


@_query("""SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey=o_orderkey AND l_quantity>45) AND o_orderstatus='O'""")
def member_semi(spark, sf_dir):
    """Rows with a matching detail: a semi join."""
    l = _t(spark, sf_dir, "lineitem").where("l_quantity > 45").select("l_orderkey")  # noqa: E741
    return _t(spark, sf_dir, "orders").where("o_orderstatus = 'O'").join(l, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


@_query("""SELECT DISTINCT l_orderkey AS missing FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus<>'P')""")
def missing_targets(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select("o_orderkey")
    return _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("missing")).distinct().join(o, F.col("missing") == F.col("o_orderkey"), "left_anti")


@_query("""SELECT user_id, count(DISTINCT event_type) AS kinds, count(DISTINCT event_type)>1 AS warn FROM events GROUP BY 1""")
def many_units(spark, sf_dir):
    return _t(spark, sf_dir, "events").groupBy("user_id").agg(F.count_distinct("event_type").alias("kinds")).select("user_id", "kinds", (F.col("kinds") > 1).alias("warn"))


@_query("""SELECT 'orders' AS index, count(*) AS rows FROM orders UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'customer', count(*) FROM customer""")
def index_sizes(spark, sf_dir):
    from ..operators.indexes import sizes

    return sizes({n: _t(spark, sf_dir, n) for n in ("orders", "part", "customer")})


@_query("""SELECT p_partkey, regexp_replace(chr(12288)||p_name||chr(12288),'^[\\s\\x{3000}]+|[\\s\\x{3000}]+$','','g') AS trimmed FROM part""")
def unicode_trim(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", utrim(F.concat(F.lit("　"), "p_name", F.lit("　"))).alias("trimmed"))


@_query("""SELECT strftime(time_bucket(INTERVAL 1 hour, ts),'%Y-%m-%d %H:%M') AS hour, event_type, count(*) AS n FROM events GROUP BY 1,2""")
def event_windows(spark, sf_dir):
    """The streaming window count, run as a batch; an addition to the reference's operators."""
    e = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return landing.event_counts(e).select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("hour"), "event_type", "n")


from . import documents  # noqa: E402, F401  (its queries are added to the catalogue)


_TEXTS = "SELECT DISTINCT x AS text FROM (SELECT substr(city,1,3) AS x FROM clients UNION ALL SELECT substr(city,2,2) FROM clients UNION ALL SELECT substr(city,1,1) FROM clients UNION ALL SELECT name FROM vendors) WHERE trim(x)<>''"


@_query(f"SELECT text, name FROM ({_TEXTS}) JOIN (SELECT DISTINCT name FROM clients UNION SELECT name FROM vendors) n ON contains(name, text)")
def names_with_texts(spark, sf_dir):
    """Many texts searched in all names of clients and vendors at once, by the rarest n-gram of each."""
    clients, vendors = _t(spark, sf_dir, "clients"), _t(spark, sf_dir, "vendors")
    texts = clients.select(F.explode(F.array(F.substring("city", 1, 3), F.substring("city", 2, 2), F.substring("city", 1, 1))).alias("text")).union(vendors.select("name"))
    return postings.containing(texts, "text", clients.select("name").union(vendors.select("name")), "name")


@_query("SELECT DISTINCT name FROM (SELECT name FROM clients UNION ALL SELECT name FROM vendors) WHERE contains(name,'ren')")
def names_found_in_postings(spark, sf_dir):
    """A search that reads the stored postings of one n-gram."""
    store = Store(spark, scratch_folder(spark, "postings"), key="gram")
    postings.stored(store, _t(spark, sf_dir, "clients").select("name").union(_t(spark, sf_dir, "vendors").select("name")), "name")
    return postings.find(store, "ren")
