"""Operators with a key or text that most rows share."""

import random

import pytest
from pyspark.sql import functions as F

from rallyframe.operators import geometry, postings, search
from rallyframe.sources import Store


def hot_points(n=6000):
    rng = random.Random(4)
    return [("hot" if rng.random() < 0.9 else rng.choice([None, "a", "b", "c"]), None if rng.random() < 0.01 else rng.choice([rng.randrange(40_000), 7]), i) for i in range(n)]


def plain_clusters(points, gap):
    out, keys = [], {k for k, _, _ in points}
    for k in keys:
        values = sorted((v is not None, v or 0) for p, v, _ in points if p == k)
        cluster, last, found = 0, None, {}
        for there, v in values:
            if there and last is not None and v - last > gap:
                cluster += 1
            last = v if there else last
            found.setdefault(cluster, []).append(v if there else None)
        out += [(k, c, len(x), min((v for v in x if v is not None), default=None), max((v for v in x if v is not None), default=None)) for c, x in found.items()]
    return sorted(out, key=repr)


@pytest.mark.parametrize("gap", [0, 9, 60, 100_000])
def test_clusters_of_a_hot_key(spark, gap):
    points = hot_points()
    df = spark.createDataFrame(points, "k string, v long, id long")
    got = sorted(((r.k, r.cluster, r.n, r.low, r.high) for r in geometry.clusters(df, "k", "v", gap).collect()), key=repr)
    assert got == plain_clusters(points, gap)
    sizes = [r["count"] for r in geometry.dealt(df, ["k", "v"]).groupBy("_part").count().collect()]
    assert len(sizes) == 4


def test_largest_range_is_at_most_twice_the_median(spark):
    rows = spark.range(100_000).select(F.when(F.col("id") % 10 < 9, "hot").otherwise((F.col("id") % 997).cast("string")).alias("k"), F.pmod(F.xxhash64("id"), F.lit(10**9)).alias("v"))
    sizes = sorted(r["count"] for r in geometry.dealt(rows, ["k", "v"]).groupBy("_part").count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_following_rows_of_a_hot_key(spark):
    points = [(k, v or 0, i) for k, v, i in hot_points(3000)]
    df = spark.createDataFrame(points, "k string, v long, id long")
    want = set()
    for key in {k for k, _, _ in points}:
        rows = sorted((v, i) for k, v, i in points if k == key)
        want |= {(key, i, after) for (_, i), after in zip(rows, [v for v, _ in rows[1:]] + [None])}
    assert {(r.k, r.id, r.after) for r in geometry.following(df, "k", ["v", "id"], "v", "after").collect()} == want
    assert geometry.following(df.where("false"), "k", ["v", "id"], "v", "after").count() == 0
    assert geometry.clusters(df.where("false"), "k", "v", 1).count() == 0


NAMES = ["north club", "club", "c", "", None, "é", "中文隊", "文", "中文", "aa", "aaa", "a b", " "]


def test_containing_equals_the_scan(spark):
    df = spark.createDataFrame([(x,) for x in NAMES + NAMES], "x string")
    texts = [*NAMES, "lub", "zz", "cl", "no club", "b "]
    got = {tuple(r) for r in postings.containing(spark.createDataFrame([(x,) for x in texts], "t string"), "t", df, "x").collect()}
    assert got == {(t, n) for t in texts for n in NAMES if t and t.strip() and n is not None and t in n}


def test_search_in_postings_equals_the_scan_and_reads_little(spark, tmp_path):
    rng = random.Random(6)
    names = sorted({"".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 12))) for _ in range(3000)})
    df = spark.createDataFrame([(n,) for n in names], "name string")
    store = Store(spark, str(tmp_path / "s"), key="gram", buckets=16)
    postings.stored(store, df, "name")
    total = store.read("postings").count()
    for text in ("abc", "a", names[5], names[7][1:5], "zz", "", "  ", "mno"):
        found = postings.find(store, text)
        assert sorted(r.name for r in found.collect()) == sorted(n for n in names if text.strip() and text.strip() in n)
        if len(text) > 1 and text.strip() and found.limit(1).count():
            read = {f for f in found.inputFiles()}
            assert len(read) <= 2
            assert spark.read.parquet(*read).count() <= 0.15 * total


def test_variants_by_the_rarest_pair(spark):
    """A prefix that all 100,000 names share gives no candidates."""
    n = 100_000
    names = spark.range(n).select(F.concat(F.lit("prefix club "), F.conv(F.col("id").cast("string"), 10, 36)).alias("unit"))
    names = names.union(spark.createDataFrame([("club",), ("prefix",), ("x",)], "unit string"))
    short = names.where("length(unit) < 8 or unit like '%ZZ%'")
    pairs = postings.candidates(short, "unit", postings.postings(names, "unit"))
    asked, found = short.count(), pairs.count()
    assert found <= 3 * (n + 1) + asked * 0.02 * n
    few = names.orderBy("unit").limit(3000).union(spark.createDataFrame([("club",), ("prefix",), ("x",)], "unit string"))
    units = sorted({r.unit for r in few.collect()})
    want = {(a, b) for a in units for b in units if a != b and (a in b or (len(a) >= 2 and b in a))}
    assert {tuple(r) for r in search.variants(few).collect()} == want


def test_partners_of_a_large_group(spark):
    """One group of 30,000, a smaller one of heavy size, and pairs inside and outside them."""
    large = [(0, i) for i in range(30_000)]
    heavy = [(1, i) for i in range(29_990, 30_100)]
    light = [(2, 5), (2, 6), (3, 5), (3, 50_000), (3, None), (None, 5), (4, 7), (4, 60_000), (4, 60_000), (5, 70_000), (6, -3), (6, 29_995)]
    rows = spark.createDataFrame(large + heavy + light, "g int, m long")
    got = {r.m: r.partners for r in search.partner_counts(rows, "g", "m", heavy=100).collect()}
    groups = {}
    for g, m in large + heavy + light:
        if g is not None and m is not None:
            groups.setdefault(g, set()).add(m)
    of = {}
    for g, ms in groups.items():
        for m in ms:
            of.setdefault(m, []).append(g)
    want = {m: len(set().union(*(groups[g] for g in gs))) - 1 if len(gs) > 1 else len(groups[gs[0]]) - 1 for m, gs in of.items()}
    assert got == {m: n for m, n in want.items() if n}
    assert search.partner_counts(rows.limit(0), "g", "m").count() == 0
