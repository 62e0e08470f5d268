"""What is shuffled and how often steps are made, on small tables."""

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rallyframe.operators import indexes, maintenance, search, standings
from rallyframe.plans import documents
from rallyframe.sources import Store
from rallyframe.sources.schemas import MATCH, STANDING

FOLDER = "/root/testdata/sf0.001"
there = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_indexes_shuffle_nothing(spark):
    docs = spark.createDataFrame([], f"openid string, matches array<{MATCH}>, standings array<{STANDING}>")
    for rows in (indexes.players(docs), indexes.units(docs), indexes.ranks(docs), indexes.unit_ranks(docs)):
        assert "Exchange" not in plan(rows)[1]


@there
def test_line_items_come_together_with_their_own_columns(spark):
    docs = documents._documents(spark, FOLDER)
    assert docs.schema["matches"].dataType.simpleString() == spark.createDataFrame([], f"x array<{MATCH}>").schema["x"].dataType.simpleString()
    together = [line for line in plan(docs)[0].split("\n") if "Aggregate" in line]
    assert len(together) == 1 and "l_shipdate" in together[0] and "scoreinfo" not in together[0]


def test_steps_of_standings_are_made_once(spark):
    text = str(standings.derived(F.col("matches"))._jc)
    assert text.count("R34") == 1 and text.count("F3") == 1


def test_partners_in_many_large_groups_by_blocks_of_sets(spark, monkeypatch):
    """Each member has its own set of large groups, so that sets are many; pairs of light groups that meet there count once."""
    monkeypatch.setattr(search, "BLOCK", 50)
    monkeypatch.setattr(search, "TILE", 7)
    rng = random.Random(8)
    rows = [(f"g{g}", m) for m in range(200) for g in rng.sample(range(90), rng.choice((0, 1, 2, 6)))] + [(f"s{rng.randrange(80)}", m) for m in range(200)]
    groups, want = {}, {}
    for g, m in rows:
        groups.setdefault(g, set()).add(m)
    for own in groups.values():
        for m in own:
            want.setdefault(m, set()).update(own - {m})
    df = spark.createDataFrame(rows, "g string, m long")
    got = search.partner_counts(df, "g", "m", heavy=4)
    assert {r.m: r.partners for r in got.collect()} == {m: len(x) for m, x in want.items() if x}
    assert "bitmap" not in plan(got)[0]


def test_counts_of_sets_that_meet_by_splitting(monkeypatch):
    """Counts equal those of all pairs, with one word and several, dense and sparse."""
    monkeypatch.setattr(search, "LEAF", 1 << 12)
    rng = np.random.default_rng(4)
    for words, share in ((1, 0.45), (3, 0.2), (8, 0.004)):
        x, y = (np.packbits(rng.random((n, words, 64)) < share, axis=2).view(np.uint64).reshape(n, words) for n in (3000, 2000))
        members = [rng.integers(1, 5, n).astype(float) for n in (3000, 2000)]
        meet = ((x[:, None, :] & y[None, :, :]) != 0).any(axis=2)
        n, m = search._meetings(x, y, *members)
        assert (n == meet @ members[1]).all() and (m == members[0] @ meet).all()


@pytest.mark.parametrize("groups", (40, 300, 900))
def test_partners_by_blocks_in_the_order_of_bits(spark, monkeypatch, groups):
    """One word, several words, and more than are split; blocks of few sets."""
    monkeypatch.setattr(search, "HELD", 30)
    monkeypatch.setattr(search, "LEAF", 50)
    monkeypatch.setattr(search, "NUMBERED", 130)
    rng = random.Random(groups)
    rows = [(f"g{g}", m) for m in range(150) for g in rng.sample(range(groups), rng.choice((0, 1, 2, groups // 8)))] + [(f"s{rng.randrange(60)}", m) for m in range(150)]
    of, want = {}, {}
    for g, m in rows:
        of.setdefault(g, set()).add(m)
    for own in of.values():
        for m in own:
            want.setdefault(m, set()).update(own - {m})
    got = search.partner_counts(spark.createDataFrame(rows, "g string, m long"), "g", "m", heavy=4)
    assert {r.m: r.partners for r in got.collect()} == {m: len(x) for m, x in want.items() if x}


def test_found_players_list_no_tournaments(spark):
    """What comes together for a name is its distinct units, however many tournaments it has."""
    rng = random.Random(5)
    rows = [(rng.choice(("p1", "p10", "xp1", "q")), f"t{rng.randrange(40)}", sorted(rng.sample("abcdefg", rng.randrange(4)))) for _ in range(300)] + [("p19", "t1", []), ("p19", "t2", [])]
    ranks = [("p1",)] * 3 + [("q",)]
    want = {}
    for name, openid, units in sorted(rows):
        if "p1" in name:
            seen, ids = want.setdefault(name, ([], set()))
            seen += [u for u in units if u not in seen]
            ids.add(openid)
    got = search.players_with(spark.createDataFrame(rows, "name string, openid string, units array<string>"), spark.createDataFrame(ranks, "name string"), "p1")
    assert {tuple(r) for r in got.collect()} == {(n, "、".join(u[:3]), len(i), 3 if n == "p1" else 0) for n, (u, i) in want.items()}
    aggregates = [line for line in plan(got)[0].split("\n") if "Aggregate" in line]
    assert aggregates and not any("collect_list(struct(openid" in line for line in aggregates)


@there
def test_only_asked_names_are_sorted(spark):
    docs = documents._documents(spark, FOLDER)
    asked = lambda name: name.contains("p1")
    got, want = indexes.players(docs, asked), indexes.players(docs).where(asked(F.col("name")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def stored(folder):
    return {str(f.relative_to(folder)) for f in folder.rglob("*.parquet")}


def same(a, b):
    return sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(a.columns)).collect()))


def test_first_load_is_taken_as_it_is_and_keys_are_written_once(spark, tmp_path):
    """Settling the first load writes nothing, keys are those of the documents' files, and the newest rows are read without a join."""
    match = [{"groupName": "g[1]", "teamA": "u1", "teamB": "u2", "scoreinfo": [{"memberA": "p/q", "memberB": " r"}]}]
    schema = f"openid string, name string, city string, status string, registerStart string, registerEnd string, dateStart string, dateEnd string, venue string, category string, isSystem boolean, groups array<string>, regulation string, matches array<{MATCH}>, standings array<{STANDING}>"
    docs = spark.createDataFrame([{"openid": str(i), "matches": match if i % 3 else []} for i in range(40)], schema)
    writers = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None)
    store = Store(spark, str(tmp_path / "s"), buckets=4)
    maintenance.follow(store, docs.where("openid < '3'").repartition("openid"), ("x", 0), dealt=True)
    before = stored(tmp_path)
    assert store.settle() == 2 and stored(tmp_path) == before
    assert all(not t["deltas"] and t["bases"] for t in store.manifest()["tables"].values())
    maintenance.follow(store, docs.where("openid > '25'").withColumn("matches", F.array().cast(docs.schema["matches"].dataType)), ("x", 1))
    for name, rows in maintenance.rebuilt(store).items():
        assert same(store.read(name), rows), name
    assert {r.openid for r in store.read("players").collect()} == {str(i) for i in range(40) if i % 3 and str(i) <= "25"}
    assert not any("-keys" in f for f in stored(tmp_path))
    assert plan(store.read("documents"))[0].count("Join") == 1 and "Aggregate" not in plan(store.read("documents"))[0]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters", None) == writers


def test_bucket_that_lost_all_its_rows(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=2)
    store.apply({"t": spark.createDataFrame([("a", 1), ("b", 2)], "openid string, v long")})
    store.settle()
    store.apply({"t": spark.createDataFrame([], "openid string, v long")}, keys=spark.createDataFrame([("a",), ("b",)], "openid string"))
    store.deltas = 0
    store.settle()
    assert store.read("t").count() == 0 and store.lookup("t", "a").count() == 0


@there
def test_line_items_are_shuffled_as_rows(spark):
    """Nothing is collected, and so sorted, before the shuffle; rows of orders that are not wanted are left out before it."""
    text = plan(documents._items(spark.read.parquet(f"{FOLDER}/lineitem.parquet")))[1]
    assert text.index("Aggregate") < text.index("Exchange") and "Aggregate" not in text[text.index("Exchange") :]
    some = documents._documents(spark, FOLDER, wanted=lambda k: k % 4 == 0, played=lambda k: k % 8 == 0)
    every = documents._documents(spark, FOLDER).where("openid % 4 = 0")
    assert same(some.select("openid", (F.size("matches") > 0).alias("there")), every.select("openid", ((F.size("matches") > 0) & F.when(F.col("openid") % 8 == 0, True)).alias("there")))


def test_a_store_keeps_the_indexes_it_began_with(spark, tmp_path, monkeypatch):
    """followed_ranks makes no index but its own; a store of some indexes goes on with these."""
    docs = spark.createDataFrame([("1", [{"group": "g", "rank": 1, "unit": "u", "members": ["a"]}])], f"openid string, standings array<{STANDING}>")
    docs = docs.withColumns({c: F.lit(None).cast(t) for c, t in {"matches": f"array<{MATCH}>", "groups": "array<string>", "regulation": "string"}.items()})
    store = Store(spark, str(tmp_path / "s"), buckets=2)
    maintenance.follow(store, docs, ("x", 0), names=("ranks",))
    maintenance.follow(store, docs.withColumn("openid", F.lit("2")), ("x", 1))
    assert set(store.manifest()["tables"]) == {"documents", "ranks"} and set(maintenance.rebuilt(store)) == {"ranks"}
    assert {(r.name, r.openid) for r in store.read("ranks").collect()} == {("a", "1"), ("a", "2")}


@there
def test_import_shuffles_line_items_and_keys_only(spark):
    """Texts of entries and standings are made after the shuffle; nothing is dealt by openid and group."""
    text = plan(documents.imported_standings(spark, FOLDER))[1]
    dealt = {line[line.index("hashpartitioning(") :].split("), ")[0] for line in text.split("\n") if "Exchange hashpartitioning" in line}
    assert dealt and all("," not in d.rsplit(",", 1)[0] for d in dealt), dealt
    assert "/p" not in documents._entries(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()


def test_import_of_null_groups_and_openids(spark):
    """A stored row without a group stays, and so does one without an openid."""
    stored = spark.createDataFrame([("1", 0, None, 1), ("1", 1, "g", 1), ("1", 2, "h", 1), (None, 0, "g", 1), ("2", 0, "g", 1)], "openid string, standing_pos int, group string, rank int")
    entries = spark.createDataFrame([("1", "g"), ("1", None), (None, "g"), ("3", "g")], "openid string, group string")
    entries = entries.select("openid", F.lit("c").alias("category"), "group", F.lit(0).alias("event_pos"), F.lit(0).alias("entry_pos"), F.lit(2).alias("rank"), F.array(F.lit("u")).alias("units"), F.array(F.lit("m")).alias("members"))
    got = {(r.openid, r.group, r["rank"], r.standing_pos) for r in standings.apply_import(stored, entries).collect()}
    assert got == {("1", None, 1, 0), ("1", None, 2, 1), ("1", "g", 2, 2), ("1", "h", 1, 3), (None, "g", 1, 0), (None, "g", 2, 1), ("2", "g", 1, 0), ("3", "g", 2, 0)}
