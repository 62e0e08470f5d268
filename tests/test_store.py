"""Tables kept by key: versions, killed and competing writers, cost of changes, splits, and indexes that follow."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from rallyframe.operators import flatten, indexes, ingest, maintenance, standings
from rallyframe.sources import TOURNAMENT, Store
from rallyframe.sources.store import Conflict, bucket_of, parent_of
from rallyframe.streaming import landing

ROWS = "openid string, value long, text string"


def table(spark, rows):
    return spark.createDataFrame([(k, v, f"text {v}") for k, v in rows], ROWS)


def content(df):
    return sorted((r.openid, r.value) for r in df.collect())


def files(df):
    return {re.sub(r"^file:/*", "/", f) for f in df.inputFiles()}


def test_buckets_split_one_by_one(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("k"))
    for n in (1, 2, 3, 5, 8, 13, 30):
        rows = keys.select(bucket_of(F.col("k"), n).alias("old"), bucket_of(F.col("k"), n + 1).alias("new")).collect()
        assert {r.new for r in rows} <= set(range(n + 1)) and len({r.old for r in rows}) == n
        moved = {(r.old, r.new) for r in rows if r.old != r.new}
        assert moved == {(parent_of(n, n), n)}


def test_changes_replace_rows_of_their_keys(spark, tmp_path):
    store, rng, model = Store(spark, str(tmp_path / "s"), buckets=3, deltas=2), random.Random(1), {}
    for step in range(7):
        changed = {str(rng.randrange(40)): [rng.randrange(99) for _ in range(rng.randrange(0, 3))] for _ in range(12)}
        rows = [(k, v) for k, values in changed.items() for v in values] + [(None, 5)]
        store.apply({"t": table(spark, rows)}, keys=spark.createDataFrame([(k,) for k in [*changed, None, next(iter(changed))]], "openid string"))
        model |= changed
        if step % 3 == 2:
            store.settle()
        want = sorted((k, v) for k, values in model.items() for v in values)
        assert content(store.read("t")) == want
        for k in ("1", "7", "missing"):
            assert content(store.lookup("t", k)) == [x for x in want if x[0] == k]
    store.apply({"t": table(spark, [])}, keys=spark.createDataFrame([], "openid string"))
    assert content(store.read("t")) == want


def test_lookup_reads_one_bucket(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=8)
    store.apply({"t": table(spark, [(str(i), i) for i in range(800)])})
    store.settle()
    store.apply({"t": table(spark, [(str(i), -i) for i in range(0, 800, 8)])})
    found = store.lookup("t", "8")
    assert content(found) == [("8", -8)]
    assert len({re.search(r"bucket=\d+", f)[0] for f in files(found)}) == 1 and len(files(found)) <= 3


def test_killed_write_leaves_the_version_before(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"), buckets=2)
    store.apply({"t": table(spark, [("a", 1)]), "u": table(spark, [("a", 9)])})
    with monkeypatch.context() as m:
        m.setattr(Store, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            store.apply({"t": table(spark, [("a", 2)]), "u": table(spark, [("a", 8)])})
        with pytest.raises(RuntimeError):
            store.settle()
    assert content(store.read("t")) == [("a", 1)] and content(store.read("u")) == [("a", 9)] and store.versions() == [1]
    store.apply({"t": table(spark, [("a", 2)]), "u": table(spark, [("a", 8)])})
    assert content(store.read("t")) == [("a", 2)] and content(store.read("u")) == [("a", 8)]
    before = len(list((tmp_path / "s" / "data" / "t").iterdir()))
    store.evict(keep=2)
    assert len(list((tmp_path / "s" / "data" / "t").iterdir())) < before and content(store.read("t", 1)) == [("a", 1)]


def test_second_writer_goes_on_from_the_first(spark, tmp_path, monkeypatch):
    one, two = (Store(spark, str(tmp_path / "s"), buckets=2) for _ in range(2))
    one.apply({"t": table(spark, [("a", 1)])})
    old = one.manifest()
    two.apply({"t": table(spark, [("b", 2)])})
    with pytest.raises(Conflict):
        one._publish(old | {"version": 2})
    manifests = [old]
    real = Store.manifest
    monkeypatch.setattr(Store, "manifest", lambda self, version=None: json.loads(json.dumps(manifests.pop())) if manifests else real(self, version))
    assert one.apply({"t": table(spark, [("c", 3)])}) == 3
    assert content(one.read("t")) == [("a", 1), ("b", 2), ("c", 3)]


def test_a_small_change_writes_little(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=4)
    rng = random.Random(2)
    rows = [(str(i), rng.getrandbits(60)) for i in range(60_000)]
    store.apply({"t": table(spark, rows)})
    store.settle()
    store.evict(keep=1)
    size = lambda: {f: f.stat().st_size for f in (tmp_path / "s").rglob("*.parquet")}
    before = size()
    store.apply({"t": table(spark, [(k, v + 1) for k, v in rows[:: 100]])})
    store.settle()
    after = size()
    assert all(f in after for f in before), "files of the base stay"
    assert sum(n for f, n in after.items() if f not in before) <= 0.05 * sum(before.values())
    assert len(content(store.read("t"))) == 60_000 and content(store.lookup("t", "100")) == [("100", dict(rows)["100"] + 1)]


def test_buckets_split_past_a_size_and_others_keep_their_files(spark, tmp_path):
    rng = random.Random(3)
    rows = [(str(i), rng.getrandbits(60)) for i in range(20_000)]
    store = Store(spark, str(tmp_path / "s"), buckets=4, split_bytes=100_000)
    store.apply({"t": table(spark, rows[:15_000])})
    store.settle()
    state = store.manifest()["tables"]["t"]
    n = state["buckets"]
    assert n >= 4 and max(x["bytes"] for x in state["bases"].values()) <= 4 * 100_000
    before = files(store.read("t"))
    store.split_bytes = -(-sum(x["bytes"] for x in state["bases"].values()) // (n + 1))
    store.settle()
    assert store.manifest()["tables"]["t"]["buckets"] == n + 1
    assert len(before & files(store.read("t"))) == len(before) - len([f for f in before if f"bucket={parent_of(n, n)}/" in f])
    assert content(store.read("t")) == sorted(rows[:15_000])
    assert content(store.lookup("t", "77")) == [("77", dict(rows)["77"])]


def test_reader_stays_on_its_version(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=2)
    store.apply({"t": table(spark, [("a", 1), ("b", 1)])})
    opened = store.read("t")
    for v in range(2, 6):
        store.apply({"t": table(spark, [("a", v)])})
        store.settle()
    store.evict(keep=1, pinned=(1,))
    assert content(opened) == [("a", 1), ("b", 1)] and content(store.read("t")) == [("a", 5), ("b", 1)]
    assert store.versions()[0] == 1 and len(store.versions()) == 2


def document(openid, day, *matches, standings=()):
    m = [{"groupName": g, "matchtype": kind, "winner": w, "teamA": a, "teamB": b, "scoreinfo": [{"memberA": x, "memberB": y}]} for g, kind, w, a, b, x, y in matches]
    return {"openid": openid, "name": f"n{openid}", "lastUpdated": day, "matches": m, "standings": list(standings)}


def same(a, b):
    return sorted(map(repr, a.select(sorted(a.columns)).collect())) == sorted(map(repr, b.select(sorted(a.columns)).collect()))


def test_indexes_follow_documents_in_a_stream(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), buckets=2)
    land = tmp_path / "land"
    land.mkdir()
    official = {"group": "h", "rank": 1, "unit": "u9", "members": ["z"], "source": "pdf"}
    batches = [
        [document("1", "2025-01-01", ("g", "R2", "A", "u1", "u2", "p/q", "r"), standings=[official]), document("2", "2025-01-01", ("g", "預賽", "A", "u1", "u3", "p", "s"))],
        [document("1", "2025-02-01", ("g", "R2", "B", "u1", "u2", "p/q", "r"), ("h", "R2", "A", "u5", "u6", "v", "w"), standings=[official]), document("3", "2025-02-01")],
        [document("2", "2025-03-01")],
    ]
    for k, docs in enumerate(batches):
        for d in docs:
            (land / f"{k}-{d['openid']}.json").write_text(json.dumps(d, ensure_ascii=False), encoding="utf-8")
        landing.run_store(spark, str(land), store, str(tmp_path / "checkpoint")).awaitTermination()
        for name, rows in maintenance.rebuilt(store).items():
            assert same(store.read(name), rows), name
    assert len(store.versions()) == 3
    one = store.lookup("documents", "1").first()
    assert [(s.group, s["rank"], s.unit, s.source) for s in one.standings] == [("g", 1, "u2", "derived"), ("g", 2, "u1", "derived"), ("h", 1, "u9", "pdf")]
    assert {r.name for r in store.read("players").collect()} == {"p", "q", "r", "v", "w", "z"}
    # a batch that comes again after a crash changes nothing
    again = spark.createDataFrame([("2", "x")], "openid string, name string")
    full = store.read("documents").limit(0).unionByName(again, allowMissingColumns=True)
    assert maintenance.follow(store, full, ("landing", 2)) == 3 and store.versions() == [1, 2, 3]


def test_standings_are_derived_inside_the_row(spark, tmp_path):
    docs = [document(str(i), "2025-01-01", *((rng.choice(["g", "g[1]", "h", ""]), rng.choice(["R2", "R34", "F3", "F4", "R4"]), rng.choice(["A", "B", "A", "B", ""]), rng.choice(["", "u1", "u2"]), "u3", rng.choice(["", "p", "q"]), "r") for _ in range(rng.randrange(0, 7)))) for i, rng in ((i, random.Random(i)) for i in range(60))]
    path = tmp_path / "d"
    path.mkdir()
    for d in docs:
        (path / f"{d['openid']}.json").write_text(json.dumps(d, ensure_ascii=False), encoding="utf-8")
    df = spark.read.schema(TOURNAMENT).json(str(path))
    rows = standings.derive(df)
    assert "Exchange" not in rows._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.openid, r.group, r["rank"], r.unit, tuple(r.members)) for r in rows.collect())
    assert got == sorted(x for d in docs for x in placed(d)) and len(got) > 20
    nested = flatten.standings(ingest.with_standings(df)).select("openid", "group", "rank", "unit", "members", "source")
    assert same(nested, ingest.refreshed(df).select(nested.columns))
    assert indexes.players(df).count() > 0


def placed(d):
    """Plain version of the rules."""
    groups = {}
    for m in d["matches"]:
        if g := re.sub(r"\[[^\]]*\]\s*$", "", m["groupName"]).strip():
            groups.setdefault(g, []).append(m)
    side = lambda m, s: (m[f"team{s}"], tuple(x for x in [m["scoreinfo"][0][f"member{s}"]] if x))
    for g, ms in groups.items():
        won = lambda kinds: [m for m in ms if m["matchtype"] in kinds and m["winner"]]  # noqa: E731, B023
        both = lambda m: (side(m, m["winner"]), side(m, "B" if m["winner"] == "A" else "A"))
        rows = []
        if len(won(("R2", "F2"))) == 1:
            rows += zip((1, 2), both(won(("R2", "F2"))[0]))
            if len(won(("R34",))) == 1:
                rows += zip((3, 4), both(won(("R34",))[0]))
        else:
            table = [m for m in ms if m["matchtype"] in ("F3", "F4")]
            if table and all(m["winner"] for m in table):
                wins = {}
                for m in table:
                    for s in "AB":
                        if any(side(m, s)):
                            wins[side(m, s)] = wins.get(side(m, s), 0) + (m["winner"] == s)
                rows += enumerate(sorted(wins, key=lambda e: -wins[e]), 1)
        for rank, (unit, members) in rows:
            if unit or members:
                yield d["openid"], g, rank, unit, members
