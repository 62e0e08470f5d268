"""Target encoding, hard negatives and the count-vector join against brute force, with nulls, ties, repeats and empty tables."""

import datetime
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rallyframe.llm import count_join, hard_negatives, near_dedup, time_encoding

# ---- target encoding

START = datetime.datetime(2024, 1, 1)


def shop(spark, seed, lines=700, sales=160, step=datetime.timedelta(seconds=1), hot=False):
    rng = random.Random(seed)
    sold = [(i, rng.choice([None, 1, 2, 3, 9]), None if rng.random() < 0.05 else START + step * rng.randrange(300), "x") for i in range(sales)]
    rows = [(rng.choice([None, *range(sales + 5)]), 0 if hot and rng.random() < 0.6 else rng.choice([None, *range(12)]), rng.choice([None, *range(6)]), rng.choice([None, "kept", "returned"]), "x") for _ in range(lines)]
    rows += rows[:40]
    items = [(i, rng.choice([None, "a", "b"]), "x") for i in range(9)]
    vendors = [(i, rng.choice([None, 1, 2]), "x") for i in range(5)]
    clients = [(i, rng.choice([None, "s", "t"]), "x") for i in range(1, 4)]
    made = [
        spark.createDataFrame(rows, "sale_id long, item_id long, vendor_id long, flag string, t string"), spark.createDataFrame(sold, "sale_id long, client_id long, sold_at timestamp_ntz, fold string"),
        spark.createDataFrame(items, "item_id long, kind string, n string"), spark.createDataFrame(vendors, "vendor_id long, nation_id int, n string"), spark.createDataFrame(clients, "client_id long, segment string, low string"),
    ]
    return made, (rows, sold, items, vendors, clients)


def encoded(rows, sold, items, vendors, clients):
    sale = {s: (-1 if c is None else c, t, zlib.crc32(str(s).encode()) % 5) for s, c, t, _ in sold if t is not None}
    kind, nation, segment = ({r[0]: r[1] for r in x} for x in (items, vendors, clients))
    lines = []
    for s, i, v, flag, _ in rows:
        if s in sale:
            c, t, fold = sale[s]
            i = -1 if i is None else i
            lines.append((s, i, v, c, t, fold, int(flag == "returned"), kind.get(i), nation.get(v), segment.get(c)))

    def past(line, of):
        found = [x for x in lines if x[5] != line[5] and x[4] < line[4] and of(x) == of(line)]
        return len(found), sum(x[6] for x in found)

    def rate(n, s, p):
        return p if n < 1 else (1_000_000 * s + 50 * p) // (n + 50)

    out = {}
    for x in lines:
        p = rate(*past(x, lambda y: 0), 500_000)
        row = []
        for place, group in ((1, 7), (2, 8), (3, 9)):
            n, s = past(x, lambda y: y[place])
            row += [n, rate(n, s, rate(*past(x, lambda y: y[group]), p))]
        n, s, _ = out.get(x[:3], (0, 0, None))
        out[x[:3]] = (n + 1, s + x[6], tuple(row))
    return sorted(((*k, v[0], v[1], *v[2]) for k, v in out.items()), key=repr)


COLUMNS = ["sale_id", "item_id", "vendor_id", "n_lines", "n_returned", "item_n", "item_rate", "vendor_n", "vendor_rate", "client_n", "client_rate"]


@pytest.mark.parametrize("leaf,ticks,step", [(1024, 12, 1), (2, 1, 1), (8, 3, 0.001), (4, 12, 0.000001)])
def test_time_encoding_equals_brute_force(spark, monkeypatch, leaf, ticks, step):
    monkeypatch.setattr(time_encoding, "LEAF", leaf)
    monkeypatch.setattr(time_encoding, "TICKS", ticks)
    tables, plain = shop(spark, leaf, step=datetime.timedelta(seconds=step), hot=True)
    got = sorted((tuple(r) for r in time_encoding.encode(*tables).select(*COLUMNS).collect()), key=repr)
    assert got == encoded(*plain)


def test_time_encoding_of_empty_tables(spark):
    tables, _ = shop(spark, 1)
    empty = [t.where("false") for t in tables]
    assert time_encoding.encode(*empty).count() == 0
    assert time_encoding.encode(tables[0], empty[1], *tables[2:]).count() == 0
    alone = time_encoding.encode(*tables[:2], *empty[2:])
    assert alone.columns == COLUMNS and alone.count() > 0


def test_fold_is_crc32_of_digits(spark):
    got = spark.range(-3, 300).select("id", time_encoding.fold_of(F.col("id")).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)


# ---- hard negatives


def mined(rows):
    usable = []
    for k, (i, v, label) in enumerate(rows):
        if i is None or v is None or label is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, k, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, k, label, v in usable:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, m, other) for j, m, other, w in usable if m != k and len(w) == len(v))
        for s, j, _, _ in [x for x in scored if x[3] == label][:5]:
            window = [(n, t) for t, n, _, other in scored if other != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, j, r + 1, n, -s, -t) for r, (n, t) in enumerate(window[:10])]
    return sorted(out)


def vectors(seed, n, hot=0.0):
    rng = np.random.default_rng(seed)
    common = rng.normal(size=12) / 3
    rows = []
    for i in range(n):
        v = common if rng.random() < hot else rng.normal(size=12) / 3 + 0.1
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(0, 3))))
    return rows


@pytest.mark.parametrize("hot", [0.0, 0.5])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(hard_negatives, "ROWS", 128)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 3)
    rows = vectors(3, 900, hot)
    rows += [(1000, None, 1), (1001, [1.0, None] * 6, 1), (1002, [float("nan")] * 12, 1), (1100, [0.0] * 12, 1), (1200, [0.5, 0.25], 0), (1201, [0.5, 0.5], 0), (1202, [0.5, 0.1], 1), (None, [1.0] * 12, 1), (1003, [1.0] * 12, None), (1300, [], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumn("row", F.lit("clash")).withColumn("V", F.lit("clash")).repartition(5)
    got = sorted(tuple(r) for r in hard_negatives.mine(df).collect())
    assert got == mined(rows) and len(got) > 100


def test_hard_negatives_of_an_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(df).count() == 0


def test_bounds_hold(spark):
    df = spark.createDataFrame([(0, 0, i, i % 3, [int(x) for x in v]) for i, v in enumerate(np.random.default_rng(1).integers(-300, 300, (500, 9)))], "dims int, block int, row long, label long, v array<long>")
    df = df.withColumn("dims", F.size("v"))
    record = df.coalesce(1).mapInArrow(hard_negatives._file, hard_negatives._FILE).first().asDict()
    values = np.array([r.v for r in df.collect()], float)
    low, high = hard_negatives._bounds(record, values[:20])
    exact = 2 * values[:20] @ values.T
    assert (low <= exact).all() and (exact <= high).all() and (high - low).mean() < 0.2 * np.ptp(exact)


# ---- count-vector join


def components(rows, size=3, similar=90):
    sets = []
    for i, text in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").split()
        span = min(size, len(words))
        sets.append((i, {tuple(words[k : k + span]) for k in range(len(words) - span + 1)} if words else set()))
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and 100 * len(x & y) >= similar * len(x | y):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return sorted((i, len(x), find(i)) for i, x in sets)


def corpus(seed, families, copies, words):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(*words))]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(0, 1 + len(text) // 25)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(text)))
    return rows + [(len(rows), None), (len(rows) + 1, ""), (len(rows) + 2, "One"), (len(rows) + 3, "one"), (len(rows) + 4, " \t ")]


@pytest.mark.parametrize("families,copies,words", [(60, 6, (4, 40)), (25, 8, (60, 300)), (3, 120, (80, 140)), (2, 4, (3000, 6000))])
def test_count_join_equals_brute_force(spark, families, copies, words):
    rows = corpus(families, families, copies, words)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("clash")).withColumn("Tree", F.lit("clash")).repartition(3)
    got = sorted(tuple(r) for r in count_join.join(df).select("doc_id", "n_shingles", "component_id").collect())
    assert got == components(rows)


def test_count_join_at_other_sizes_and_thresholds(spark):
    rows = corpus(8, 30, 5, (10, 80))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for size, similar in ((1, 80), (2, 95)):
        got = sorted(tuple(r) for r in count_join.join(df, size, similar).select("doc_id", "n_shingles", "component_id").collect())
        assert got == components(rows, size, similar)
    assert count_join.join(df.where("false")).count() == 0


def test_linked_sets_agree_in_a_subspace():
    rng = np.random.default_rng(5)
    points = count_join.Points()
    for n in (9, 10, 11, 19, 20, 57, 200, 1234, 9000):
        for _ in range(20):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            most = (len(a) * 10) // 9 - len(a)
            b = np.unique(np.concatenate([a, rng.integers(0, 1 << 63, rng.integers(0, most + 1)).astype(np.uint64)]))
            gone = int(rng.integers(0, len(a) // 19 + 1))
            b = b[gone:]
            both = len(np.intersect1d(a, b))
            if 100 * both < 90 * (len(a) + len(b) - both) or np.array_equal(a, b):
                continue
            entries = [{(r["tree"], r["label"]) for batch in count_join._entries(iter([_batch(points, x)])) for r in batch.to_pylist()} for x in (a, b)]
            assert entries[0] & entries[1]
            x, y = (np.frombuffer(points.signature(s)[: count_join._SKETCH], np.uint8) for s in (a, b))
            assert count_join._bound(90)(x, y)


def _batch(points, found):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array([1]), pa.array([len(found)]), pa.array([points.signature(found)], type=pa.binary())], names=["rep", "n", "signature"])


def test_shingles_are_whole_short_texts():
    assert len(near_dedup.shingles(b"a b", 3)) == 1 and len(near_dedup.shingles(b"a b c d", 3)) == 2


def test_scan_stops_where_no_rows_are_alike(monkeypatch):
    """Runs of up to three alike labels: pairs are those of brute force, and no lag beyond a run is looked at."""
    import pyarrow as pa

    from rallyframe.llm.components import stars

    calls = []
    sized = near_dedup._sized
    monkeypatch.setattr(near_dedup, "_sized", lambda *x: calls.append(1) or sized(*x))
    rng = np.random.default_rng(2)
    labels = [x for i in range(300) for x in [i.to_bytes(4, "big")] * int(rng.integers(1, 4))]
    n = rng.integers(90, 110, len(labels))
    binary = lambda rows: pa.array(rows, type=pa.binary())
    rows = pa.RecordBatch.from_arrays([pa.array(np.zeros(len(labels), np.int32)), binary(labels), pa.array(np.arange(len(labels))), pa.array(n), binary([b"s"] * len(labels))], names=["tree", "label", "rep", "n", "sketch"])
    out = pa.Table.from_batches(near_dedup._scan(90, False, lambda a, b: np.ones(len(a), bool), 2)(iter([rows.slice(7)]))).to_pylist()
    near = [(i, j) for i in range(7, len(labels)) for j in range(i + 1, min(i + 3, len(labels))) if labels[i] == labels[j] and 10 * min(n[i], n[j]) >= 9 * max(n[i], n[j])]
    assert {(r["b"], r["a"]) for r in out} == set(stars(near)) and len(near) > 100
    assert len(calls) <= 2
    bytes_ = rng.integers(0, 256, (5, 3)).astype(np.uint8)
    assert near_dedup.binaries(bytes_).to_pylist() == [x.tobytes() for x in bytes_] and (near_dedup._raw(near_dedup.binaries(bytes_).slice(2)) == bytes_[2:]).all()


def test_members_with_few_to_be_told_are_not_ranked(monkeypatch):
    """At an owner each member is told the better others, a fresh one among the two; ranked are only those with too many."""
    import pyarrow as pa

    from rallyframe.llm import neighbours

    rng = np.random.default_rng(6)
    m = rng.standard_normal((30, 8)).astype(np.float32)
    least = np.full(30, 1.0, np.float32)
    fresh = rng.random(30) < 0.5
    row = lambda **given: {"part": 0, "kind": 0, "owner": None, "member": None, "members": None, "fresh": None, "least": None, "v": None} | given
    rows = [row(member=i, least=float(least[i]), v=x.tobytes()) for i, x in enumerate(m)] + [row(kind=2, owner=3, members=list(range(30)), fresh=fresh.tolist())]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.float32(), pa.binary()]
    batch = pa.RecordBatch.from_pylist(rows, schema=pa.schema(list(zip(rows[0], kinds))))
    s = m @ m.T

    def told(most):
        monkeypatch.setattr(neighbours, "TOLD", most)
        got = {r["node"]: set(r["ids"]) for b in neighbours._join(iter([batch])) for r in b.to_pylist()}
        want = {i: sorted((j for j in range(30) if j != i and s[i, j] > least[i] and (fresh[i] or fresh[j])), key=lambda j: -s[i, j])[:most] for i in range(30)}
        assert got == {i: set(x) for i, x in want.items() if x}

    told(3)

    def ranked(*_, **__):
        raise AssertionError("ranked")

    monkeypatch.setattr(np, "argpartition", ranked)
    told(29)
