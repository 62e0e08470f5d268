"""Near-duplicate documents by an LSH forest of MinHash signatures, confirmed on full shingle sets.

1. One pass over the texts gives each document its set size, a digest of its set, and a signature: labels of ``DEPTH``
   minima for each of ``TREES`` trees and a sketch of ``SKETCH`` more.  Documents with equal sets are one class.
2. Classes are sorted once for each tree by their labels.  Neighbours in that order have the longest common prefixes:
   a class is paired with up to ``NEAR`` that follow it and share ``LEAST`` labels at least.  In a sparse region these are
   all that share so few labels; in a dense one only those with much longer prefixes: the depth adapts to the region.
   Pairs whose sketches are far apart are left out (``ESTIMATE`` is five standard errors below the threshold).
   Regions with more than ``NEAR`` neighbours are then finished: each of their classes that is not yet in the region's
   largest group is compared by sketches with all classes of the region, so that no pair with ``LEAST`` equal labels is lost.
3. Pairs give candidate groups.  The shingle sets of their classes are fetched once, and all pairs of a group are compared
   exactly.  A group beyond ``BLOCK`` classes is cut into blocks, which are then compared with the group's ``HUBS`` best
   linked classes.  That connects most classes; each one that is still apart from the group's largest component is then
   compared with all classes of the group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bit_filter, column, map_texts, materialise, passes, runs, scratch, slices, tidy
from .components import connected, stars

SHINGLE, SIMILAR = 2, 80
TREES, DEPTH, SKETCH = 16, 8, 96
LEAST, NEAR, ESTIMATE = 2, 40, 0.58
#: Classes, and shingles, that are compared in one block.
BLOCK, BLOCK_SHINGLES = 1024, 4_000_000
HUBS = 32
#: Classes of a region, and of those outside its largest group, whose sketches are compared in one task.
REGION, OUTSIDE = 8192, 1024
#: Classes, and shingles, of one block of classes that are compared with a whole group; blocks of a group in one round.
LOOSE, LOOSE_SHINGLES, LOOSE_BLOCKS = 512, 1_000_000, 8
FILTER_BITS = 26

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct shingles; fewer words than ``size`` make one shingle, no words none."""
    from xxhash import xxh3_64_intdigest

    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    span = min(size, len(h))
    out = np.full(len(h) - span + 1, span, dtype=np.uint64)
    for k in range(span):
        out = _mix(out * _ODD + h[k : k + len(out)])
    return np.unique(out)


def digest(found: np.ndarray) -> bytes:
    import hashlib

    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


class Minima:
    def __init__(self):
        rng = np.random.default_rng(11)
        n = TREES * DEPTH + SKETCH
        self.masks = rng.integers(0, 1 << 32, (n, 1), dtype=np.uint64).astype(np.uint32)
        self.factors = (rng.integers(0, 1 << 31, (n, 1), dtype=np.uint64) * 2 + 1).astype(np.uint32)

    def signature(self, found: np.ndarray) -> bytes:
        """Labels of all trees, two bytes each, then the sketch."""
        low = np.full(len(self.masks), 0xFFFFFFFF, dtype=np.uint32)
        base = (found >> np.uint64(32)).astype(np.uint32)
        for a in range(0, len(base), 2048):
            np.minimum(low, ((base[None, a : a + 2048] ^ self.masks) * self.factors).min(axis=1), out=low)
        low = (low ^ (low >> np.uint32(15))) * np.uint32(0x85EBCA6B)
        low ^= low >> np.uint32(13)
        low *= np.uint32(0xC2B2AE35)
        return (low[: TREES * DEPTH] >> np.uint32(16)).astype(">u2").tobytes() + (low[TREES * DEPTH :] >> np.uint32(24)).astype(np.uint8).tobytes()


def _signed(docs: DataFrame, size: int, sign) -> DataFrame:
    fields = [T.StructField("n", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("signature", T.BinaryType())]

    def make():
        minima = sign()

        def run(texts):
            sets = [shingles(t, size) for t in texts]
            return [[len(s) for s in sets], [digest(s) if len(s) else None for s in sets], [minima.signature(s) if len(s) else None for s in sets]]

        return run

    return map_texts(docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text")), make, fields, ["doc_id"])


# ---- candidates


def _trees(batches):
    for batch in batches:
        rep, n, sig = (batch.column(i) for i in range(3))
        if not len(batch):
            continue
        sigs = _raw(sig)
        sketch = binaries(sigs[:, 2 * TREES * DEPTH :])
        for tree in range(TREES):
            # a part of the sketch goes on where the labels end, another one for each tree
            more = 2 * DEPTH * TREES + SKETCH // TREES * tree
            label = np.concatenate([sigs[:, 2 * DEPTH * tree : 2 * DEPTH * (tree + 1)], sigs[:, more : more + SKETCH // TREES]], axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(batch), tree, np.int32)), binaries(label), rep, n, sketch], names=["tree", "label", "rep", "n", "sketch"])


#: Rows of one scan: pairs (a, b), rows at the edges of partitions (with rep), and regions that go beyond ``NEAR`` (label only).
_PAIR_SCHEMA = "a long, b long, tree int, label binary, rep long, n long, sketch binary"
_PAIR_NAMES = ["a", "b", "tree", "label", "rep", "n", "sketch"]


def _alike(sketch: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether sketches (along the last axis) are near enough; labels of a byte are equal by chance once in 256."""
    return ((sketch == other).mean(axis=-1) - 1 / 256) / (1 - 1 / 256) >= ESTIMATE


def _sized(n: np.ndarray, other: np.ndarray, threshold: int) -> np.ndarray:
    return 100 * np.minimum(n, other) >= threshold * np.maximum(n, other)


def _raw(column_: pa.Array) -> np.ndarray:
    """Binaries of one length, none of them null, as rows of bytes; without a copy."""
    if not len(column_):
        return np.zeros((0, 0), np.uint8)
    cut = np.frombuffer(column_.buffers()[1], np.int32)[column_.offset : column_.offset + len(column_) + 1]
    return np.frombuffer(column_.buffers()[2], np.uint8)[cut[0] : cut[-1]].reshape(len(column_), -1)


def binaries(rows: np.ndarray) -> pa.Array:
    """Rows of bytes as binaries."""
    cut = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(rows.shape[1])
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(cut), pa.py_buffer(np.ascontiguousarray(rows))])


def _scan(threshold: int, edges: bool, alike=None, least: int = LEAST):
    """Star edges of the pairs of neighbours in sorted rows, and regions beyond ``NEAR``; with ``edges`` also the rows at both
    ends of the partition, each once, for a second scan over the joints."""

    def row(a=None, b=None, tree=None, label=None):
        size = next(len(x) for x in (a, tree) if x is not None)
        null = pa.nulls(size)
        long = lambda x: null.cast(pa.int64()) if x is None else pa.array(np.ascontiguousarray(x), type=pa.int64())
        there = [null.cast(pa.int32()) if tree is None else pa.array(tree, type=pa.int32()), null.cast(pa.binary()) if label is None else pa.array(label, type=pa.binary())]
        return pa.RecordBatch.from_arrays([long(a), long(b), *there, long(None), long(None), null.cast(pa.binary())], names=_PAIR_NAMES)

    def near(rows):
        tree, rep, n = (rows.column(i).to_numpy() for i in (0, 2, 3))
        label = _raw(rows.column(1)).view(np.uint16)
        sketch = _raw(rows.column(4))
        pairs = []

        def same(i, lag):
            """Of the rows ``i`` those whose label begins as that of the row ``lag`` further."""
            i = i[: np.searchsorted(i, len(rows) - lag)]
            return i[(tree[i] == tree[i + lag]) & (label[i, :least] == label[i + lag, :least]).all(1)]

        # rows are sorted: one that is alike so far down is alike all the way
        alike_at = np.arange(len(rows))
        for lag in range(1, NEAR + 1):
            i = alike_at = same(alike_at, lag)
            if not len(i):
                break
            i = i[_sized(n[i], n[i + lag], threshold) & (rep[i] != rep[i + lag])]
            for a in range(0, len(i), 20_000):
                j = i[a : a + 20_000]
                j = j[(alike or _alike)(sketch[j], sketch[j + lag])]
                if len(j):
                    pairs.append(np.stack([np.minimum(rep[j], rep[j + lag]), np.maximum(rep[j], rep[j + lag])], 1))
        if pairs:  # only what they connect matters: so many rows as classes, not pairs
            got = np.unique(np.concatenate(pairs), axis=0).tolist()
            got = np.array([(b, a) for a, b in stars(got)], dtype=np.int64).reshape(-1, 2)
            yield row(a=got[:, 0], b=got[:, 1])
        if len(i := same(alike_at, NEAR + 1)):
            regions = sorted({(t, x.tobytes()) for t, x in zip(tree[i].tolist(), label[i, :least])})
            yield row(tree=[t for t, _ in regions], label=[x for _, x in regions])

    def edge(rows):
        null = pa.nulls(len(rows)).cast(pa.int64())
        return pa.RecordBatch.from_arrays([null, null, *rows.columns], names=_PAIR_NAMES)

    def run(batches):
        size = NEAR + 1
        held, seen = None, 0
        for batch in batches:
            if not len(batch):
                continue
            if edges and seen < size:
                yield edge(batch.slice(0, size - seen))
            seen += len(batch)
            rows = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0] if held is not None else batch
            yield from near(rows)
            held = rows.slice(max(0, len(rows) - size))
        if edges and seen > size:  # the first rows are told already
            yield edge(held.slice(max(0, 2 * size - seen)))

    return run


def _across(threshold: int, alike=None):
    """Star edges between the outside classes and all others of each (tree, region, outside, block) of sorted rows."""

    def run(batches):
        for rows in runs(batches, 4):
            rows = rows.combine_chunks()
            out = rows["out"].to_numpy()
            own, others = np.flatnonzero(out), np.flatnonzero(~out)
            rep, n, comp = (rows[c].to_numpy() for c in ("rep", "n", "comp"))
            sketch = _raw(rows["sketch"].combine_chunks())
            found = []
            for i in own.tolist():
                j = others[(comp[others] != comp[i]) & _sized(n[others], n[i], threshold)]
                j = j[(alike or _alike)(sketch[j], sketch[i])]
                if len(j):
                    found.append(np.stack([np.full(len(j), rep[i]), rep[j]], 1))
            if found:
                got = np.array(stars(np.concatenate(found).tolist()), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(got[:, 1])), pa.array(np.ascontiguousarray(got[:, 0]))], names=["a", "b"])

    return run


def _finished(trees: DataFrame, regions: DataFrame, groups: DataFrame, threshold: int, parts: int, alike=None) -> DataFrame:
    """``groups`` after every class outside the largest group of its region met all classes of the region.

    Pairs inside that group need no comparison, and any other pair has a class outside.  Work grows with the classes of a region
    times those outside its largest group; beyond ``REGION`` and ``OUTSIDE`` of them it is dealt to several tasks.
    """
    key = ["tree", "region"]
    members = trees.join(regions, key)
    members = members.join(groups.toDF("rep", "comp"), "rep", "left").select(*key, "rep", "n", "sketch", F.coalesce("comp", "rep").alias("comp"))
    members = materialise(members, "regions")
    sizes = members.groupBy(*key, "comp").agg(F.count("*").alias("c")).groupBy(*key)
    sizes = sizes.agg(F.sum("c").alias("all"), F.max_by("comp", F.struct("c", "comp")).alias("main"), (F.sum("c") - F.max("c")).alias("rest")).where("rest > 0")
    sizes = sizes.select(*key, "main", F.ceil(F.col("all") / REGION).alias("blocks"), F.ceil(F.col("rest") / OUTSIDE).alias("outsides"))
    members = members.join(materialise(sizes, "sizes"), key)
    block = F.pmod(F.xxhash64("rep"), F.col("blocks"))
    outside = F.pmod(F.xxhash64("rep", F.lit(1)), F.col("outsides"))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rest = ["rep", "n", "comp", "sketch"]
    own = members.where("comp <> main").select(*key, outside.alias("outside"), each("blocks").alias("block"), F.lit(True).alias("out"), *rest)
    others = members.select(*key, each("outsides").alias("outside"), block.alias("block"), F.lit(False).alias("out"), *rest)
    order = [*key, "outside", "block"]
    found = own.union(others).repartition(parts, *order).sortWithinPartitions(*order).mapInArrow(tidy(_across(threshold, alike)), "a long, b long")
    return connected(groups.union(found))


def _candidates(classes: DataFrame, threshold: int) -> DataFrame:
    """(a, b): each class (by representative) that is not the smallest of its candidate group, with the smallest."""
    return neighbours_in_order(classes, threshold, _trees, LEAST)


def neighbours_in_order(classes: DataFrame, threshold: int, trees_of, least: int, alike=None) -> DataFrame:
    """Star edges of candidate groups: classes that share the first ``least`` parts (of two bytes) of a label in a tree, and are alike.

    ``trees_of`` maps batches of (rep, n, signature) to rows (tree, label, rep, n, sketch); ``alike`` compares sketches.
    """
    with scratch(classes.sparkSession) as keep:
        trees = classes.select("rep", "n", "signature").mapInArrow(trees_of, "tree int, label binary, rep long, n long, sketch binary")
        parts = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        order = ["tree", "label", "rep"]
        found = materialise(trees.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(tidy(_scan(threshold, True, alike, least)), _PAIR_SCHEMA), "neighbours")
        bounds = found.where("rep is not null").select("tree", "label", "rep", "n", "sketch").repartition(TREES, "tree").sortWithinPartitions(*order)
        found = found.where("rep is null").union(materialise(bounds.mapInArrow(_scan(threshold, False, alike, least), _PAIR_SCHEMA), "joints"))
        groups = connected(found.where("a is not null").select("a", "b"))
        regions = materialise(found.where("a is null").select("tree", F.col("label").alias("region")).distinct(), "dense")
        if regions.limit(1).count():
            groups = _finished(trees.withColumn("region", F.substring("label", 1, 2 * least)), regions, groups, threshold, parts, alike)
        return keep(groups)


# ---- confirmation


def _fetched(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(doc_id, d, words): ids, digests and shingle sets of documents with the ids ``wanted.doc``, from one more pass over the texts.

    A bit set of fixed size leaves out most others; what it lets through goes at the join with ``wanted``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(bit_filter(wanted.select("doc"), "doc", FILTER_BITS))

    def run(batches):
        bits = np.frombuffer(shared.value, np.uint64)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            ids_ = np.array([0 if x is None else x for x in batch.column(0).to_pylist()], dtype=np.int64)
            there = passes(bits, ids_.view(np.uint64), FILTER_BITS)
            for a, b in slices(texts):
                ids, digests, sets = [], [], []
                for i in (np.flatnonzero(there[a:b]) + a).tolist():
                    found = shingles(texts[i], size)
                    if len(found):
                        ids.append(int(ids_[i]))
                        digests.append(digest(found))
                        sets.append(found.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(ids, type=pa.int64()), pa.array(digests, type=pa.binary()), pa.array(sets, type=pa.binary())], names=["doc_id", "d", "words"])

    source = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), column(docs, "text").cast("binary").alias("text")).where("doc_id is not null")
    return source.mapInArrow(tidy(run), "doc_id long, d binary, words binary")


def _links(sets: list[np.ndarray], threshold: int, first: int | None = None) -> np.ndarray:
    """Matrix of links of the ``first`` sets (all by default) to ``sets``: intersections by products over the shingles that two sets have."""
    first = len(sets) if first is None else first
    n = np.array([len(s) for s in sets], dtype=np.int64)
    value = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    new = np.concatenate(([True], value[1:] != value[:-1]))
    place = np.cumsum(new) - 1
    shared = np.bincount(place)[place] > 1
    owner, place = owner[shared], place[shared]
    _, place = np.unique(place, return_inverse=True)
    both = np.zeros((first, len(sets)), dtype=np.float64)
    width = 2048
    for a in range(0, int(place.max()) + 1 if len(place) else 0, width):
        low, high = np.searchsorted(place, [a, a + width])
        part = np.zeros((len(sets), width), dtype=np.float32)
        part[owner[low:high], place[low:high] - a] = 1
        both += part[:first] @ part.T
    link = 100 * both >= threshold * (n[:first, None] + n[None, :] - both)
    np.fill_diagonal(link, False)
    return link


def _compare(threshold: int):
    """Star edges and degrees of the nodes of each (comp, block)."""

    def run(batches):
        for rows in runs(batches, 2):
            rows = rows.combine_chunks()
            nodes, first = np.unique(rows["node"].to_numpy(), return_index=True)
            words = rows["words"].to_pylist()
            link = _links([np.frombuffer(words[i], np.uint64) for i in first.tolist()], threshold)
            degree = link.sum(axis=1)
            i, j = np.nonzero(np.triu(link))
            root = dict(stars(zip(nodes[i].tolist(), nodes[j].tolist())))
            own = nodes.tolist()
            yield pa.RecordBatch.from_arrays([pa.array(own, type=pa.int64()), pa.array([root.get(x, x) for x in own], type=pa.int64()), pa.array(np.full(len(own), rows["comp"][0].as_py())), pa.array(degree.astype(np.int64))], names=["a", "b", "comp", "degree"])

    return run


def _compare_loose(threshold: int):
    """Star edges between the loose nodes and the others of each (comp, loose_block, block)."""

    def run(batches):
        for rows in runs(batches, 3):
            rows = rows.combine_chunks()
            nodes, loose = rows["node"].to_numpy(), rows["loose"].to_numpy()
            own, others = np.flatnonzero(loose), np.flatnonzero(~loose)
            if not len(own) or not len(others):
                continue
            words = rows["words"].to_pylist()
            link = _links([np.frombuffer(words[i], np.uint64) for i in (*own.tolist(), *others.tolist())], threshold, len(own))
            i, j = np.nonzero(link[:, len(own) :])
            found = stars(zip(nodes[own][i].tolist(), nodes[others][j].tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], type=pa.int64()), pa.array([x for _, x in found], type=pa.int64())], names=["a", "b"])

    return run


def _loose_connected(large: DataFrame, edges: DataFrame, threshold: int, parts: int) -> DataFrame:
    """``edges`` (node, smallest of its component) after every class outside its group's largest component met all of its group.

    Pairs inside that component need no comparison; any other pair has a loose class.  Loose classes are taken in rounds of
    ``LOOSE_BLOCKS`` blocks a group, so that one round writes a bounded multiple of the sets; those connected meanwhile are skipped.
    """

    def rooted(edges: DataFrame) -> DataFrame:
        return large.join(edges.toDF("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))

    # one row for each group beyond a block
    sizes = rooted(edges).groupBy("comp", "root").agg(F.count("*").alias("c"))
    main = materialise(sizes.groupBy("comp").agg(F.max_by("root", F.struct("c", "root")).alias("main")), "main")
    apart = rooted(edges).join(main, "comp").where("root <> main").select("comp", "node", (F.length("words") / 8).alias("n"))
    apart = materialise(apart, "apart")
    counts = apart.groupBy("comp").agg(F.greatest(F.ceil(F.count("*") / LOOSE), F.ceil(F.sum("n") / LOOSE_SHINGLES)).alias("loose_blocks"))
    counts = materialise(counts, "loose_blocks")
    apart = apart.join(counts, "comp").select("comp", "node", F.pmod(F.xxhash64("node", F.lit(1)), "loose_blocks").alias("loose_block"))
    most = counts.agg(F.max("loose_blocks")).first()[0] or 0
    for begin in range(0, most, LOOSE_BLOCKS):
        now = rooted(edges)
        where = main.join(edges.toDF("main", "now"), "main", "left").select("comp", F.coalesce("now", "main").alias("main"))
        taken = apart.where(F.col("loose_block").between(begin, begin + LOOSE_BLOCKS - 1))
        loose = now.join(taken, ["comp", "node"]).join(where, "comp").where("root <> main")
        ranged = lambda low, high: F.explode(F.sequence(low, high))
        loose = loose.select("comp", "loose_block", ranged(F.lit(0).cast("long"), F.col("blocks") - 1).alias("block"), "node", F.lit(True).alias("loose"), "words")
        loose = materialise(loose, "loose")
        asked = materialise(loose.select("comp", "loose_block").distinct(), "asked")
        others = large.join(asked, "comp").select("comp", "loose_block", "block", "node", F.lit(False).alias("loose"), "words")
        order = ["comp", "loose_block", "block"]
        found = loose.union(others).repartition(parts, *order).sortWithinPartitions(*order).mapInArrow(tidy(_compare_loose(threshold)), "a long, b long")
        edges = connected(edges.union(found))
    return edges


def _edges(docs: DataFrame, classes: DataFrame, size: int, threshold: int, candidates=None) -> DataFrame:
    """Confirmed (a, b) that connect the classes of each component; ``candidates`` finds groups that hold all links."""
    groups = (candidates or _candidates)(classes, threshold)
    groups = groups.union(groups.select("b", "b").distinct()).toDF("node", "comp")
    groups = groups.join(classes.select("rep", "n", "digest", "doc"), F.col("node") == F.col("rep")).drop("rep")
    totals = groups.groupBy("comp").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("blocks"))
    wanted = materialise(groups.join(totals, "comp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks"))), "wanted")
    fetched = _fetched(docs, wanted, size).dropDuplicates(["doc_id", "d"])
    sets = materialise(wanted.join(fetched, (F.col("doc") == F.col("doc_id")) & (F.col("digest") == F.col("d"))).select("comp", "block", "blocks", "node", "words"), "sets")
    parts = max(8, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    schema = "a long, b long, comp long, degree long"

    def compare(rows):
        return rows.select("comp", "block", "node", "words").repartition(parts, "comp", "block").sortWithinPartitions("comp", "block").mapInArrow(tidy(_compare(threshold)), schema)

    linked = materialise(compare(sets), "linked")
    edges = linked.where("a <> b").select("a", "b")
    large = sets.where("blocks > 1")
    if not large.limit(1).count():
        return edges
    best = Window.partitionBy("comp").orderBy(F.desc("degree"), "a")
    hubs = linked.where("degree > 0").withColumn("r", F.row_number().over(best)).where(F.col("r") <= HUBS).select(F.col("a").alias("node"), "comp")
    hub_sets = large.join(hubs, ["comp", "node"]).select("comp", "blocks", "node", "words").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    again = compare(large.select("comp", "block", "node", "words").union(hub_sets.select("comp", "block", "node", "words")))
    return _loose_connected(large, connected(edges.union(again.where("a <> b").select("a", "b"))), threshold, parts)


def components(docs: DataFrame, size: int = SHINGLE, threshold: int = SIMILAR, sign=None, candidates=None) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable by links) and kept (doc_id = component_id).

    Null, empty or wordless text: size 0, linked with nothing.  Rows with equal sets are linked; rows that repeat a doc_id are
    each answered by their own text.  A null doc_id is no candidate for the smallest: alone, its component_id is null and it
    is kept.  Very long texts are taken whole; ties do not arise.  Empty table: empty result.  Other columns of ``docs`` are not
    looked at, whatever their names.
    """
    with scratch(docs.sparkSession) as keep:
        signed = keep(materialise(_signed(docs, size, sign or Minima), "signed"))
        named = keep(_named(docs, signed, size, threshold, candidates))
    out = signed.select("doc_id", F.col("n").alias("n_shingles"), "digest").join(named, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _named(docs: DataFrame, signed: DataFrame, size: int, threshold: int, candidates=None) -> DataFrame:
    """Table of (digest, component_id)."""
    classes = (
        signed.where("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("doc"), F.first("n").alias("n"), F.first("signature").alias("signature"))
        .withColumn("rep", F.col("doc"))
    )
    twice = classes.groupBy("doc").agg(F.count("*").alias("c")).where("c > 1").limit(1).count()
    if twice:  # a repeated doc_id with different texts: a node for each text, and the smallest id is looked up at the end
        order = F.row_number().over(Window.partitionBy("doc").orderBy("digest"))
        classes = classes.withColumn("rep", F.when(order == 1, F.col("doc")).otherwise(F.xxhash64("digest")))
    classes = materialise(classes, "classes")
    labels = connected(_edges(docs, classes, size, threshold, candidates)).toDF("rep", "component")
    named = classes.join(labels, "rep", "left").select("digest", "doc", F.coalesce("component", "rep").alias("component_id"))
    if twice:
        least = named.groupBy("component_id").agg(F.min("doc").alias("least"))
        named = named.join(least, "component_id").select("digest", F.col("least").alias("component_id"))
    return materialise(named.select("digest", "component_id"), "components")


def representatives(docs: DataFrame, size: int = SHINGLE, threshold: int = SIMILAR) -> DataFrame:
    """``docs`` with one document of each group of near copies, the one with the smallest doc_id; columns as they were.

    Rows that repeat both the doc_id and the text of a kept document are that document, and stay; so do null and wordless texts.
    Empty table: empty result.  Other columns may have any names.
    """
    found = components(docs, size, threshold).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(found, column(docs, "doc_id").cast("long").eqNullSafe(found["__kept"]), "left_semi")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[^\x20\x09-\x0D]+'),[]) w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, greatest(len(w)-1,1)+1)) s FROM d WHERE len(w)>0),
x AS (SELECT DISTINCT doc_id, array_to_string(w[s:s+1],' ') g FROM p),
n AS (SELECT doc_id, count(*) n FROM x GROUP BY 1),
i AS (SELECT a.doc_id a, b.doc_id b, count(*) c FROM x a JOIN x b ON a.g=b.g AND a.doc_id<>b.doc_id GROUP BY 1,2),
e AS (SELECT a, b FROM i JOIN n na ON na.doc_id=a JOIN n nb ON nb.doc_id=b WHERE 100*c >= 80*(na.n+nb.n-c)),
r(doc_id, v) AS (SELECT doc_id, doc_id FROM d UNION SELECT e.b, r.v FROM r JOIN e ON e.a=r.doc_id),
m AS (SELECT doc_id, min(v) component_id FROM r GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n,0) AS BIGINT) n_shingles, component_id, d.doc_id=component_id kept FROM d JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
"""
