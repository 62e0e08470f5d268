"""Substring dedup by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document; its minimiser is the leftmost of its ``GRAM``-word grams with the
smallest hash.  Consecutive windows that share a minimiser travel as one packed string to the minimiser's bucket, where
sorting brings equal windows together and all but the earliest are marked.

- A minimiser that occurs once in the corpus has no repeated window; a first pass counts minimisers and keeps a bit set of
  fixed size of those that occur again, so that little but repeated text travels.
- A task first sorts its own windows and sends only the earliest of equal ones, so a passage that a third of all documents
  share reaches its bucket once for each slice of a task.
- Windows of a minimiser that occurs more than ``HOT`` times travel one by one, dealt by their own hash; a bit set of fixed size
  marks such minimisers, and what it marks by chance is only dealt in the same way.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bit_filter, column, materialise, passes, slices, tidy

WINDOW, GRAM = 20, 6
#: Slots of the bit set of minimisers that occur again.  Beyond some 10^8 of them it fills up, and more text travels, with equal results.
FILTER_BITS = 27
#: Occurrences beyond which a minimiser is hot, and slots of the bit set of those.
HOT, HOT_BITS = 1_000, 24
#: Windows that a bucket task sorts at once; a bucket is never divided.
SORTED_AT_ONCE = 300_000
#: Words of the stream that are looked at together.
BLOCK = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def runs_of(hashes: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows and minimiser of each super-k-mer of one document's word hashes."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    value = np.zeros(len(hashes) - gram + 1, dtype=np.uint64)
    for k in range(gram):
        value = value * _ODD + hashes[k : k + len(value)]
    value = _mix(value)
    best, at, size, width = value, np.arange(len(value)), 1, window - gram + 1
    while size < width:
        step = min(size, width - size)
        left, right = best[:-step], best[step:]
        first = left <= right
        best, at = np.where(first, left, right), np.where(first, at[:-step], at[step:])
        size += step
    start = np.flatnonzero(np.diff(at, prepend=-1))
    return start, np.diff(start, append=n), best[start]


def later_windows(ids: np.ndarray, at: np.ndarray, keys: list[np.ndarray], window: int = WINDOW) -> np.ndarray:
    """For windows that begin at ``at`` of ``ids``, whether an equal one has smaller keys; exact, word by word."""
    if not len(at):
        return np.zeros(0, bool)
    h = np.zeros(len(at), dtype=np.uint64)
    mixed = _mix(ids.astype(np.uint64) + np.uint64(1))
    for k in range(window):
        h = h * _ODD + mixed[at + k]
    order = np.lexsort((*reversed(keys), h))
    same = h[order[1:]] == h[order[:-1]]
    pair = np.flatnonzero(same)
    for k in range(window):
        if (ids[at[order[pair + 1]] + k] != ids[at[order[pair]] + k]).any():  # a collision: order by the words themselves
            order = np.lexsort((*reversed(keys), *(ids[at + j] for j in range(window))))
            same = np.ones(len(at) - 1, bool)
            for j in range(window):
                same &= ids[at[order[1:]] + j] == ids[at[order[:-1]] + j]
            break
    first = np.maximum.accumulate(np.where(np.concatenate(([True], ~same)), np.arange(len(at)), 0))
    later = np.zeros(len(at), dtype=bool)
    differs = np.zeros(len(at), dtype=bool)
    for key in keys:
        differs |= key[order] != key[order[first]]
    later[order] = differs
    return later


def _stretches(flags: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of stretches of true ``flags``; ``joined[i]`` tells whether i goes on from i - 1."""
    on = np.flatnonzero(flags)
    if not len(on):
        return on, on
    cut = np.concatenate(([True], (np.diff(on) > 1) | ~joined[on[1:]]))
    begin = on[cut]
    end = np.concatenate((on[np.flatnonzero(cut)[1:] - 1], on[-1:])) + 1
    return begin, end


def _expand(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    return np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _minimisers(texts: DataFrame) -> DataFrame:
    """Minimisers with the number of super-k-mers they have, over all documents."""

    def run(batches):
        for batch in batches:
            texts_ = batch.column(0).to_pylist()
            for a, b in slices(texts_):
                got = [runs_of(word_hashes(t.split()))[2] for t in texts_[a:b] if t]
                value, n = np.unique(np.concatenate(got) if got else np.zeros(0, np.uint64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], names=["m", "n"])

    return texts.mapInArrow(tidy(run), "m long, n long").groupBy("m").agg(F.sum("n").alias("n"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Word spans (doc_id, text_hash, start, size) of windows that start earlier elsewhere; spans may overlap or repeat."""
    spark = docs.sparkSession
    source = docs.select(column(docs, "doc_id").cast("long").alias("doc_id"), F.xxhash64(column(docs, "text")).alias("h"), column(docs, "text").cast("binary").alias("text"))
    counted = materialise(_minimisers(source.select("text")).where("n > 1"), "minimisers")
    shared = spark.sparkContext.broadcast((bit_filter(counted, "m", FILTER_BITS), bit_filter(counted.where(F.col("n") > HOT), "m", HOT_BITS)))

    schema = "m long, doc_id long, h long, start int, size int, words binary"
    names = ["m", "doc_id", "h", "start", "size", "words"]

    def send(batches):
        bits, hot = (np.frombuffer(x, np.uint64) for x in shared.value)
        for batch in batches:
            texts = batch.column(2).to_pylist()
            doc_ids = np.array([-(1 << 63) if x is None else x for x in batch.column(0).to_pylist()], dtype=np.int64)
            hashes = np.array(batch.column(1).to_pylist(), dtype=np.int64)
            for a, b in slices(texts):
                yield from _send(texts[a:b], doc_ids[a:b], hashes[a:b], bits, hot)

    def _send(texts, doc_ids, hashes, bits, hot):
        place: dict[bytes, int] = {}
        words_of, stream, starts, sizes, values, docs_, firsts = [], [], [], [], [], [], []
        at = 0
        for d, text in enumerate(texts):
            words = text.split() if text else []
            words_of.append(words)
            if len(words) < WINDOW:
                continue
            start, size, value = runs_of(word_hashes(words))
            kept = passes(bits, value, FILTER_BITS)
            if not kept.any():
                continue
            start, size, value = start[kept], size[kept], value[kept]
            need = np.zeros(len(words) + 1, np.int32)
            np.add.at(need, start, 1)
            np.add.at(need, start + size + WINDOW - 1, -1)
            need = np.cumsum(need)[:-1] > 0
            ids = np.full(len(words), -1, np.int64)
            where = np.flatnonzero(need)
            ids[where] = [place.setdefault(words[i], len(place)) for i in where.tolist()]
            stream.append(ids)
            starts.append(start + at)
            sizes.append(size)
            values.append(value)
            docs_.append(np.full(len(start), d))
            firsts.append(np.full(len(start), at))
            at += len(words)
        if not starts:
            return
        ids, start, size, value, doc, first = map(np.concatenate, (stream, starts, sizes, values, docs_, firsts))
        where, run = _expand(start, size), np.repeat(np.arange(len(start)), size)
        d, s = doc[run], where - first[run]
        later = later_windows(ids, where, [doc_ids[d], hashes[d], s])
        goes_on = np.concatenate(([False], (d[1:] == d[:-1]) & (s[1:] == s[:-1] + 1)))
        b, e = _stretches(later, goes_on)
        yield _rows(_mix(hashes[d[b]].view(np.uint64)), doc_ids[d[b]], hashes[d[b]], s[b], e - b + WINDOW - 1, [None] * len(b))
        single = passes(hot, value, HOT_BITS)
        same_run = np.concatenate(([False], (run[1:] == run[:-1]) & ~single[run[1:]])) & goes_on
        b, e = _stretches(~later, same_run)
        m = value[run[b]].copy()
        packed = [b" ".join(words_of[d[i]][s[i] : s[i] + n]) for i, n in zip(b.tolist(), (e - b + WINDOW - 1).tolist())]
        for i in np.flatnonzero(single[run[b]]).tolist():
            m[i] = np.uint64(int.from_bytes(hashlib.blake2b(packed[i], digest_size=8).digest(), "little"))
        for i in range(0, len(b), 20_000):
            j = slice(i, i + 20_000)
            yield _rows(m[j], doc_ids[d[b[j]]], hashes[d[b[j]]], s[b[j]], (e - b)[j] + WINDOW - 1, packed[j])

    def _rows(m, doc_id, h, start, size, words):
        arrays = [pa.array(np.ascontiguousarray(m).view(np.int64)), pa.array(doc_id), pa.array(h), pa.array(start.astype(np.int32)), pa.array(size.astype(np.int32)), pa.array(words, type=pa.binary())]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def bucket(batches):
        held: list = []
        windows = 0
        for batch in batches:
            m = batch.column(0).to_numpy()
            cut = np.concatenate(([0], np.flatnonzero(np.diff(m)) + 1, [len(m)]))
            size = batch.column(4).to_numpy()
            for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                if b <= a:
                    continue
                if windows > SORTED_AT_ONCE and held and held[-1].column(0)[-1].as_py() != m[a]:
                    yield from _bucket(held)
                    held, windows = [], 0
                held.append(batch.slice(a, b - a))
                windows += int((size[a:b] - WINDOW + 1).sum())
        if held:
            yield from _bucket(held)

    def _bucket(held):
        rows = pa.Table.from_batches(held).combine_chunks()
        told = rows.filter(rows["words"].is_null())
        if told.num_rows:
            yield from told.select(["doc_id", "h", "start", "size"]).to_batches()
        rows = rows.filter(rows["words"].is_valid())
        if not rows.num_rows:
            return
        place: dict[bytes, int] = {}
        parts = [w.split(b" ") for w in rows["words"].to_pylist()]
        ids = np.fromiter((place.setdefault(w, len(place)) for p in parts for w in p), dtype=np.int64, count=sum(map(len, parts)))
        doc_id, h, start, n = (rows[c].to_numpy() for c in ("doc_id", "h", "start", "size"))
        first = np.cumsum(n) - n
        where, run = _expand(first, n - WINDOW + 1), np.repeat(np.arange(len(n)), n - WINDOW + 1)
        s = start[run] + where - first[run]
        later = later_windows(ids, where, [doc_id[run], h[run], s])
        b, e = _stretches(later, np.concatenate(([False], run[1:] == run[:-1])))
        yield pa.RecordBatch.from_arrays([pa.array(doc_id[run[b]]), pa.array(h[run[b]]), pa.array(s[b].astype(np.int32)), pa.array((e - b + WINDOW - 1).astype(np.int32))], names=["doc_id", "h", "start", "size"])

    sent = source.mapInArrow(tidy(send), schema)
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return sent.repartition(n, "m").sortWithinPartitions("m").mapInArrow(tidy(bucket), "doc_id long, h long, start int, size int")


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document.

    Removed are words in a window that also starts earlier: in a document with a smaller id, or earlier in the same one.
    Null or wordless text: no words, the hash of the empty string.  Fewer than ``WINDOW`` words: nothing removed.  Rows with one
    doc_id and one text are one document, each answered alike; rows with one doc_id and different texts are
    ordered by the texts' hashes.  A null doc_id comes before all others.  Very long texts are taken whole.  Empty table: no rows.
    Other columns may have any names.
    """
    spans = (
        repeated_spans(docs)
        .groupBy("doc_id", "h")
        .agg(F.collect_set(F.struct("start", "size")).alias("spans"))  # at most one for each word of a document
        .select(F.col("doc_id").alias("__doc"), F.col("h").alias("__h"), F.col("spans.start").alias("starts"), F.col("spans.size").alias("sizes"))
    )
    source = docs.select(column(docs, "doc_id"), column(docs, "text"))
    source = source.withColumn("__h2", F.xxhash64("text")).withColumn("__d2", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))))
    joined = source.join(spans, (F.col("__d2") == F.col("__doc")) & (F.col("__h2") == F.col("__h")), "left").select("doc_id", "text", "starts", "sizes")
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    schema = T.StructType([joined.schema["doc_id"], *fields])

    def run(batches):
        for batch in batches:
            total, removed, digest = [], [], []
            starts, sizes = (batch.column(i) for i in (2, 3))
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = text.split() if text else []
                if starts[i].is_valid:
                    depth = np.zeros(len(words) + 1, np.int32)
                    start, size = starts[i].values.to_numpy(), sizes[i].values.to_numpy()
                    np.add.at(depth, start, 1)
                    np.add.at(depth, start + size, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(depth)[:-1] == 0).tolist()]
                else:
                    kept = words
                total.append(len(words))
                removed.append(len(words) - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(total, type=pa.int64()), pa.array(removed, type=pa.int64()), pa.array(digest)], names=schema.names)

    return joined.select("doc_id", F.col("text").cast("binary").alias("text"), "starts", "sizes").mapInArrow(tidy(run), schema)


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text,'[^\x20\x09-\x0D]+'),[]) w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w)-18)) s FROM d WHERE len(w)>=20),
x AS (SELECT doc_id, s, array_to_string(w[s:s+19],' ') g FROM p),
r AS (SELECT doc_id, s, row_number() OVER (PARTITION BY g ORDER BY doc_id, s) k FROM x),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s+20)) i FROM r WHERE k>1),
u AS (SELECT doc_id, w, unnest(range(1, len(w)+1)) i FROM d WHERE len(w)>0),
k AS (SELECT u.doc_id, string_agg(u.w[u.i], ' ' ORDER BY u.i) t, count(*) n FROM u LEFT JOIN c ON u.doc_id=c.doc_id AND u.i=c.i WHERE c.i IS NULL GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) n_words, CAST(len(w)-coalesce(n,0) AS BIGINT) n_removed, sha256(coalesce(t,'')) kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
