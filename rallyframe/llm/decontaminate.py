"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A pattern is a window of ``WINDOW`` consecutive words of a benchmark text, or all its words if it has fewer.  Patterns of
one length share a table of shifts by the hash of a block of two words, buckets of patterns by the hash of their last
block, and are confirmed by direct comparison.  The text stream of a batch is cut into lanes that advance together, each
by the shift of its own block, so that most positions are never looked at.

Patterns are searched in chunks of at most ``CHUNK`` (window, item) pairs, without a shuffle of documents.  ``TOGETHER``
chunks are broadcast at once; documents and what was found so far are written before the next ones, so that neither broadcasts
nor tasks hold more as the benchmark grows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, discard, map_texts, materialise, scratch, without

WINDOW = 10
#: Most (window, item) pairs that are broadcast at once, about 100 bytes each.
CHUNK = 200_000
#: Chunks that one pass over the documents searches.
TOGETHER = 2
SHIFT_BITS = 18
LANES = 4096

#: A-Z become a-z; bytes of digits, letters and non-ASCII characters stay; all others become spaces.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def _block(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Slot of the block of the words with ids ``a`` and ``b``."""
    mixed = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed >> np.uint64(64 - SHIFT_BITS)).astype(np.int64)


class Searcher:
    """Shift tables and suffix buckets for the patterns of each length."""

    def __init__(self, patterns: list[tuple[list[bytes], object]]):
        self.vocabulary: dict[bytes, int] = {}
        self.items = sorted({item for _, item in patterns})
        place = {item: i for i, item in enumerate(self.items)}
        by_words: dict[tuple, list[int]] = {}
        for words, item in patterns:
            key = tuple(self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words)
            by_words.setdefault(key, []).append(place[item])
        self.groups = []
        for length in sorted({len(k) for k in by_words}):
            keys = [k for k in by_words if len(k) == length]
            ids = np.array(keys, dtype=np.int32).reshape(len(keys), length)
            first = ids[:, -2] if length > 1 else np.zeros(len(keys), np.int32)
            suffix = _block(first, ids[:, -1])
            order = np.argsort(suffix, kind="stable")
            ids, suffix = ids[order], suffix[order]
            shift = np.full(1 << SHIFT_BITS, max(1, length - 1), dtype=np.int64)
            if length == 1:
                shift[suffix] = 0
            for end in range(1, length):
                np.minimum.at(shift, _block(ids[:, end - 1], ids[:, end]), length - 1 - end)
            owners = [by_words[keys[i]] for i in order]
            self.groups.append((length, ids, shift, suffix, np.array([len(x) for x in owners]), np.array([y for x in owners for y in x], dtype=np.int64)))

    def find(self, stream: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, length and item place of each occurrence in a stream of word ids; 0 is a word that no pattern has."""
        found = []
        for length, ids, shift, suffix, n_owners, owners in self.groups:
            ends = self._candidates(stream, length, shift)
            low, high = np.searchsorted(suffix, (h := self._at(stream, ends, length)), "left"), np.searchsorted(suffix, h, "right")
            count = high - low
            at = np.repeat(ends, count)
            which = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])) if len(count) else low, count) + np.arange(count.sum())
            for k in range(length):  # the first words decide most comparisons
                same = stream[at - (length - 1) + k] == ids[which, k]
                at, which = at[same], which[same]
            first = np.concatenate(([0], np.cumsum(n_owners)))
            n = n_owners[which]
            own = owners[np.repeat(first[which] - np.concatenate(([0], np.cumsum(n)[:-1])) if len(n) else first[which], n) + np.arange(n.sum())] if len(which) else np.zeros(0, np.int64)
            found.append((np.repeat(at - (length - 1), n), np.full(len(own), length), own))
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3

    @staticmethod
    def _at(stream: np.ndarray, ends: np.ndarray, length: int) -> np.ndarray:
        return _block(stream[ends - 1] if length > 1 else np.zeros(len(ends), np.int32), stream[ends])

    def _candidates(self, stream: np.ndarray, length: int, shift: np.ndarray) -> np.ndarray:
        n = len(stream)
        lanes = max(1, min(LANES, n // 64))
        bounds = np.linspace(0, n, lanes + 1).astype(np.int64)
        at, stop, out = np.maximum(bounds[:-1], length - 1), bounds[1:], []
        while True:
            live = at < stop
            if not live.all():
                at, stop = at[live], stop[live]
            if not len(at):
                break
            step = shift[self._at(stream, at, length)]
            out.append(at[step == 0])
            at = at + np.maximum(step, 1)
        return np.sort(np.concatenate(out)) if out else np.zeros(0, np.int64)

    def search(self, texts: list[bytes | None]) -> tuple[list[int], list[np.ndarray], list[list]]:
        """For each text: number of words, merged word spans that are hit (n x 2), items with occurring windows."""
        ids, starts, counts, get = [], [], [], self.vocabulary.get
        total = 0
        for text in texts:
            words = words_of(text)
            ids.append(np.fromiter((get(w, 0) for w in words), dtype=np.int32, count=len(words)))
            ids.append(np.zeros(1, np.int32))
            starts.append(total)
            counts.append(len(words))
            total += len(words) + 1
        stream = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        at, length, item = self.find(stream)
        starts_ = np.array(starts, dtype=np.int64)
        spans: list[np.ndarray] = [np.zeros((0, 2), np.int32)] * len(texts)
        items: list[list] = [[] for _ in texts]
        if len(at):
            depth = np.zeros(total + 1, dtype=np.int32)
            np.add.at(depth, at, 1)
            np.add.at(depth, at + length, -1)
            edge = np.flatnonzero(np.diff((np.cumsum(depth) > 0).astype(np.int8), prepend=0))
            runs = edge.reshape(-1, 2)
            doc = np.searchsorted(starts_, runs[:, 0], "right") - 1
            for d in np.unique(doc):
                spans[d] = (runs[doc == d] - starts_[d]).astype(np.int32)
            pairs = np.unique(np.stack([np.searchsorted(starts_, at, "right") - 1, item], axis=1), axis=0)
            for d, i in pairs.tolist():
                items[d].append(self.items[i])
        return counts, spans, items


def patterns_of(benchmark: DataFrame, window: int = WINDOW, item: str = "item_id") -> DataFrame:
    """Distinct (words, item): ``words`` is a window's words joined by spaces, as bytes.  Items of null or wordless text, and null ids, have none."""
    fields = [T.StructField("windows", T.ArrayType(T.BinaryType()))]

    def make():
        def run(texts):
            out = []
            for text in texts:
                w = words_of(text)
                out.append(list(dict.fromkeys(b" ".join(w[i : i + window]) for i in range(max(1, len(w) - window + 1)))) if w else [])
            return [out]

        return run

    item_type = benchmark.schema[item].dataType
    source = benchmark.select(column(benchmark, item).cast(item_type).alias("item"), column(benchmark, "text").alias("text")).where("item is not null")
    return map_texts(source, make, fields, ["item"]).select("item", F.explode("windows").alias("words")).distinct()


def find_occurrences(docs: DataFrame, benchmark: DataFrame, keep: list[str], window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """``keep`` columns of ``docs`` with ``wm_words`` (number of words), ``wm_spans`` (array of start, end, start, end ... of merged hit word spans) and
    ``wm_items`` (array of item ids, unordered) of whole texts.

    Null or wordless text: no words, no hits.  Empty benchmark: no hits.  Repeated documents are each answered; repeated
    items count under each of their ids.  Texts are taken whole.  Columns of ``docs`` named like a result are replaced.
    """
    with scratch(docs.sparkSession) as retain:
        patterns = materialise(patterns_of(benchmark, window), "patterns")
        item_type = patterns.schema["item"].dataType
        n_chunks = max(1, -(-patterns.count() // chunk))
        if n_chunks > 1:
            patterns = patterns.withColumn("chunk", F.pmod(F.xxhash64("words", "item"), F.lit(n_chunks)))
        made = ["wm_words", "wm_spans", "wm_items"]
        keep = [c for c in keep if c.lower() not in made]
        out, found, mark, written, shared = docs, [], "wm", None, []
        while any(c.lower().startswith(mark + "_") for c in docs.columns):
            mark = "_" + mark
        for k in range(n_chunks):
            rows = (patterns if n_chunks == 1 else patterns.where(F.col("chunk") == k)).select("words", "item").collect()
            shared.append(docs.sparkSession.sparkContext.broadcast([(bytes(r.words).split(b" "), r.item) for r in rows]))
            out = _searched(out, f"{mark}_{{}}_{k}", shared[-1], item_type, list(dict.fromkeys([*keep, *found, *([] if k == n_chunks - 1 else ["text"])])))
            found += [f"{mark}_{x}_{k}" for x in _MADE]
            if k % TOGETHER == TOGETHER - 1 and k < n_chunks - 1:
                # one result stands for those so far; the table and the windows behind it are needed no more
                out = out.select(*(column(out, c) for c in dict.fromkeys([*keep, "text"])), *(x.alias(n) for x, n in zip(_united(found), found[-3:])))
                out, found = materialise(out, "searched"), found[-3:]
                if written is not None:
                    discard(written)
                written = out
                while shared:
                    shared.pop().destroy()
        if written is not None:
            retain(written)
    return out.select(*(column(out, c) for c in keep), *(x.alias(n) for x, n in zip(_united(found), made)))


_MADE = ("words", "spans", "items")


def _searched(docs: DataFrame, name: str, shared, item_type: T.DataType, carried: list[str]) -> DataFrame:
    """``carried`` columns of ``docs``, and words, spans and items of one broadcast chunk in columns of ``name``."""
    fields = [T.StructField(name.format(x), t) for x, t in zip(_MADE, (T.LongType(), T.ArrayType(T.IntegerType()), T.ArrayType(item_type)))]

    def make():
        searcher = Searcher(shared.value)

        def run(texts):
            n, spans, items = searcher.search(texts)
            return [n, pa.array([x.ravel() for x in spans], type=pa.list_(pa.int32())), items]

        return run

    return map_texts(docs, make, fields, carried)


def _united(found: list[str]) -> tuple:
    """Words, spans and items of columns named in threes."""
    words, spans, items = (found[i::3] for i in range(3))
    if len(words) == 1:
        return F.col(words[0]), F.col(spans[0]), F.col(items[0])
    return F.col(words[0]), _merge_spans(*map(F.col, spans)), F.array_distinct(F.flatten(F.array(*map(F.col, items))))


def _merge_spans(*columns):
    """Union of several arrays of span ends, for benchmarks of more than one chunk."""

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def merge(*rows):
        import pandas as pd

        out = []
        for row in zip(*rows):
            ends = np.concatenate([np.asarray(x, np.int32).reshape(-1, 2) for x in row])
            ends = ends[np.argsort(ends[:, 0], kind="stable")]
            reach = np.maximum.accumulate(ends[:, 1])
            # a span begins where its start lies beyond all ends before
            first = np.flatnonzero(np.concatenate(([True], ends[1:, 0] > reach[:-1]))[: len(ends)])
            last = np.concatenate((first[1:], [len(ends)]))[: len(first)] - 1
            out.append(np.stack((ends[first, 0], reach[last]), axis=1).ravel())
        return pd.Series(out)

    return merge(*columns)


def span_words(spans):
    """Number of words in merged spans start, end, start, end ...: the differences that alternate signs leave."""
    return F.aggregate(spans, F.lit(0), lambda total, x: x - total).cast("long")


def digest(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated; see ``find_occurrences`` for odd rows."""
    found = find_occurrences(docs, benchmark, ["doc_id"], window, chunk)
    text = F.array_join(F.array_sort(F.transform("wm_items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id",
        F.col("wm_words").alias("n_words"),
        span_words("wm_spans").alias("n_hit"),
        F.size("wm_items").cast("long").alias("n_items"),
        F.sha2(text, 256).alias("items_sha256"),
    ).withColumn("contaminated", F.col("n_hit") > 0)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents in which a benchmark window occurs; columns and other rows as they were."""
    found = find_occurrences(docs, benchmark, without(docs, ["wm_words", "wm_spans", "wm_items"]))
    return found.where(F.size("wm_items") == 0).select(*(column(found, c) for c in without(docs, ["wm_words", "wm_spans", "wm_items"])))


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'),[]) w FROM documents),
b AS (SELECT item_id, coalesce(regexp_extract_all(translate(text,'ABCDEFGHIJKLMNOPQRSTUVWXYZ','abcdefghijklmnopqrstuvwxyz'),'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'),[]) w FROM benchmark),
bp AS (SELECT item_id, w, unnest(range(1, greatest(len(w)-9,1)+1)) s FROM b WHERE len(w)>0),
bw AS (SELECT DISTINCT item_id, least(len(w),10) l, array_to_string(w[s:s+9],' ') x FROM bp),
ls AS (SELECT DISTINCT l FROM bw),
dp AS (SELECT doc_id, l, w, unnest(range(1, len(w)-l+2)) s FROM d, ls WHERE len(w)>=l),
dw AS (SELECT doc_id, l, s, array_to_string(w[s:s+l-1],' ') x FROM dp),
h AS (SELECT dw.doc_id, dw.s, dw.l, bw.item_id FROM dw JOIN bw USING (l, x)),
n AS (SELECT doc_id, count(DISTINCT p) n_hit FROM (SELECT doc_id, unnest(range(s, s+l)) p FROM h) GROUP BY 1),
i AS (SELECT doc_id, count(*) n_items, string_agg(k, ',' ORDER BY k) ks FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) k FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) n_words, CAST(coalesce(n_hit,0) AS BIGINT) n_hit, CAST(coalesce(n_items,0) AS BIGINT) n_items, sha256(coalesce(ks,'')) items_sha256, coalesce(n_hit,0)>0 contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN i USING (doc_id)
"""
