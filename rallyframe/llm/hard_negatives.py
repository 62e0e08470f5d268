"""Hard negatives for contrastive training, mined with a vector-approximation file.

For each anchor and each of its nearest rows of the same label: the nearest rows of other labels whose score lies in a window
relative to the positive's.  Scores are inner products of whole numbers, floor(``SCALE`` * component).

1. Rows are dealt to blocks.  A block is one record of the file: for each dimension its values are cut into ``CELLS`` cells of
   about equally many rows, each row keeps one byte a dimension, and a table keeps the lowest and highest value of each cell.
2. Anchors are dealt to blocks too; each block of anchors meets each block of the file.  Looking the cells up in the table gives
   bounds of all scores by two matrix products.  Rows whose upper bound is below the k-th lower bound of their block, or that
   cannot be in any window, go; vectors are not read for that.
3. The vectors of the rows that are left are fetched by a join, scored exactly, and ranked.

Only the first rows of an exact vector and label can be in a result, as their scores tie and smaller ids come first; the others
are left out of the file before it is written, so a vector that a third of all rows have adds a few rows.  All anchors meet all
blocks: that work grows with anchors times rows, which is what a search of a share of all rows against all rows is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, materialise, runs, tidy

SCALE, POSITIVES, NEGATIVES = 256, 5, 10
#: A negative's score is between these hundredths of the positive's.
LOW, HIGH = 30, 90
#: Rows of a block of the file, anchors of a block, and cells of a dimension.
ROWS, ANCHORS, CELLS = 4096, 512, 64


def whole(vector: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of each component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _usable(vector: Column) -> Column:
    """No null, NaN or infinite component, and none too large for exact sums."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < 1e6, F.lit(False)))


def _file(batches):
    """One record for each (dims, block) of sorted rows (dims, block, row, label, v)."""
    for rows in runs(batches, 2):
        rows = rows.combine_chunks()
        values = np.stack(rows["v"].to_pylist()).astype(np.int64) if rows["dims"][0].as_py() else np.zeros((len(rows), 0), np.int64)
        codes = np.zeros(values.shape, np.uint8)
        low, high = (np.zeros((values.shape[1], CELLS), np.int64) for _ in range(2))
        steps = np.linspace(0, len(rows) - 1, CELLS + 1)[1:-1].astype(int)
        for d in range(values.shape[1]):
            x = values[:, d]
            code = np.searchsorted(np.sort(x)[steps], x, side="right")
            codes[:, d] = code
            low[d], high[d] = np.iinfo(np.int64).max, np.iinfo(np.int64).min
            np.minimum.at(low[d], code, x)
            np.maximum.at(high[d], code, x)
        parts = [rows["row"].to_numpy().tobytes(), rows["label"].to_numpy().tobytes(), codes.tobytes(), low.tobytes(), high.tobytes()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([rows["dims"][0].as_py()], type=pa.int32()), pa.array([rows["block"][0].as_py()], type=pa.int32()), *(pa.array([x], type=pa.binary()) for x in parts)],
            names=["dims", "block", "rows", "labels", "codes", "low", "high"],
        )


_FILE = "dims int, block int, rows binary, labels binary, codes binary, low binary, high binary"


def _bounds(record: dict, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Twice the lowest and highest possible score of each vector with each row of the record, and what rounding may add."""
    dims = record["dims"]
    codes = np.frombuffer(record["codes"], np.uint8).reshape(len(record["rows"]) // 8, dims)
    low, high = (np.frombuffer(record[x], np.int64).reshape(dims, CELLS) for x in ("low", "high"))
    there = low <= high
    middle, width = np.where(there, low + high, 0).astype(float), np.where(there, high - low, 0).astype(float)
    at = np.arange(dims)
    centre = vectors @ middle[at, codes].T
    spread = np.abs(vectors) @ width[at, codes].T
    spread += 1e-12 * (np.abs(vectors) @ (np.abs(middle) + width)[at, codes].T)
    return centre - spread, centre + spread


def _kth(low: np.ndarray, of: np.ndarray, k: int) -> float:
    """The k-th largest of ``low`` where ``of``; without k of them all may be among the first k."""
    found = low[of]
    return np.partition(found, len(found) - k)[len(found) - k] if len(found) >= k else -np.inf


def _same_label(record: dict, anchors: dict, low: np.ndarray, high: np.ndarray, i: int, rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    of = (labels == anchors["label"][i]) & (rows != anchors["row"][i])
    return of & (high[i] >= _kth(low[i], of, POSITIVES))


def _in_windows(record: dict, anchors: dict, low: np.ndarray, high: np.ndarray, i: int, rows: np.ndarray, labels: np.ndarray) -> np.ndarray:
    other = labels != anchors["label"][i]
    found = np.zeros(len(rows), bool)
    for score in set(anchors["scores"][i]):
        bottom, top = 2 * LOW * score / 100, 2 * HIGH * score / 100
        sure = other & (low[i] >= bottom + 1e-6) & (high[i] <= top - 1e-6)
        found |= other & (low[i] <= top + 1e-6) & (high[i] >= max(bottom - 1e-6, _kth(low[i], sure, NEGATIVES)))
    return found


def _search(choose):
    """(anchor, row) of rows that ``choose`` keeps, from (dims, block, anchor block) groups: one record of the file, then anchors."""

    def run(batches):
        for group in runs(batches, 3):
            group = group.combine_chunks()
            is_file = group["codes"].is_valid().to_numpy()
            record = group.filter(pa.array(is_file)).to_pylist()
            anchors = group.filter(pa.array(~is_file)).to_pydict()
            if not record or not anchors["row"]:
                continue
            record = record[0]
            rows, labels = np.frombuffer(record["rows"], np.int64), np.frombuffer(record["labels"], np.int64)
            low, high = _bounds(record, np.array(anchors["v"], float).reshape(len(anchors["row"]), record["dims"]))
            for i, anchor in enumerate(anchors["row"]):
                got = rows[choose(record, anchors, low, high, i, rows, labels)]
                if len(got):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(got), anchor)), pa.array(got)], names=["anchor", "row"])

    return run


def _candidates(file: DataFrame, anchors: DataFrame, choose) -> DataFrame:
    """(anchor, row): what ``choose`` keeps of all anchors (row, label, dims, v, scores) and all records of the file."""
    blocks = materialise(anchors.groupBy("dims").agg(F.ceil(F.count("*") / ANCHORS).cast("int").alias("groups")), "groups")
    counts = file.groupBy("dims").agg(F.count("*").cast("int").alias("blocks"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    pages = file.join(blocks, "dims").select("dims", "block", each("groups").alias("group"), "rows", "labels", "codes", "low", "high")
    asked = anchors.join(blocks, "dims").join(counts, "dims")
    asked = asked.select("dims", each("blocks").alias("block"), F.pmod(F.xxhash64("row"), "groups").cast("int").alias("group"), "row", "label", "v", "scores")
    order = ["dims", "block", "group"]
    parts = int(file.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = pages.unionByName(asked, allowMissingColumns=True).repartition(parts, *order).sortWithinPartitions(*order)
    return materialise(both.mapInArrow(tidy(_search(choose)), "anchor long, row long"), "candidates")


def _score(batches):
    for batch in batches:
        if len(batch):
            a, b = (batch.column(i) for i in (4, 5))
            ends = np.cumsum([len(x) for x in a])[:-1]
            product = a.flatten().to_numpy() * b.flatten().to_numpy()
            score = [int(x.sum()) for x in np.split(product, ends)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(score, type=pa.int64())], names=["anchor", "anchor_id", "row", "vec_id", "score"])


def _scored(found: DataFrame, rows: DataFrame, anchors: DataFrame) -> DataFrame:
    """(anchor, anchor_id, row, vec_id, score) of candidates, from the vectors."""
    left = anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), F.col("v").alias("a"))
    both = found.join(left, "anchor").join(rows.select("row", "vec_id", "v"), "row").select("anchor", "anchor_id", "row", "vec_id", "a", "v")
    return both.mapInArrow(_score, "anchor long, anchor_id long, row long, vec_id long, score long")


def mine(vectors: DataFrame, every: int = 100, shifted: int = 7, labels: int = 10) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score, for anchors whose vec_id ``every`` divides.

    Rows with a null label, id or vector, or with a null, NaN, infinite or huge (a million and more) component take no part.  Where
    ``shifted`` divides vec_id, the label first becomes the next one modulo ``labels``.  Ties are broken by smaller vec_id, then
    arbitrarily among rows that repeat a vec_id; such rows are each a row, and each an anchor.  Vectors of other lengths do
    not meet.  An anchor without positives, or a positive without negatives in its window, has no rows; fewer than asked for
    are given as they are.  Empty table: empty result.  Other columns are not looked at.
    """
    identity, label = column(vectors, "vec_id").cast("long"), column(vectors, "label").cast("long")
    vector = column(vectors, "embedding")
    label = F.when(identity % shifted == 0, F.pmod(label + 1, F.lit(labels))).otherwise(label)
    own = vectors.where(_usable(vector) & identity.isNotNull() & label.isNotNull())
    own = own.select(identity.alias("vec_id"), label.alias("label"), F.size(vector).alias("dims"), whole(vector).alias("v"))
    rows = materialise(own.withColumn("row", F.monotonically_increasing_id()), "rows")
    anchors = rows.where(F.col("vec_id") % every == 0).withColumn("scores", F.lit(None).cast("array<long>"))
    # one more than can be asked for, as the anchor may be among them
    same = Window.partitionBy("label", "v").orderBy("vec_id", "row")
    first = rows.withColumn("place", F.row_number().over(same)).where(F.col("place") <= max(POSITIVES, NEGATIVES) + 1)
    first = materialise(first.select("row", "label", "dims", "v", "vec_id"), "first")
    sizes = first.groupBy("dims").agg(F.ceil(F.count("*") / ROWS).cast("int").alias("blocks"))
    dealt = first.join(sizes, "dims").select("dims", F.pmod(F.xxhash64("row"), "blocks").cast("int").alias("block"), "row", "label", "v")
    parts = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    file = materialise(dealt.repartition(parts, "dims", "block").sortWithinPartitions("dims", "block").mapInArrow(tidy(_file), _FILE), "file")

    best = lambda *key: Window.partitionBy(*key).orderBy(F.desc("score"), "vec_id", "row")
    near = _scored(_candidates(file, anchors, _same_label), first, anchors).withColumn("place", F.row_number().over(best("anchor")))
    near = near.where(F.col("place") <= POSITIVES).select("anchor", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    near = materialise(near, "positives")
    scores = near.groupBy(F.col("anchor").alias("row")).agg(F.collect_list("positive_score").alias("scores"))
    windows = materialise(anchors.drop("scores").join(scores, "row"), "windows")
    far = _scored(_candidates(file, windows, _in_windows), first, anchors).join(near, "anchor")
    share, whole_ = 100 * F.col("score"), F.col("positive_score")
    far = far.where((LOW * whole_ <= share) & (share <= HIGH * whole_)).withColumn("rank", F.row_number().over(best("anchor", "place")))
    return far.where(F.col("rank") <= NEGATIVES).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END l, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id anchor_id, b.vec_id, a.l = b.l same, CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) s
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
q AS (SELECT anchor_id, vec_id positive_id, s positive_score FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) AS INTEGER) "rank", vec_id negative_id, positive_score, s negative_score
FROM q JOIN p USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id) <= 10
"""
