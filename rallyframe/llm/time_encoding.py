"""Time-ordered target encoding by a dyadic tree over time.

How often lines with the same item, vendor or client were returned before, counted over lines of other folds and strictly
earlier sales only, so that a model which trains on the rates never sees its own target or the future.

1. Time is cut into halves again and again.  A key with many events has a leaf of the tree for about every ``LEAF`` of them;
   a leaf holds at most ``FOLDS << TICKS`` of them, as events of a key, fold and instant are summed up before.
2. History is summed up for each key, fold and node.  The time before a leaf is the union of the left siblings on its way to the
   root, at most one a level: each leaf is exploded into these nodes and joined with their sums.
3. Those sums enter the leaf as rows before its first instant.  Running sums over the sorted leaf add what is earlier inside it.
   All folds less the own one give the counts.

Work is in proportion to events, and to leaves times levels.  A key with a third of all rows has many leaves, which are dealt
to tasks one by one, so no task or broadcast gets more than a leaf or what Spark's own size check lets pass.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, materialise, scratch

FOLDS = 5
#: A rate is a share in millionths; the prior counts as much as ``WEIGHT`` lines.
MILLION, WEIGHT, PRIOR = 1_000_000, 50, 500_000
#: Events of a key for which one leaf is enough, and bits of ticks that a leaf of a key with very many has at most.
LEAF, TICKS = 1024, 12
#: Stands for a null vendor.
NO_VENDOR = -(1 << 63)

_EPOCH = "1970-01-01"


def micros(time: Column) -> Column:
    """Microseconds since 1970 of a timestamp with or without a zone, by its parts."""
    seconds = F.datediff(F.to_date(time), F.lit(_EPOCH)).cast("long") * 86400 + F.hour(time) * 3600 + F.minute(time) * 60
    return seconds * 1_000_000 + (F.expr("1000000L") * F.date_part(F.lit("SECOND"), time)).cast("long")


def fold_of(identity: Column, folds: int = FOLDS) -> Column:
    """The fold of an id: CRC-32 of its decimal digits."""
    return F.pmod(F.crc32(identity.cast("long").cast("string").cast("binary")), F.lit(folds)).cast("int")


def rate(n: Column, s: Column, prior: Column) -> Column:
    """Smoothed share of ``s`` in ``n`` in millionths, rounded down; the prior where nothing is known."""
    return F.when(n < 1, prior).otherwise(F.call_function("div", MILLION * s + WEIGHT * prior, n + WEIGHT))


def _changes(column: pa.Array) -> np.ndarray:
    """Whether a value differs from the one before; the first one does."""
    changed = pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))
    return np.concatenate(([True], np.asarray(changed.to_numpy(zero_copy_only=False), bool)))


def _earlier(folds: int):
    """past_n and past_s within leaves: of rows (key, leaf, t, fold, n, s, own, others) sorted by the first three."""

    def sums(rows: pa.RecordBatch) -> pa.RecordBatch:
        leaf = _changes(rows.column(0)) | _changes(rows.column(1))
        instant = leaf | _changes(rows.column(2))
        at = np.arange(len(rows))
        leaf_start = np.maximum.accumulate(np.where(leaf, at, 0))
        start = np.maximum.accumulate(np.where(instant, at, 0))
        fold = rows.column(3).to_numpy()
        out = []
        for name in (4, 5):
            value = rows.column(name).to_numpy()
            # sums of all before each row: of every fold, and last of all folds
            before = np.zeros((folds + 1, len(rows) + 1), np.int64)
            for k in range(folds):
                np.cumsum(np.where(fold == k, value, 0), out=before[k, 1:])
            np.cumsum(value, out=before[folds, 1:])
            within = lambda k: before[k, start] - before[k, leaf_start]  # noqa: E731, B023
            out.append(pa.array(within(folds) - within(fold)))
        names = [*rows.schema.names[:1], "t", "fold", *rows.schema.names[7:], "past_n", "past_s"]
        made = [rows.column(0), rows.column(2), rows.column(3), *rows.columns[7:], *out]
        return pa.RecordBatch.from_arrays(made, names=names).filter(rows.column(6))

    def run(batches):
        held = None
        for batch in batches:
            if not len(batch):
                continue
            rows = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            # the last leaf may go on in the next batch
            cut = int(np.flatnonzero(_changes(rows.column(0)) | _changes(rows.column(1)))[-1])
            held = rows.slice(cut)
            if cut:
                yield sums(rows.slice(0, cut))
        if held is not None:
            yield sums(held)

    return run


def past(events: DataFrame, key: str, bits: int, folds: int = FOLDS) -> DataFrame:
    """``events`` (``key``, t, fold, n, s and others; unique by the first three) with past_n and past_s instead of n and s.

    ``t`` is a whole number of at most ``bits`` bits; keys are not null.  past_n and past_s are the sums of n and s over events of
    the same key, of other folds and with a smaller t; 0 where there are none.  An empty table gives an empty one.
    """
    count = F.col("count")
    # a key of c events is cut log2(c / LEAF) times
    low = bits - F.ceil(F.log2(count / LEAF)).cast("int")
    low = F.greatest(F.lit(0), F.when(count > folds << TICKS, F.least(low, F.lit(TICKS))).otherwise(low))
    deep = materialise(events.groupBy(key).count().where(count > LEAF).select(key, low.alias("low")), "deep")
    leaf = F.expr("shiftright(t, low)").alias("leaf")
    cut = events.join(deep, key).select(key, leaf, "low", "fold", "n", "s")
    leaves = materialise(cut.groupBy(key, "leaf", "low", "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "leaves")
    # left siblings are the only nodes that are asked for
    climb = F.explode(F.sequence(F.lit(0), bits - F.col("low") - 1)).alias("up")
    nodes = leaves.select(key, "leaf", "fold", "n", "s", climb).where("shiftright(leaf, up) % 2 = 0")
    nodes = nodes.groupBy(key, "up", F.expr("shiftright(leaf, up)").alias("node"), "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    asked = leaves.select(key, "leaf", "low").distinct().select(key, "leaf", climb).where("shiftright(leaf, up) % 2 = 1")
    asked = asked.withColumn("node", F.expr("shiftright(leaf, up) - 1"))
    before = asked.join(nodes, [key, "up", "node"]).groupBy(key, "leaf", "fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    others = [c for c in events.columns if c not in (key, "t", "fold", "n", "s")]
    own = events.join(deep, key, "left").withColumn("low", F.coalesce("low", F.lit(bits)))
    own = own.select(key, leaf, "t", "fold", "n", "s", F.lit(True).alias("own"), *others)
    before = before.select(key, "leaf", F.lit(-1).cast("long").alias("t"), "fold", "n", "s", F.lit(False).alias("own"))
    rows = own.unionByName(before, allowMissingColumns=True)
    fields = [*(events.schema[c] for c in (key, "t", "fold", *others)), *(T.StructField(c, T.LongType()) for c in ("past_n", "past_s"))]
    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, key, "leaf").sortWithinPartitions(key, "leaf", "t").mapInArrow(_earlier(folds), T.StructType(fields))


def _known(table: DataFrame, identity: str, value: str) -> DataFrame:
    """One row for each id; the smallest value where an id is repeated."""
    return table.where(F.col(identity).isNotNull()).groupBy(F.col(identity).cast("long").alias(identity)).agg(F.min(value).alias(value))


def encode(lines: DataFrame, sales: DataFrame, items: DataFrame, vendors: DataFrame, clients: DataFrame, flag: str = "returned") -> DataFrame:
    """Per sale, item and vendor: its lines, those with ``flag``, and count and rate of the history of item, vendor and client.

    Lines without a sale or time are left out.  Null items and clients are the id -1; a null vendor is the vendor -2^63, and null in the
    result.  Null
    flags are not ``flag``.  Null and unknown kinds, nations and segments are one value each; of a repeated id the smallest
    value counts.  Lines may repeat.  A repeated sale_id is several sales of one fold, with a row for each.  Equal times are not
    history of each other.  Empty tables give an empty result; other columns are not looked at.  Tables that the result reads stay,
    unless the caller opens a ``scratch`` scope.
    """
    sums = [F.sum("n").alias("n"), F.sum("s").alias("s")]
    mine = lines.select(
        F.col("sale_id").cast("long").alias("sale_id"),
        F.coalesce(F.col("item_id").cast("long"), F.lit(-1).cast("long")).alias("item_id"),
        F.coalesce(F.col("vendor_id").cast("long"), F.lit(NO_VENDOR)).alias("vendor_id"),
        F.coalesce(F.col("flag") == flag, F.lit(False)).cast("long").alias("s"),
    ).where("sale_id is not null")
    mine = mine.groupBy("sale_id", "item_id", "vendor_id").agg(F.count("*").alias("n"), F.sum("s").alias("s"))
    sold = sales.where("sold_at is not null and sale_id is not null").select(
        F.col("sale_id").cast("long").alias("sale_id"),
        F.coalesce(F.col("client_id").cast("long"), F.lit(-1).cast("long")).alias("client_id"),
        micros(F.col("sold_at")).alias("t"),
        fold_of(F.col("sale_id")).alias("fold"),
    )
    base = materialise(mine.join(sold, "sale_id"), "lines")
    first, last, second, milli = base.agg(F.min("t"), F.max("t"), F.max(F.expr("t % 1000000 <> 0")), F.max(F.expr("t % 1000 <> 0"))).first()
    tick = 1 if milli else 1000 if second else 1_000_000
    bits = max(1, (((last or 0) - (first or 0)) // tick).bit_length())
    base = base.withColumn("t", F.expr(f"(t - {first or 0}L) div {tick}L"))
    spark = lines.sparkSession

    def of(identity: str, known: DataFrame, value: str) -> DataFrame:
        events = base.groupBy(identity, "t", "fold").agg(*sums)
        with scratch(spark) as keep:
            # a table of its own, so that Spark can split the events of a hot id in the join
            known = materialise(_known(known, identity, value), "known")
            shared = F.coalesce(F.concat(F.lit("="), F.col(value).cast("string")), F.lit("")).alias(value)
            return keep(materialise(events.join(known, identity, "left").select(identity, "t", "fold", "n", "s", shared), identity))

    def everyone(events: DataFrame) -> DataFrame:
        with scratch(spark) as keep:
            everything = materialise(events.groupBy(F.lit(0).alias("one"), "t", "fold").agg(*sums), "everything")
            rates = past(everything, "one", bits)
            return keep(materialise(rates.select("t", "fold", rate(F.col("past_n"), F.col("past_s"), F.lit(PRIOR).cast("long")).alias("prior")), "overall"))

    # each step is written, so that no plan holds more than one of them, and what a step wrote for itself goes with it
    def encoded(events: DataFrame, overall: DataFrame, identity: str, value: str, name: str) -> DataFrame:
        with scratch(spark) as keep:
            groups = materialise(events.groupBy(value, "t", "fold").agg(*sums), value)
            groups = past(groups, value, bits).join(overall, ["t", "fold"])
            groups = materialise(groups.select(value, "t", "fold", rate(F.col("past_n"), F.col("past_s"), F.col("prior")).alias("prior")), "prior")
            each = past(events, identity, bits).join(groups, ["t", "fold", value])
            each = each.select(identity, "t", "fold", F.col("past_n").alias(f"{name}_n"), rate(F.col("past_n"), F.col("past_s"), F.col("prior")).alias(f"{name}_rate"))
            return keep(materialise(each, name))

    found = base
    with scratch(spark) as keep:
        overall = None
        for known, identity, value in ((clients, "client_id", "segment"), (items, "item_id", "kind"), (vendors, "vendor_id", "nation_id")):
            events = of(identity, known, value)
            overall = everyone(events) if overall is None else overall
            found = found.join(keep(encoded(events, overall, identity, value, identity.removesuffix("_id"))), ["t", "fold", identity])
            discard(events)
    names = [f"{x}_{y}" for x in ("item", "vendor", "client") for y in ("n", "rate")]
    vendor = F.nullif(F.col("vendor_id"), F.lit(NO_VENDOR)).alias("vendor_id")
    return found.select("sale_id", "item_id", vendor, F.col("n").alias("n_lines"), F.col("s").alias("n_returned"), *names)


def _history(key: str) -> str:
    over = lambda keys: f"OVER (PARTITION BY {keys} ORDER BY sold_at RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING)"
    own = f"{key}, fold" if key else "fold"
    name = key or "everything"
    return ", ".join(f"coalesce(sum({x}) {over(key or '1')}, 0) - coalesce(sum({x}) {over(own)}, 0) AS {name}_{y}" for x, y in (("1", "n"), ("r", "s")))


def _rate(key: str, prior: str) -> str:
    return f"CASE WHEN {key}_n < 1 THEN {prior} ELSE (1000000 * {key}_s + 50 * {prior}) // ({key}_n + 50) END"


_KEYS = ("", "kind", "nation_id", "segment", "item_id", "vendor_id", "client_id")

ORACLE = f"""
WITH s AS (SELECT sale_id, coalesce(client_id, -1) client_id, sold_at,
  xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(sale_id::VARCHAR, ''), lambda d: unicode(d)::BIGINT)),
    lambda c, d: list_reduce(list_prepend(xor(c, d), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 5 fold
  FROM sales WHERE sold_at IS NOT NULL),
l AS (SELECT sale_id, coalesce(item_id, -1) item_id, vendor_id, client_id, sold_at, fold, CAST(coalesce(flag = 'returned', false) AS BIGINT) r FROM sale_lines JOIN s USING (sale_id)),
k AS (SELECT l.*, kind, nation_id, segment FROM l LEFT JOIN (SELECT item_id, min(kind) kind FROM items GROUP BY 1) USING (item_id)
  LEFT JOIN (SELECT vendor_id, min(nation_id) nation_id FROM vendors GROUP BY 1) USING (vendor_id) LEFT JOIN (SELECT client_id, min(segment) segment FROM clients GROUP BY 1) USING (client_id)),
h AS (SELECT *, {", ".join(map(_history, _KEYS))} FROM k),
a AS (SELECT *, {_rate("everything", "500000")} p FROM h),
g AS (SELECT *, {_rate("kind", "p")} pi, {_rate("nation_id", "p")} pv, {_rate("segment", "p")} pc FROM a)
SELECT sale_id, item_id, vendor_id, count(*) n_lines, CAST(sum(r) AS BIGINT) n_returned,
  CAST(any_value(item_id_n) AS BIGINT) item_n, CAST(any_value({_rate("item_id", "pi")}) AS BIGINT) item_rate,
  CAST(any_value(vendor_id_n) AS BIGINT) vendor_n, CAST(any_value({_rate("vendor_id", "pv")}) AS BIGINT) vendor_rate,
  CAST(any_value(client_id_n) AS BIGINT) client_n, CAST(any_value({_rate("client_id", "pc")}) AS BIGINT) client_rate
FROM g GROUP BY sale_id, item_id, vendor_id, client_id, sold_at
"""
