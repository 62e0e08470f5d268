"""Shared parts: scratch tables in the cluster's checkpoint folder, Arrow maps over whole texts, bounded bit filters."""

from __future__ import annotations

import pickle
import threading
import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Bytes of text that one call of a batch function gets, unless a single text is longer.
SLICE_BYTES = 8 << 20


_OPEN = threading.local()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, one in the warehouse.  All executors share both."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_rallyframe_scratch"
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back: the lineage is cut, and lost executors lose no rows."""
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    # the shuffle files behind a written table serve nothing else
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(cleanup) if before is None else spark.conf.set(cleanup, before)
    made = spark.read.schema(df.schema).parquet(path)
    made._scratch = path
    if levels := getattr(_OPEN, "levels", None):
        levels[-1][path] = made
    return made


@contextmanager
def scratch(spark: SparkSession):
    """Tables that ``materialise`` writes inside are deleted at the end, but for those given to the function that this yields.

    A table that is kept belongs to the scope around this one, if there is one; without any scope tables stay.  Nothing that
    is computed later may read a deleted table.
    """
    levels = _OPEN.levels = getattr(_OPEN, "levels", [])
    made: dict[str, DataFrame] = {}
    kept: list[DataFrame] = []
    levels.append(made)

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        levels.pop()
        for path, df in made.items():
            if not any(df is k for k in kept):
                _delete(spark, path)
            elif levels:
                levels[-1][path] = df


def discard(df: DataFrame) -> None:
    """Deletes the table behind ``df`` if ``materialise`` wrote it; nothing that is computed later may read it."""
    if path := getattr(df, "_scratch", None):
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark._jsc.hadoopConfiguration()).delete(there, True)


def without(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` whose names do not clash with ``names``; letter case does not tell names apart."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def share(spark: SparkSession, value) -> Callable:
    """Broadcasts ``value`` with its classes, so that executors need no copy of this package; the result gives it back there."""
    shared = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(shared.value)


def free(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it a name that no column of ``df`` has."""
    while name.lower() in {c.lower() for c in df.columns}:
        name = "_" + name
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(df: DataFrame, name: str):
    return df[quoted(name)]


def slices(texts: list, limit: int = SLICE_BYTES):
    """Start and end of runs of rows with about ``limit`` bytes of text."""
    start = total = 0
    for i, text in enumerate(texts):
        size = len(text) if text is not None else 0
        if total and total + size > limit:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(texts):
        yield start, len(texts)


def tidy(run: Callable) -> Callable:
    """A map over batches that gives unused memory back to the system at its end: Python workers live on and wait for other tasks."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError, TypeError):
                pass  # not the C library that has it

    return tidied


def map_texts(df: DataFrame, make: Callable, fields: list[T.StructField], keep: list[str], text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``df`` and ``fields``, which a function computes from whole texts.

    ``make()`` runs once a task and returns a function from a list of UTF-8 byte strings or None to a list of Arrow
    arrays, one for each of ``fields``.
    """
    kept = [df.schema[c] for c in keep]
    schema = T.StructType([*kept, *fields])
    types = [to_arrow_type(f.dataType) for f in fields]
    names = [f.name for f in schema.fields]

    def run(batches):
        work = make()
        for batch in batches:
            texts = batch.column(len(names) - len(types)).to_pylist()
            for a, b in slices(texts):
                out = work(texts[a:b])
                own = [batch.column(i).slice(a, b - a) for i in range(len(names) - len(types))]
                made = [x if isinstance(x, pa.Array) else pa.array(x, type=t) for x, t in zip(out, types)]
                yield pa.RecordBatch.from_arrays([*own, *made], names=names)

    columns = [column(df, c) for c in keep]
    return df.select(*columns, column(df, text).cast("binary").alias(free(df, "__text"))).mapInArrow(tidy(run), schema)


def runs(batches, key: int):
    """Runs of rows with equal values in the first ``key`` columns of sorted batches, each as one table."""
    held: list = []
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(key)]
        new = np.zeros(len(batch), bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        cut = np.concatenate(([0], np.flatnonzero(new), [len(batch)]))
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            if held and any(held[-1].column(i)[0] != batch.column(i)[a] for i in range(key)):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def bit_filter(hashes: DataFrame, name: str, bits: int = 26) -> bytes:
    """A bit set of 2**bits slots with the low bits of the longs in ``name``; its size is fixed, 2**bits / 8 bytes.

    Use it to leave out rows that cannot be in ``hashes``; rows let through by chance must be sorted out later.
    """
    slot = F.col(name).bitwiseAND(F.lit((1 << bits) - 1))
    words = (
        hashes.groupBy(F.shiftright(slot, 6).cast("int").alias("i"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, cast({name} & 63 as int))")).alias("w"))
        .toArrow()
    )
    out = np.zeros(1 << max(0, bits - 6), dtype=np.uint64)
    if len(words):
        out[words["i"].to_numpy()] = words["w"].to_numpy().view(np.uint64)
    return out.tobytes()


def passes(filter_bits: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    """For uint64 ``hashes``, whether their slot is set; ``filter_bits`` is the uint64 view of the bit set."""
    slot = hashes & np.uint64((1 << bits) - 1)
    return (filter_bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
