"""Tables that are kept by key and changed by batches: immutable files, and a manifest for each version.

A change writes only its own rows, as a delta segment dealt to buckets by the hash of the key.  A version is a small JSON file that
names the segments of each bucket; it appears by one rename after all files are written.  So a reader stays on the version it
opened, a write that is killed leaves the version before, and one change may span several tables.  ``settle`` folds deltas into
new base files and splits buckets that have grown; it rewrites only those buckets, and takes the files of a bucket's first delta
as they are.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes a bucket has on average before buckets are split; deltas of a bucket, in bytes of its base and by number, before they
#: are folded in.
SPLIT_BYTES, SHARE, DELTAS = 256 << 20, 0.25, 8
#: The hash that deals keys to buckets, as manifests name it.
HASH = "murmur3"


class Conflict(Exception):
    """Another writer made the next version first."""


def bucket_of(key: Column, buckets: int) -> Column:
    """The bucket of a key; one bucket more splits one bucket in two and leaves the others as they are.

    The hash is the one that rows are shuffled by, so a task of rows that are dealt by the key has few buckets.
    """
    power = 1 << (buckets.bit_length() - 1)
    low = F.pmod(F.hash(key), F.lit(power))
    return F.when(low < buckets - power, F.pmod(F.hash(key), F.lit(2 * power))).otherwise(low).cast("int")


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: in ``spark.checkpoint.dir``, or in the warehouse where that is unset."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame, name: str) -> DataFrame:
    """``rows``, written into a new shared folder and read from there: computed once, and the same at each use."""
    path = scratch_folder(rows.sparkSession, name)
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def parent_of(bucket: int, buckets: int) -> int:
    """The bucket below ``buckets`` that rows of ``bucket`` came from."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


def _schema(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)


class Store:
    """Tables under ``path``; rows of a table belong to a key, and a change replaces all rows of each key it names."""

    def __init__(self, spark: SparkSession, path: str, key: str = "openid", buckets: int = 16, split_bytes: int = SPLIT_BYTES, share: float = SHARE, deltas: int = DELTAS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets
        self.split_bytes, self.share, self.deltas = split_bytes, share, deltas

    # ---- files

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.path, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Versions that are there, oldest first."""
        folder = self._path("versions")
        if not self._fs().exists(folder):
            return []
        names = (f.getPath().getName() for f in self._fs().listStatus(folder))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """Segments of a version, the latest by default."""
        if version is None:
            version = max(self.versions(), default=0)
        if not version:
            return {"version": 0, "hash": HASH, "tables": {}, "ledger": {}}
        stream = self._fs().open(self._path("versions", f"{version}.json"))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if found.get("hash") != HASH:
            raise ValueError(f"{self.path} was dealt to buckets by another hash; write it anew")
        return found

    def _publish(self, manifest: dict) -> None:
        """Makes ``manifest`` the version after the one it came from, or raises ``Conflict``."""
        made = self._path("versions", f".{uuid.uuid4().hex}")
        target = self._path("versions", f"{manifest['version']}.json")
        out = self._fs().create(made, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        jvm = self.spark._jvm
        none = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(made.toUri() if made.toUri().getScheme() else self._fs().getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(made, target, none)
        except Exception as error:
            if "FileAlreadyExists" not in str(error):
                raise
            self._fs().delete(made, False)
            raise Conflict(f"version {manifest['version']} of {self.path}") from error

    @contextmanager
    def _open_buckets(self, buckets: int):
        """A task writes its buckets side by side, in the order of its rows; else Spark sorts the rows by bucket first."""
        name = "spark.sql.maxConcurrentOutputFileWriters"
        before = self.spark.conf.get(name, None)
        self.spark.conf.set(name, str(buckets))
        try:
            yield
        finally:
            self.spark.conf.unset(name) if before is None else self.spark.conf.set(name, before)

    def _write(self, rows: DataFrame, segment: str, buckets: int, dealt: bool = False) -> dict[str, int]:
        """Writes rows as a segment; bytes of each bucket.  Large buckets are written by several tasks.

        Rows that are ``dealt``, by a shuffle by the key or as files of buckets, are written where they are.
        """
        rows = rows.withColumn("bucket", bucket_of(F.col(self.key), buckets))
        write = lambda x: x.write.partitionBy("bucket").option("compression", "zstd").parquet(f"{self.path}/{segment}")
        if dealt:
            with self._open_buckets(buckets):
                write(rows)
        else:
            parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            salt = F.pmod(F.xxhash64(F.col(self.key), F.lit(1)), F.lit(max(1, parts // buckets)))
            write(rows.repartition(parts, "bucket", salt).sortWithinPartitions("bucket", self.key))
        found = {}
        for f in self._fs().listStatus(self._path(segment)):
            if (name := f.getPath().getName()).startswith("bucket="):
                found[name[7:]] = self._fs().getContentSummary(f.getPath()).getLength()
        return found

    def _load(self, schema: str, segment: str, buckets: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*(f"{self.path}/{segment}/bucket={b}" for b in buckets))

    # ---- reading

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """All rows of a table as of a version; its files never change, so it may be read for as long as it is kept."""
        return self._read(self.manifest(version)["tables"][table], None)

    def lookup(self, table: str, value: str, version: int | None = None) -> DataFrame:
        """The rows of one key; only the files of its bucket are read."""
        state = self.manifest(version)["tables"][table]
        bucket = self.spark.range(1).select(bucket_of(F.lit(value), state["buckets"])).first()[0]
        return self._read(state, {str(bucket)}).where(F.col(self.key) == value)

    def _read(self, state: dict, only: set[str] | None) -> DataFrame:
        wanted = lambda buckets: [b for b in buckets if only is None or b in only]
        schema = state["schema"]
        of: dict[str, list[str]] = {}
        for b in (b for b in wanted(state["bases"]) if state["bases"][b]["bytes"]):
            of.setdefault(state["bases"][b]["segment"], []).append(b)
        union = lambda a, b: b if a is None else a.unionByName(b)
        base = None
        for segment, buckets in of.items():
            base = union(base, self._load(schema, segment, buckets))
        base = self.spark.createDataFrame([], schema) if base is None else base
        # a base has what was changed before it was made
        live = lambda d, part: [b for b in wanted(d[part]) if d["seq"] > state["bases"].get(b, {"seq": 0})["seq"]]
        deltas = [d for d in state["deltas"] if live(d, "keys")]
        if not deltas:
            return base
        keys = rows = last = None
        for d in deltas:
            seq = F.lit(d["seq"]).alias("__seq")
            keys = union(keys, self._load(self._key_schema(state), d["keys_segment"], live(d, "keys")).select(self.key, seq))
            if there := live(d, "buckets"):
                row = self._load(schema, d["segment"], there)
                if d is deltas[-1] and d.get("within"):
                    last = row  # nothing comes after it
                else:
                    rows = union(rows, row.select("*", seq))
        # of the size of the deltas: Spark broadcasts them where they are small
        newest = keys.groupBy(self.key).agg(F.max("__seq").alias("__seq")) if len(deltas) > 1 or rows is not None else keys
        kept = base.join(newest, self.key, "left_anti")
        if rows is not None:
            kept = kept.unionByName(rows.join(newest, [self.key, "__seq"], "left_semi").drop("__seq"))
        return kept if last is None else kept.unionByName(last)

    def _key_schema(self, state: dict) -> str:
        return f"`{self.key}` {state['key_type']}"

    # ---- writing

    def stage(self, table: str, rows: DataFrame, keys: DataFrame | None = None, dealt: bool = False) -> DataFrame:
        """Writes a change of one table without making it visible, for ``apply``; its rows, read from the files.

        ``dealt`` rows were shuffled by the key alone and are not shuffled again.
        """
        state = self.manifest()["tables"].get(table, {"buckets": self.buckets})
        delta = self._delta(table, rows, keys, state["buckets"], dealt)
        there = [b for b in delta["buckets"]]
        read = self._load(_schema(rows), delta["segment"], there) if there else self.spark.createDataFrame([], _schema(rows))
        read._staged = delta
        return read

    def apply(self, changes: dict[str, DataFrame], keys: DataFrame | None = None, batch: tuple[str, int] | None = None, derived: bool = False) -> int:
        """Replaces the rows of ``keys`` (by default, those that each table's rows have) in all tables by one version; its number.

        ``keys`` names keys that have no rows any more as well.  ``batch`` is a stream and the number of its batch: a batch that is
        in already changes nothing.  Null keys are left out.  A writer that comes second tries again on the version of the first.
        ``derived``: ``keys`` is a staged table and the rows of all others are made of its rows, each under the key of the row it is
        made of; then they are written bucket by bucket as they come, and the staged files tell the keys.
        """
        written: dict[str, dict] = {}
        while True:
            before = self.manifest()
            if batch and before["ledger"].get(batch[0], -1) >= batch[1]:
                return before["version"]
            after = json.loads(json.dumps(before)) | {"version": before["version"] + 1}
            for table, rows in changes.items():
                state = after["tables"].setdefault(table, {"schema": None, "buckets": self.buckets, "bases": {}, "deltas": []})
                state["schema"] = _schema(rows)
                state["key_type"] = rows.schema[self.key].dataType.simpleString()
                delta = written.get(table) or getattr(rows, "_staged", None)
                if not delta or delta["of"] != state["buckets"]:
                    delta = written[table] = self._delta(table, rows, keys, state["buckets"], derived, derived)
                state["deltas"].append({k: v for k, v in delta.items() if k != "of"} | {"seq": after["version"]})
            if batch:
                after["ledger"][batch[0]] = batch[1]
            try:
                self._publish(after)
                return after["version"]
            except Conflict:
                continue

    def _delta(self, table: str, rows: DataFrame, keys: DataFrame | None, buckets: int, dealt: bool = False, derived: bool = False) -> dict:
        segment = f"data/{table}/{uuid.uuid4().hex}"
        found = self._write(rows.where(F.col(self.key).isNotNull()), segment, buckets, dealt)
        # within: all rows are under keys of this change
        delta = {"segment": segment, "buckets": found, "of": buckets, "within": keys is None or derived}
        if keys is None:
            return delta | {"keys_segment": segment, "keys": found}
        staged = getattr(keys, "_staged", None)
        if staged and staged["of"] == buckets:
            return delta | {"keys_segment": staged["segment"], "keys": staged["buckets"]}
        only = keys.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        return delta | {"keys_segment": f"{segment}-keys", "keys": self._write(only, f"{segment}-keys", buckets)}

    def settle(self) -> int:
        """Folds deltas into base files where they have become many or large, and splits buckets; the version after that."""
        before = self.manifest()
        after = json.loads(json.dumps(before)) | {"version": before["version"] + 1}
        changed = False
        for table, state in after["tables"].items():
            changed |= self._settle(table, before["tables"][table], state, before["version"])
        if changed:
            self._publish(after)
        return after["version"] if changed else before["version"]

    def _settle(self, table: str, old: dict, state: dict, seq: int) -> bool:
        live = lambda d, b: d["seq"] > old["bases"].get(b, {"seq": 0})["seq"]
        total = sum(x["bytes"] for x in old["bases"].values()) + sum(n for d in old["deltas"] for b, n in d["buckets"].items() if live(d, b))
        state["buckets"] = max(old["buckets"], -(-total // self.split_bytes))
        split = {str(parent_of(b, old["buckets"])) for b in range(old["buckets"], state["buckets"])}
        touched, taken = set(split), {}
        for b in {b for d in old["deltas"] for b in d["keys"]}:
            mine = [d for d in old["deltas"] if b in d["keys"] and live(d, b)]
            size = sum(d["buckets"].get(b, 0) for d in mine)
            if len(mine) == 1 and mine[0].get("within") and b not in old["bases"] and b not in split:
                taken[b] = {"segment": mine[0]["segment"], "bytes": size, "seq": mine[0]["seq"]}
            elif mine and (b not in old["bases"] or len(mine) > self.deltas or size > self.share * old["bases"][b]["bytes"]):
                touched.add(b)
        if not touched and not taken:
            return False
        segment = f"data/{table}/{uuid.uuid4().hex}"
        found = self._write(self._read(old, touched), segment, state["buckets"]) if touched else {}
        state["bases"] |= taken
        for b in range(state["buckets"]):
            if str(parent_of(b, old["buckets"])) in touched:
                state["bases"][str(b)] = {"segment": segment, "bytes": found.get(str(b), 0), "seq": seq}
        state["bases"] = {b: x for b, x in state["bases"].items() if x["bytes"] or x["seq"]}
        gone = lambda d, b: d["seq"] <= state["bases"].get(b, {"seq": 0})["seq"]
        state["deltas"] = [d for d in old["deltas"] if not all(gone(d, b) for b in d["keys"])]
        return True

    def evict(self, keep: int = 2, pinned: tuple[int, ...] = ()) -> list[int]:
        """Deletes all versions but the last ``keep`` and ``pinned`` ones, and files that none of these names; the versions deleted.

        Nobody may be writing meanwhile: files of a change that is not published yet look like those of a killed one.
        """
        there = self.versions()
        stay = set(there[-keep:]) | set(pinned)
        used = set()
        for version in stay & set(there):
            for state in self.manifest(version)["tables"].values():
                used |= {x["segment"] for x in state["bases"].values()} | {d[k] for d in state["deltas"] for k in ("segment", "keys_segment")}
        gone = [v for v in there if v not in stay]
        for version in gone:
            self._fs().delete(self._path("versions", f"{version}.json"), False)
        data = self._path("data")
        for table in self._fs().listStatus(data) if self._fs().exists(data) else ():
            for f in self._fs().listStatus(table.getPath()):
                if f"data/{table.getPath().getName()}/{f.getPath().getName()}" not in used:
                    self._fs().delete(f.getPath(), True)
        return gone
