"""Packing by concatenate and cut.

Pass 1 tokenises every text once and writes the ids (two bytes each where the vocabulary allows) beside the running token
count inside their partition.  A prefix sum over the partitions' totals then gives each partition its global offset, and
pass 2 cuts each document at multiples of the sequence length.  Documents are placed in the order of the partitions of
pass 1, so no sequence but the last has padding.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, map_texts, materialise, tidy

LENGTH = 4096
END_ID = 2
#: Partitions up to which their offsets (16 bytes each) are broadcast; beyond, they are joined.
BROADCAST_PARTITIONS = 500_000
#: Partitions summed in one group of the prefix sum.
GROUP = 1024
#: Distinct pieces that a task remembers before it starts anew.
REMEMBERED = 300_000

#: For lower-cased texts of these characters alone the tokenizer's splitting is this pattern: elisions, runs of letters,
#: single digits, runs of others.  Any other text goes to the tokenizer whole.
_PLAIN = re.compile("[^\x00-\xff\u2010-\u2027\u2030-\u205e]")
_PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^ \t-\r\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")


class Encoder:
    """Token ids of texts; the pieces that the tokenizer splits a text into are encoded once, many together, and remembered.

    With ``added`` the tokenizer is used as given: its added tokens are found in texts.  Without, they are spelled out.
    """

    def __init__(self, path: str, dtype, added: bool = False):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer, self.of_pieces = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.of_pieces.encode_special_tokens = True  # no piece holds an added token whole
        if not added:
            self.tokenizer.encode_special_tokens = True
        # pieces are normal already, and parted by spaces
        self.of_pieces.normalizer = None
        self.of_pieces.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.dtype = dtype
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        #: A text that holds one of these goes to the tokenizer whole.
        self.added = [t["content"].lower() for t in described.get("added_tokens", [])] if added else []
        vocabulary = described["model"]["vocab"]
        suffix = described["model"].get("end_of_word_suffix")
        splits = json.dumps(described.get("pre_tokenizer"))
        #: The short way holds for this kind of tokenizer: its own splitting pattern, lower case, a mark at the end of a piece.
        self.known_kind = suffix == "</w>" and "'s|'t|'re|'ve|'m|'ll|'d|[\\\\p{L}]+|[\\\\p{N}]|[^\\\\s\\\\p{L}\\\\p{N}]+" in splits and "Lowercase" in json.dumps(described.get("normalizer"))
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.place = _Places()
        self.ids = np.zeros(0, self.dtype)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _learn(self) -> None:
        """Ids of the pieces that have a place but no ids yet."""
        pieces, self.place.new = self.place.new, []
        parts = [pieces[a : a + 200] for a in range(0, len(pieces), 200)]
        found, sizes = [], []
        for part, got in zip(parts, self.of_pieces.encode_batch_fast([" ".join(p) for p in parts], add_special_tokens=False)):
            ids = np.array(got.ids, dtype=self.dtype)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) != len(part):
                each = [self._whole(p) for p in part]
                ids, size = np.concatenate(each), np.array([len(x) for x in each])
            else:
                size = np.diff(ends, prepend=0)
            found.append(ids)
            sizes.append(size)
        if sizes:
            size = np.concatenate(sizes)
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(size) - size])
            self.ids, self.size = np.concatenate([self.ids, *found]), np.concatenate([self.size, size])

    def encode(self, texts: list[str], end: int | None) -> list[np.ndarray]:
        tail = np.array([] if end is None else [end], dtype=self.dtype)
        if len(self.place) > REMEMBERED:
            self.forget()
        placed: list = []
        get = self.place.__getitem__
        for text in texts:
            low = text.lower()
            if self.known_kind and not _PLAIN.search(text) and not any(t in low for t in self.added):
                pieces = _PIECES.findall(low)
                placed.append(np.fromiter(map(get, pieces), dtype=np.int64, count=len(pieces)))
            else:
                placed.append(None)
        self._learn()
        out = []
        for text, at in zip(texts, placed):
            if at is None:
                out.append(np.concatenate([self._whole(text), tail]))
                continue
            n = self.size[at]
            ends = np.cumsum(n)
            index = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.first[at] - (ends - n), n)
            out.append(np.concatenate([self.ids[index], tail]))
        return out


class _Places(dict):
    """Gives a piece that is asked for the first time the next place."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        at = self[piece] = len(self)
        self.new.append(piece)
        return at


def tokenise(docs: DataFrame, tokenizer: str, end: int = END_ID) -> DataFrame:
    """Table of doc_id, part, start_in_part, n and ids (little-endian bytes), written to the checkpoint folder.

    Null text is empty: only the end id.  Repeated rows are each kept.
    """
    import json

    with open(tokenizer, encoding="utf-8") as f:
        size = max(json.load(f)["model"]["vocab"].values()) + 1000
    dtype = "<u2" if max(size, end) < 1 << 16 else "<u4"
    fields = [T.StructField("part", T.IntegerType()), T.StructField("start_in_part", T.LongType()), T.StructField("n", T.LongType()), T.StructField("width", T.IntegerType()), T.StructField("ids", T.BinaryType())]

    def make():
        from pyspark import TaskContext

        encoder, part = Encoder(tokenizer, np.dtype(dtype), added=True), TaskContext.get().partitionId()
        so_far = 0

        def run(texts):
            nonlocal so_far
            ids = encoder.encode([t.decode("utf-8", "replace") if t else "" for t in texts], end)
            n = np.array([len(x) for x in ids], dtype=np.int64)
            start = so_far + np.cumsum(n) - n
            so_far += int(n.sum())
            return [np.full(len(n), part, np.int32), start, n, np.full(len(n), np.dtype(dtype).itemsize, np.int32), [x.tobytes() for x in ids]]

        return run

    return materialise(map_texts(docs.select(column(docs, "doc_id"), column(docs, "text")), make, fields, ["doc_id"]), "tokens")


def offsets(tokens: DataFrame) -> DataFrame:
    """For each part the number of tokens before it: sums inside groups of parts, then over the groups."""
    totals = tokens.groupBy("part").agg(F.sum("n").alias("total")).withColumn("group", F.expr(f"part div {GROUP}"))
    inside = Window.partitionBy("group").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    groups = totals.groupBy("group").agg(F.sum("total").alias("group_total"))
    over = Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)  # one row for each GROUP partitions
    groups = groups.select("group", F.coalesce(F.sum("group_total").over(over), F.lit(0)).alias("group_base"))
    return totals.withColumn("inside", F.coalesce(F.sum("total").over(inside), F.lit(0))).join(groups, "group").select("part", (F.col("inside") + F.col("group_base")).alias("base"))


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH, end: int = END_ID) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_to.

    ``padded_to`` is ``length``, but for a last sequence whose tokens number a power of two, which stays as it is.  Empty
    table: no pieces.  A text of any length is cut freely; each id lies in exactly one piece.  Null and empty texts have the end id
    alone; repeated rows are each packed; other columns may have any names.  The order of documents is that of the table's partitions.
    """
    tokens = tokenise(docs, tokenizer, end)
    bases = materialise(offsets(tokens), "offsets")
    if bases.count() <= BROADCAST_PARTITIONS:
        bases = F.broadcast(bases)
    last = tokens.agg(F.sum("n")).first()[0] or 0
    rest = last % length
    last_sequence, last_size = last // length, length if rest & (rest - 1) else rest
    doc_type = tokens.schema["doc_id"]
    schema = T.StructType([doc_type] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "padded_to")])

    def cut(batches):
        for batch in batches:
            n, width, at = (batch.column(i).to_numpy().astype(np.int64) for i in (2, 3, 4))
            first, last_one = at // length, (at + n - 1) // length
            pieces = last_one - first + 1
            row = np.repeat(np.arange(len(n)), pieces)
            seq = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            begin = np.maximum(seq * length, at[row])
            end = np.minimum((seq + 1) * length, (at + n)[row])
            start, size = begin - at[row], end - begin
            wide = [np.frombuffer(x, f"<u{w}").astype("<u4").data.cast("B") for x, w in zip(batch.column(1).to_pylist(), width.tolist())]
            crc = [zlib.crc32(wide[r][4 * a : 4 * (a + k)]) for r, a, k in zip(row.tolist(), start.tolist(), size.tolist())]
            padded = np.where(seq == last_sequence, last_size, length)
            arrays = [pa.array(x, type=pa.int64()) for x in (start, size, crc, n[row], seq, begin - seq * length, padded)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, type=pa.int64())), *arrays], names=schema.names)

    placed = tokens.join(bases, "part").select("doc_id", "ids", "n", "width", (F.col("base") + F.col("start_in_part")).alias("at"))
    return placed.mapInArrow(tidy(cut), schema)
