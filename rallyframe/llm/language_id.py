"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Features are hashed n-grams of 1 to 3 characters of the lower-cased text; TF is a count over the number of n-grams of the
text, IDF comes from all documents that may be learned from.  Weights are fitted by follow-the-regularised-leader
(FTRL-proximal) with elastic-net penalties on a bounded sample, and a temperature fitted on a part of the sample kept
aside turns scores into probabilities.

Probabilities only compare the learned languages.  Whether a text is in any of them is told by its n-grams of letters and
spaces: their mean log likelihood in the predicted language, against equally likely n-grams, is compared with that of the
documents kept aside (``Model.surprise``).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, free, map_texts, materialise, scratch, share, tidy

BITS = 15
ORDERS = (1, 2, 3)
#: Labelled documents per language, and in all, that the weights are fitted on; whole texts are used.
SAMPLE_PER_LANGUAGE, SAMPLE = 600, 60_000
#: Languages at most, the commonest ones, which bounds the table of weights.
LANGUAGES = 500
#: Bytes of features of the sample that are in the driver at once.
CHUNK_BYTES = 64 << 20
EPOCHS, ALPHA, BETA, L1, L2 = 4, 0.5, 1.0, 2e-4, 1e-4
#: Part of the sample, 1 in so many, that only fits the temperature and the usual likelihoods.  Smaller samples than ``FEW`` do both.
CALIBRATE, FEW = 5, 50
UNKNOWN = "und"
#: The pipeline rejects documents below this calibrated probability, those without letters, and those whose likelihood is this many
#: deviations below the usual one (or twice as many as 1 in 100 documents kept aside, if that is more).
LEAST_SCORE, MOST_SURPRISE = 0.3, 8.0
#: Share of the likelihood that all n-grams have in common, and the least deviation between documents of one language.
COMMON, LEAST_DEVIATION = 0.1, 0.25

_LETTERLIKE = re.compile(r"[^\W\d_]")
#: Code points hashed at once.
_BLOCK = 1 << 20


def has_letter(text: str) -> bool:
    """Whether any character is a letter (category L); numerals such as one half or a Roman eight are none."""
    return any(m[0].isalpha() for m in _LETTERLIKE.finditer(text))


def _blocks(text: str):
    """Slots of the hashed n-grams, and whether each has letters and spaces only, an array for each order and block."""
    code = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    for a in range(0, max(len(code), 1), _BLOCK):
        block = code[a : a + _BLOCK + max(ORDERS) - 1]
        mixed = np.zeros(len(block), np.uint32)
        plain = (block >= 97) & (block <= 122) | (block >= 128) | (block == 32) | (block == 10)
        every = plain
        for order in range(1, max(ORDERS) + 1):
            n = max(0, len(block) - order + 1)
            mixed = mixed[:n] * np.uint32(0x01000193) + (block[order - 1 :] + np.uint32(order)) * np.uint32(0x9E3779B1)
            every = every[:n] & plain[order - 1 :]
            kept = mixed[: min(_BLOCK, len(mixed))]
            if order in ORDERS and len(kept):
                yield ((kept ^ (kept >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS), every[: len(kept)]


def counts(text: str, plain: bool = False) -> np.ndarray:
    """How often each slot occurs; with ``plain`` only in n-grams of letters and spaces."""
    total = np.zeros(1 << BITS, dtype=np.float64)
    for slots, letters in _blocks(text):
        total += np.bincount(slots[letters] if plain else slots, minlength=1 << BITS)
    return total


class Model:
    """``table`` is weights times IDF, one row a language; ``usual`` the log of how much likelier a slot is than all on average."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float, usual: np.ndarray):
        self.languages, self.bias, self.temperature = languages, bias, temperature
        self.table, self.usual = np.ascontiguousarray(table, dtype=np.float32), usual.astype(np.float32)
        self.means, self.between, self.within, self.most = np.zeros(len(languages)), 1.0, 1.0, float("inf")

    def raw(self, found: list) -> np.ndarray:
        total, n = np.zeros(len(self.languages)), 0
        for slots, _ in found:
            # counting first reads the weights once a slot, not once an n-gram, for long texts
            if len(slots) > 1 << BITS:
                total += self.table @ np.bincount(slots, minlength=1 << BITS)
            else:
                total += [c[slots].sum(dtype=np.float64) for c in self.table]
            n += len(slots)
        return total / max(n, 1) * SCALE + self.bias

    def likelihood(self, found: list, language: int) -> tuple[float, float, int]:
        """Sum and sum of squares of the log likelihoods of the n-grams of letters and spaces, and their number."""
        total = squares = 0.0
        n = 0
        for slots, letters in found:
            x = self.usual[language][slots[letters]]
            total, squares, n = total + float(x.sum(dtype=np.float64)), squares + float((x * x).sum(dtype=np.float64)), n + len(x)
        return total, squares, n

    def surprise(self, found: list, language: int) -> float:
        """How many deviations the mean log likelihood lies below the usual one; short texts deviate more."""
        total, _, n = self.likelihood(found, language)
        if not n:
            return 0.0
        return float((self.means[language] - total / n) / np.sqrt(self.between + self.within * len(ORDERS) / n))

    def settle(self, seen: list[tuple[int, float, float, int]]) -> None:
        """Usual likelihoods and deviations from (language, sum, sum of squares, number) of the documents kept aside."""
        seen = [x for x in seen if x[3]]
        if not seen:
            return
        language, total, squares, n = (np.array(x, dtype=np.float64) for x in zip(*seen))
        language, mean = language.astype(int), total / n
        members = np.bincount(language, minlength=len(self.languages))
        self.means = (np.bincount(language, mean, len(self.languages)) + 5 * mean.mean()) / (members + 5)
        off = mean - self.means[language]
        self.within = max(0.0, float(squares.sum() / n.sum() - (total.sum() / n.sum()) ** 2))
        spread = float(np.mean(off * off - self.within * len(ORDERS) / n))
        self.between = max(spread, LEAST_DEVIATION**2)
        below = np.sort(-off / np.sqrt(self.between + self.within * len(ORDERS) / n))
        self.most = max(MOST_SURPRISE, 2 * float(below[int(0.99 * (len(below) - 1))]))

    def predict(self, text: str | None, surprise: bool = True) -> tuple[str, float, float]:
        """Language, calibrated probability and, if asked for, surprise."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, 0.0
        found = list(_blocks(text))
        z = self.raw(found) / self.temperature
        p = np.exp(z - z.max())
        best = int(np.argmax(p))
        return self.languages[best], float(p[best] / p.sum()), self.surprise(found, best) if surprise else 0.0


#: TF of n-grams is small; this brings features to order one.
SCALE = 10.0


def held_out(name: str = "doc_id"):
    """Whether crc32 of the id as text leaves the remainder 1 by 3; a null id is not held out, and not learned from."""
    return F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _document_frequencies(learnable: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each slot occurs, over all of ``learnable``; the result has a fixed size."""

    def run(batches):
        seen, n = np.zeros(1 << BITS, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    there = np.zeros(1 << BITS, dtype=bool)
                    for slots, _ in _blocks(text):
                        there[slots] = True
                    seen += there
                    n += 1
        at = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), type=pa.int64()), pa.array(np.append(seen[at], n), type=pa.int64())], names=["slot", "n"])

    rows = learnable.select("text").mapInArrow(tidy(run), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    frequency, documents = np.zeros(1 << BITS), 0
    for slot, n in zip(rows["slot"].to_pylist(), rows["n"].to_pylist()):
        if slot < 0:
            documents = int(n)
        else:
            frequency[slot] = n
    return frequency, documents


def _sample(learnable: DataFrame) -> DataFrame:
    """(lang, h, text): of each language the distinct rows with the smallest hashes of id and text, ``SAMPLE_PER_LANGUAGE`` at most."""
    counted = materialise(learnable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES), "languages")
    each = max(1, min(SAMPLE_PER_LANGUAGE, SAMPLE // max(1, counted.count())))
    rows = learnable.select("lang", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h"))
    first = Window.partitionBy("lang").orderBy("h")

    def smallest(rows):
        return rows.distinct().withColumn("r", F.row_number().over(first)).where(F.col("r") <= each).select("lang", "h")

    # of uniform hashes, those of a sample lie almost surely below twice its share: few rows reach the ranking
    share = (F.col("h") / float(1 << 63) + 1) / 2
    near = rows.join(F.broadcast(counted), "lang").where((F.col("count") <= 4 * each) | (share * F.col("count") <= 2 * each))
    chosen = materialise(smallest(near.select("lang", "h")), "chosen")
    # a language whose rows repeat may have too few there: all its rows are ranked
    got = chosen.groupBy("lang").agg(F.count("*").alias("got"))
    short = counted.where(F.col("count") > 4 * each).join(got, "lang", "left").where(F.coalesce("got", F.lit(0)) < each).select("lang")
    if short.limit(1).count():
        again = smallest(rows.join(F.broadcast(short), "lang"))
        chosen = materialise(chosen.join(F.broadcast(short), "lang", "left_anti").union(again), "chosen")
    hashed = learnable.select("lang", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h"), "text")
    return hashed.join(F.broadcast(chosen), ["lang", "h"], "left_semi").dropDuplicates(["lang", "h"])  # SAMPLE hashes at most, or one a language


def _features(sample: DataFrame, few: bool):
    """(lang, h, aside, plain, slots, tf): TF of all n-grams, or with ``plain`` of those of letters and spaces."""

    def run(batches):
        for batch in batches:
            for i, text in enumerate(batch.column(2).to_pylist()):
                rows = []
                aside = batch.column(1)[i].as_py() % CALIBRATE == 0
                for plain in (False, True):
                    c = counts(text, plain)
                    at = np.flatnonzero(c)
                    tf = (c[at] / max(c.sum(), 1)).astype(np.float32)
                    rows += [(use, plain, at.astype(np.int32).tobytes(), tf.tobytes()) for use in ((False, True) if few else (aside,)) if not (plain and use)]
                n = len(rows)
                use, plain_, slots, tf = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * n), pa.array([batch.column(1)[i].as_py()] * n, type=pa.int64()), pa.array(use), pa.array(plain_), pa.array(slots, type=pa.binary()), pa.array(tf, type=pa.binary())],
                    names=["lang", "h", "aside", "plain", "slots", "tf"],
                )

    return sample.select("lang", "h", "text").mapInArrow(tidy(run), "lang string, h long, aside boolean, plain boolean, slots binary, tf binary")


def _chunks(features: DataFrame):
    """A function that gives, each time it is called, all rows as lists of (label, slots, TF) of ``CHUNK_BYTES`` about, in a fixed order."""
    total = features.agg(F.sum(F.length("slots") + F.length("tf"))).first()[0] or 0
    n = max(1, -(-int(total) // CHUNK_BYTES))

    def chunk(k: int) -> list:
        rows = features if n == 1 else features.where(F.pmod(F.xxhash64("h", "lang"), F.lit(n)) == k)
        rows = rows.select("lang", "h", "slots", "tf").toArrow().to_pylist()
        rows.sort(key=lambda r: (r["h"], r["lang"], r["slots"], r["tf"]))
        return [(r["lang"], np.frombuffer(r["slots"], np.int32), np.frombuffer(r["tf"], np.float32).astype(np.float64)) for r in rows]

    only = [chunk(0)] if n == 1 else None
    return lambda: only if only is not None else (chunk(k) for k in range(n))


def ftrl(samples, idf: np.ndarray, languages: list[str], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Weights (slots x languages) and biases by FTRL-proximal with elastic-net penalties; ``samples()`` gives lists of (label, slots, TF)."""
    k = len(languages)
    z, n = np.zeros((len(idf) + 1, k)), np.zeros((len(idf) + 1, k))
    place = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    bias = len(idf)

    def weights(at):
        zz = z[at]
        w = -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(n[at])) / ALPHA + L2)
        return np.where(np.abs(zz) <= L1, 0.0, w)

    for _ in range(EPOCHS):
        for part in samples():
            for i in rng.permutation(len(part)):
                lang, slots, tf = part[i]
                at, x = np.append(slots, bias), np.append(tf * idf[slots] * SCALE, 1.0)
                w = weights(at)
                s = x @ w
                p = np.exp(s - s.max())
                p /= p.sum()
                p[place[lang]] -= 1.0
                g = x[:, None] * p[None, :]
                sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
                z[at] += g - sigma * w
                n[at] += g * g
    w = weights(np.arange(len(idf) + 1))
    return w[:bias], w[bias]


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least negative log likelihood, by golden section over its logarithm."""

    def loss(t):
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(labels)), labels]))

    a, b, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(60):
        c, d = b - ratio * (b - a), a + ratio * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def train(docs: DataFrame) -> Model:
    """Learns from text and lang of documents with a label that are not held out; without any, predicts nothing.

    A repeated row counts once in the sample.  Empty table: a model without languages.
    """
    learnable = docs.select(column(docs, "doc_id"), column(docs, "text"), column(docs, "lang").cast("string").alias("lang")).where(
        ~held_out() & F.col("doc_id").isNotNull() & F.col("text").isNotNull() & F.col("lang").isNotNull()
    )
    with scratch(docs.sparkSession):
        sample = materialise(_sample(learnable), "sample")
        languages = sorted(r.lang for r in sample.select("lang").distinct().collect())  # LANGUAGES rows at most
        if not languages:
            return Model([], np.zeros((0, 1 << BITS)), np.zeros(0), 1.0, np.zeros((0, 1 << BITS)))
        place = {x: i for i, x in enumerate(languages)}
        features = materialise(_features(sample, sample.count() < FEW), "features")
        frequency, documents = _document_frequencies(learnable)
        idf = np.log((1 + documents) / (1 + frequency)) + 1
        w, bias = ftrl(_chunks(features.where("not aside and not plain")), idf, languages)
        usual, members = np.zeros((len(languages), 1 << BITS)), np.zeros(len(languages))
        for part in _chunks(features.where("not aside and plain"))():
            for lang, slots, tf in part:
                usual[place[lang]][slots] += tf
                members[place[lang]] += 1
        usual = np.log((1 - COMMON) * usual / np.maximum(members, 1)[:, None] * (1 << BITS) + COMMON)
        aside = [((tf * idf[slots] * SCALE) @ w[slots] + bias, place[lang]) for part in _chunks(features.where("aside and not plain"))() for lang, slots, tf in part]
        t = temperature(np.array([x for x, _ in aside]), np.array([y for _, y in aside])) if aside else 1.0
        model = Model(languages, (idf[:, None] * w).T, bias, max(t, 0.05), usual)
        model.settle(_likelihoods(sample, model, place))
    return model


def _likelihoods(sample: DataFrame, model: Model, place: dict[str, int]) -> list[tuple[int, float, float, int]]:
    """(language, sum, sum of squares, number) of the n-grams of the documents kept aside, or of all of few."""
    shared = share(sample.sparkSession, model)
    rows = sample if sample.count() < FEW else sample.where(F.pmod("h", F.lit(CALIBRATE)) == 0)

    def run(batches):
        own = shared()
        for batch in batches:
            got = [own.likelihood(list(_blocks(t)), place[lang]) for lang, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            total, squares, n = zip(*got) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array([place[x] for x in batch.column(0).to_pylist()], type=pa.int32()), pa.array(total, type=pa.float64()), pa.array(squares, type=pa.float64()), pa.array(n, type=pa.int64())], names=["language", "total", "squares", "n"])

    found = rows.select("lang", "text").mapInArrow(tidy(run), "language int, total double, squares double, n long").toArrow()
    return sorted(zip(*(found[c].to_pylist() for c in found.column_names)))


def predict(docs: DataFrame, model: Model, keep: list[str], names: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """``keep`` columns of ``docs`` with ``lang_pred`` and ``score`` of whole texts, and their surprise if ``names`` has a third name.

    Text that is null or has no letter: ``und``, 0.  Repeated and equal texts get equal answers; a tie goes to the language
    first in alphabetical order.  Very long texts are taken in blocks.  Empty table: no rows.  Columns named like a result are replaced.
    """
    shared = share(docs.sparkSession, model)  # 2**BITS columns of two floats for each of LANGUAGES at most
    fields = [T.StructField(n, T.StringType() if i == 0 else T.DoubleType()) for i, n in enumerate(names)]

    def make():
        own = shared()

        def run(texts):
            got = [own.predict(t.decode("utf-8", "replace") if t else None, len(fields) > 2) for t in texts]
            return [[g[i] for g in got] for i in range(len(fields))]

        return run

    return map_texts(docs, make, fields, [c for c in keep if c.lower() not in names])


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document.

    Null text, or one without a letter: ``und``, 0; so with all texts where no label can be learned from.  A null doc_id is not held out,
    and not learned from.  Repeated rows are each answered, ties go to the language first in alphabetical order, texts are taken
    whole.  Empty table: no rows.  Other columns are not looked at.
    """
    found = predict(docs.select(column(docs, "doc_id"), column(docs, "text")), train(docs), ["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def accept(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """``docs`` without documents that have no letter, whose language is doubtful, or that are in no learned language.

    Null and empty texts go; repeated rows stay or go together; columns stay as they were, whatever their names.  Where no label can
    be learned from, all go.  Empty table: empty result.
    """
    model = train(docs)
    made = tuple(free(docs, n) for n in ("__lang_pred", "__score", "__surprise"))
    found = predict(docs, model, docs.columns, made)
    good = (F.col(made[0]) != UNKNOWN) & (F.col(made[1]) >= least) & (F.col(made[2]) <= model.most)
    return found.where(good).select(*(column(found, c) for c in docs.columns))
