"""Search for texts inside names by postings of character n-grams: the rarest one finds candidates, then the exact test decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.store import Store


def _grams(text: Column, n: int) -> Column:
    size = F.char_length(text)
    return F.when(size >= n, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1))), lambda i: F.substring(text, i, F.lit(n))))).otherwise(F.array().cast("array<string>"))


def asked(text: Column) -> Column:
    """The n-grams that a name with ``text`` in it has: its pairs of characters, or its only character."""
    return F.when(F.char_length(text) >= 2, _grams(text, 2)).otherwise(_grams(text, 1))


def postings(names: DataFrame, column: str) -> DataFrame:
    """(gram, name): single characters and pairs of each distinct name; null names have none."""
    name = names.select(F.col(column).alias("name")).where("name is not null").distinct()
    return name.select(F.explode(F.concat(_grams(F.col("name"), 1), _grams(F.col("name"), 2))).alias("gram"), "name")


def frequencies(posted: DataFrame) -> DataFrame:
    """(gram, names): in how many names each n-gram is."""
    return posted.groupBy("gram").agg(F.count("*").alias("names"))


def candidates(texts: DataFrame, column: str, posted: DataFrame) -> DataFrame:
    """(text, name): names with the rarest n-gram of each text; a text with an n-gram that no name has needs no candidates."""
    grams = texts.select(F.col(column).alias("text")).where("trim(text) <> ''").distinct()
    grams = grams.select("text", F.explode(asked(F.col("text"))).alias("gram")).join(frequencies(posted), "gram", "left")
    known = F.coalesce("names", F.lit(0).cast("long"))
    rarest = grams.groupBy("text").agg(F.min_by("gram", F.struct(known.alias("k"), "gram")).alias("gram"))
    return rarest.join(posted, "gram").select("text", "name")


def containing(texts: DataFrame, column: str, names: DataFrame, name: str) -> DataFrame:
    """(text, name): each distinct name that contains each distinct text; blank texts are in none.

    Both sides may be large.  Work grows with the names that share a text's rarest n-gram; hot n-grams are split by Spark's skew join.
    """
    return candidates(texts, column, postings(names, name)).where(F.col("name").contains(F.col("text")))


def stored(store: Store, names: DataFrame, column: str, batch: tuple[str, int] | None = None) -> int:
    """Puts the postings of all ``names`` into ``store``, whose key is ``gram``; the version."""
    posted = store.stage("postings", postings(names, column))
    return store.apply({"postings": posted, "frequencies": frequencies(posted)}, batch=batch)


def find(store: Store, text: str, version: int | None = None) -> DataFrame:
    """(name): stored names that contain ``text``; of the postings only the bucket of its rarest n-gram is read.

    One row for each n-gram of the text, a handful, comes to the driver to tell which is the rarest.
    """
    version = version or store.manifest()["version"]
    none = store.read("postings", version).select("name").limit(0)
    text = text.strip()
    if not text:
        return none
    grams = {text} if len(text) == 1 else {text[i : i + 2] for i in range(len(text) - 1)}
    counts = {}
    for gram in sorted(grams):
        found = store.lookup("frequencies", gram, version).first()
        if not found:
            return none
        counts[gram] = found.names
    rarest = min(counts, key=lambda g: (counts[g], g))
    return store.lookup("postings", rarest, version).where(F.col("name").contains(text)).select("name")
