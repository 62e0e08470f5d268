"""Sources and sinks: nested JSON documents, recorded API payloads, page images, Parquet tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


from .schemas import TOURNAMENT

#: Folders of stored documents.
BUCKETS = 64


def read_documents(spark: SparkSession, path: str, schema: str = TOURNAMENT) -> DataFrame:
    """One row a document; control characters inside strings are tolerated."""
    return spark.read.schema(schema).option("multiLine", True).option("allowUnquotedControlChars", True).json(path)


def landing(spark: SparkSession, path: str, schema: str = TOURNAMENT) -> DataFrame:
    """The documents that arrive in a folder, as a stream."""
    return spark.readStream.schema(schema).option("multiLine", True).option("allowUnquotedControlChars", True).json(path)


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def read_stored(spark: SparkSession, path: str, schema: str = TOURNAMENT) -> DataFrame:
    """Documents that ``replace_documents`` wrote; none if nothing is there yet."""
    try:
        return spark.read.schema(f"{schema}, bucket int").parquet(path).drop("bucket")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def lookup(spark: SparkSession, path: str, openid: str, schema: str = TOURNAMENT, buckets: int = BUCKETS) -> DataFrame:
    """The stored document of an openid, or no row; only its bucket is read."""
    try:
        rows = spark.read.schema(f"{schema}, bucket int").parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return rows.where((F.col("bucket") == _bucket(F.lit(openid), buckets)) & (F.col("openid") == openid)).drop("bucket")


def replace_documents(documents: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Writes documents over those with the same openid; others stay as they are.

    Documents lie in ``buckets`` folders by the hash of openid, always as many for one path.  Only the folders that get a document
    are written, with what they held before; a repeated call changes nothing.
    """
    spark = documents.sparkSession
    new = documents.withColumn("bucket", _bucket(F.col("openid"), buckets))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in documents.schema)
    stored = read_stored(spark, path, schema).withColumn("bucket", _bucket(F.col("openid"), buckets))
    touched = new.select("bucket").distinct()  # buckets rows at most
    kept = stored.join(F.broadcast(touched), "bucket", "left_semi").join(new.select("openid"), "openid", "left_anti")
    both = new.unionByName(kept).repartition("bucket")
    both.write.mode("overwrite").partitionBy("bucket").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").parquet(path)


def write_indexes(tables: dict[str, DataFrame], path: str) -> None:
    for name, rows in tables.items():
        rows.write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/{name}")


def binary_pages(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """(path, length, content) of binary files; rendering needs a library that is not part of Spark."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("length"), "content")
