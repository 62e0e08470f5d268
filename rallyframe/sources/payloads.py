"""Answers of services as rows: the tournament list, items, schedules and news; and literal result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .calls import SUCCESS
from .schemas import ENTRY, ITEM, LISTED, MATCH, NEWS

_LENIENT = {"allowUnquotedControlChars": "true"}


def _result(answers: DataFrame, field: str, kind: str, checked: bool) -> DataFrame:
    """``answers`` with the list ``result.<field>`` as ``found``; empty if it is not there, or, where it is ``checked``, without success."""
    parsed = F.from_json("answer", f"success string, result struct<{field}:array<{kind}>>", _LENIENT)
    rows = answers.withColumn("_a", parsed)
    found = F.coalesce(F.col(f"_a.result.{field}"), F.array().cast(f"array<{kind}>"))
    if checked:
        found = F.when(F.col("_a.success") == SUCCESS, found).otherwise(F.array().cast(f"array<{kind}>"))
    return rows.withColumn("found", found).drop("_a")


def _struct(schema: str) -> str:
    return "struct<" + ",".join(f.strip().replace(" ", ":", 1) for f in schema.split(",")) + ">"


def listed(answers: DataFrame) -> DataFrame:
    """(status_code, pos, fields of a listed tournament) of (status_code, answer)."""
    return _result(answers, "info", _struct(LISTED), True).select("status_code", F.posexplode("found").alias("pos", "t")).select("status_code", "pos", "t.*")


def items(answers: DataFrame) -> DataFrame:
    """(openid, pos, GroupID, GroupName) of (openid, answer)."""
    rows = _result(answers, "matchiteminfo", ITEM, False).select("openid", F.posexplode("found").alias("pos", "i"))
    return rows.select("openid", "pos", F.coalesce("i.GroupID", F.lit("")).alias("GroupID"), F.coalesce("i.GroupName", F.lit("")).alias("GroupName"))


def schedules(answers: DataFrame) -> DataFrame:
    """(openid, matches) of (openid, answer); only those that have matches."""
    return _result(answers, "schedule", MATCH, False).where(F.size("found") > 0).select("openid", F.col("found").alias("matches"))


def news(answers: DataFrame) -> DataFrame:
    """(openid, info) of (openid, answer)."""
    return _result(answers, "info", NEWS, True).select("openid", F.col("found").alias("info"))


def entries(spark: SparkSession, openid: str, category: str | None, promotion: str | None, tables: dict[str, list[tuple]]) -> DataFrame:
    """Entries of a transcribed result: for each group, in order, rows of (rank, unit or list of units by member, names ...)."""
    rows = []
    for event_pos, (group, placed) in enumerate(tables.items()):
        for entry_pos, (rank, unit, *names) in enumerate(placed):
            units = [unit] if isinstance(unit, str) else list(unit)
            rows.append((openid, category, promotion, event_pos, group, entry_pos, rank, units, names))
    return spark.createDataFrame(rows, ENTRY)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """Entries of many results from JSON lines with the fields of an entry."""
    return spark.read.schema(ENTRY).json(path)
