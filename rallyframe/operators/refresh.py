"""Whole runs: from the lists of tournaments to stored documents and indexes, and from news to attached documents."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import answers, payloads, read_stored, replace_documents, write_indexes
from . import flatten, indexes, ingest, standings

#: Seconds between calls of lists, items and matches, and of news.
LIST_PAUSE, NEWS_PAUSE = 0.5, 0.3


def merged(records: DataFrame, schedules: DataFrame, items: DataFrame, stored: DataFrame, draw_base: str | None = None) -> DataFrame:
    """Documents of ``records`` with the matches of ``schedules`` (openid, matches), groups and standings from them.

    Curated fields of ``stored`` stay, and so do groups, matches and standings where there is no schedule.  Official standings come
    before derived ones, group by group.  ``draw_base`` is the address below which the draws of items lie.
    """
    rows = ingest.with_stored(records, stored)
    fresh = rows.drop("matches").join(schedules, "openid").select(*rows.columns)
    found = ingest.groups_of(flatten.matches(fresh), items)
    draw = F.when(F.col("id") != "", F.concat(F.lit(draw_base), F.lit("/"), "openid", F.lit("/"), "id", F.lit(".html"))) if draw_base else F.lit(None)
    group = F.struct("id", "name", draw.cast("string").alias("drawUrl"), "tags")
    groups = found.groupBy("openid").agg(F.transform(F.array_sort(F.collect_list(F.struct("group_pos", group.alias("g")))), lambda x: x["g"]).alias("_groups"))
    placed = standings.nested(standings.with_precedence(flatten.standings(fresh), standings.derive(fresh))).withColumnRenamed("standings", "_standings")
    new = schedules.select("openid", F.col("matches").alias("_matches")).join(groups, "openid", "left").join(placed, "openid", "left")
    out = rows.join(new, "openid", "left")
    there = F.col("_matches").isNotNull()
    either = lambda c: F.when(there, F.coalesce(F.col(f"_{c}").cast(rows.schema[c].dataType), F.array().cast(rows.schema[c].dataType))).otherwise(F.col(c)).alias(c)
    return out.select(*(either(c) if c in ("groups", "matches", "standings") else F.col(c) for c in rows.columns))


def _asked(rows: DataFrame, **fields) -> DataFrame:
    return rows.withColumn("payload", F.to_json(F.struct(*(v.alias(k) for k, v in fields.items()))))


def scrape(spark: SparkSession, path: str, list_url: str, live_url: str, landing: str, full: bool = False, draw_base: str | None = None, today: Column | None = None, token: dict | None = None, every: float = LIST_PAUSE, callers: int = 1, **options) -> DataFrame:
    """Lists tournaments by status, fetches those that need it, stores their documents in ``path``, and rebuilds the indexes beside it.

    Answers are landed below ``landing`` first, so that no call is made twice; ``callers`` tasks call, one call every ``every`` seconds in all.  Result: (action, n): new, updated, skipped, failed.
    """

    def landed(rows: DataFrame, url: str, name: str, **more) -> DataFrame:
        answers(rows, url, every, callers, **options, **more).write.mode("overwrite").parquet(f"{landing}/{name}")
        return spark.read.parquet(f"{landing}/{name}")

    lists = spark.createDataFrame([(s,) for s in ingest.STATUSES], "status_code string")
    asked = _asked(lists, M_Type=F.lit("1"), M_Status=F.col("status_code"), M_Area=F.lit("0"), Year=F.lit(""), Month=F.lit(""), SContent=F.lit(""), api=F.lit("mlist"))
    first = ingest.first_listing(payloads.listed(landed(asked if every else asked.coalesce(1), list_url, "lists", token=json.dumps(token or {"api": "gtoken"}))))
    stored = read_stored(spark, path)
    records = ingest.records(first, today)
    need = ingest.needed(records, stored, full)
    live = need.where(F.col("status") != "registering").select("openid")
    got = {api: landed(_asked(live, api=F.lit(api), Matchno=F.col("openid")), live_url, api) for api in ("items", "matches")}
    failed = got["items"].where("error is not null").select("openid").union(got["matches"].where("error is not null").select("openid")).distinct()
    good = need.join(failed, "openid", "left_anti")
    docs = merged(good, payloads.schedules(got["matches"]).join(failed, "openid", "left_anti"), payloads.items(got["items"]), stored, draw_base)
    docs.write.mode("overwrite").parquet(f"{landing}/documents")
    done = spark.read.schema(docs.schema).parquet(f"{landing}/documents")
    known = stored.select("openid").withColumn("known", F.lit(True))
    actions = records.select("openid").join(done.select("openid").withColumn("done", F.lit(True)), "openid", "left").join(failed.withColumn("failed", F.lit(True)), "openid", "left").join(known, "openid", "left")
    action = F.when(F.col("failed"), "failed").when(F.col("done").isNull(), "skipped").when(F.col("known"), "updated").otherwise("new")
    counted = ingest.counters(actions, action).collect()  # four rows at most
    replace_documents(done, path)
    write_indexes(indexes.build(read_stored(spark, path)), f"{path}_index")
    return spark.createDataFrame(counted, "action string, n long")


def attach_documents(spark: SparkSession, path: str, url: str, landing: str, force: bool = False, token: dict | None = None, every: float = NEWS_PAUSE, callers: int = 1, **options) -> DataFrame:
    """Fetches the news of stored tournaments, and stores those whose documents changed; (action, n): changed, same, skipped, failed."""
    stored = read_stored(spark, path)
    due = stored.where(~ingest.skipped(stored, force))
    asked = _asked(due.select("openid"), OpenID=F.col("openid"), api=F.lit("news"))
    answers(asked, url, every, callers, token=json.dumps(token or {"api": "gtoken"}), **options).write.mode("overwrite").parquet(f"{landing}/news")
    got = spark.read.parquet(f"{landing}/news")
    ingest.attached(due, payloads.news(got.where("error is null"))).where("changed").drop("changed").write.mode("overwrite").parquet(f"{landing}/attached")
    changed = spark.read.schema(stored.schema).parquet(f"{landing}/attached")
    actions = stored.select("openid").join(got.select("openid", F.col("error").isNotNull().alias("failed")), "openid", "left").join(changed.select("openid").withColumn("changed", F.lit(True)), "openid", "left")
    action = F.when(F.col("failed").isNull(), "skipped").when(F.col("failed"), "failed").when(F.col("changed"), "changed").otherwise("same")
    counted = ingest.counters(actions, action).collect()  # four rows at most
    replace_documents(changed, path)
    return spark.createDataFrame(counted, "action string, n long")
