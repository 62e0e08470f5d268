"""Ingestion: renaming, change detection, merging with what is stored, and attaching documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import base_group, category_of, classify_document, group_tags, nz, truthy, utrim
from ..functions.names import OTHER_SPORTS, REGULATION, RESULT
from . import flatten, standings

# Names of city codes and of statuses.
CITIES = {
    "1": "臺北市", "2": "新北市", "3": "基隆市", "4": "桃園市", "5": "新竹縣", "6": "新竹市", "7": "苗栗縣", "8": "臺中市", "9": "彰化縣", "10": "南投縣", "11": "雲林縣",
    "12": "嘉義縣", "13": "嘉義市", "14": "臺南市", "15": "高雄市", "16": "屏東縣", "17": "宜蘭縣", "18": "花蓮縣", "19": "臺東縣", "20": "澎湖縣", "21": "金門縣", "22": "連江縣",
}
STATUSES = {"1": "registering", "2": "ongoing", "3": "finished"}
OTHER_CITY = "其他"


def _named(code: Column, names: dict[str, str]) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in names.items() for x in kv)), nz(code))


def first_listing(listed: DataFrame) -> DataFrame:
    """Of the lists by status code, the first (smallest code, then position) that names a tournament; other sports go."""
    first = Window.partitionBy("OpenID").orderBy("status_code", "pos")
    rows = listed.withColumn("_r", F.row_number().over(first)).where("_r = 1").drop("_r")
    return rows.where(~nz(F.col("MName")).rlike(OTHER_SPORTS))


def records(listed: DataFrame, today: Column | None = None) -> DataFrame:
    """List rows as tournament records; an unknown city is ``其他``, an unknown status fails."""
    status = _named(F.col("status_code"), STATUSES)
    return listed.select(
        F.col("OpenID").alias("openid"), F.col("MName").alias("name"), F.coalesce(_named(F.col("CityName"), CITIES), F.lit(OTHER_CITY)).alias("city"),
        F.coalesce(status, F.raise_error(F.concat(F.lit("unknown status "), nz(F.col("status_code")))).cast("string")).alias("status"),
        nz(F.col("Registdate1")).alias("registerStart"), nz(F.col("Registdate2")).alias("registerEnd"), nz(F.col("Matchdate1")).alias("dateStart"), nz(F.col("Matchdate2")).alias("dateEnd"),
        nz(F.col("Venus")).alias("venue"), nz(F.col("Site_Pic")).alias("image"), (nz(F.col("IsSystem")) == "1").alias("isSystem"),
        (F.current_date() if today is None else today).cast("string").alias("lastUpdated"), category_of(nz(F.col("MName"))).alias("category"),
    )


def needed(new: DataFrame, stored: DataFrame, full: bool = False) -> DataFrame:
    """New records to fetch: all, unknown ones, a changed status, ongoing ones, or finished ones without matches."""
    old = stored.select("openid", F.col("status").alias("_status"), (F.coalesce(F.size("matches"), F.lit(0)) > 0).alias("_matches"), F.lit(True).alias("_known"))
    rows = new.join(old, "openid", "left")
    need = F.lit(full) | F.col("_known").isNull() | ~F.col("status").eqNullSafe(F.col("_status")) | (F.col("status") == "ongoing") | ((F.col("status") == "finished") & ~F.col("_matches"))
    return rows.where(need).drop("_status", "_matches", "_known")


def with_stored(new: DataFrame, stored: DataFrame) -> DataFrame:
    """New records with the curated columns of what is stored; a category told by the name comes first."""
    kept = ["category", "promotion", "resultPdf", "regulation", "groups", "matches", "standings", "documents"]
    old = stored.select("openid", *(F.col(c).alias(f"_{c}") for c in kept))
    out = new.join(old, "openid", "left").withColumn("category", F.when(truthy(F.col("category")), F.col("category")).otherwise(F.col("_category")))
    return out.select("*", *(F.col(f"_{c}").alias(c) for c in kept[1:])).drop(*(f"_{c}" for c in kept))


def groups_of(schedule: DataFrame, items: DataFrame) -> DataFrame:
    """(openid, group_pos, id, name, tags): groups of the items, with the head of the first match of each, be it empty; without items, of the matches.

    ``schedule``: flattened matches; ``items``: openid, pos, GroupID, GroupName.  Tournaments without a schedule give none.
    """
    heads = schedule.groupBy("openid", "base_group").agg(F.min_by(nz(F.col("HeadGroup")), "match_pos").alias("head"))
    there = schedule.select("openid").distinct()
    given = items.join(there, "openid", "left_semi").select("openid", "pos", F.col("GroupID").alias("id"), F.col("GroupName").alias("name"))
    named = schedule.where(truthy(F.col("groupName"))).join(items.select("openid").distinct(), "openid", "left_anti").select("openid", F.col("base_group").alias("name")).distinct()
    order = Window.partitionBy("openid").orderBy("name")
    rows = given.unionByName(named.select("openid", (F.row_number().over(order) - 1).alias("pos"), F.lit("").alias("id"), "name"))
    rows = rows.withColumn("base_group", base_group(F.col("name"))).join(heads, ["openid", "base_group"], "left")
    return rows.select("openid", F.col("pos").alias("group_pos"), "id", "name", group_tags(F.col("name"), nz(F.col("head"))).alias("tags"))


def refreshed(docs: DataFrame) -> DataFrame:
    """Standings of documents after new matches: official rows, and derived ones of other groups; without a schedule as stored."""
    scheduled = docs.where(F.coalesce(F.size("matches"), F.lit(0)) > 0)
    rest = docs.where(F.coalesce(F.size("matches"), F.lit(0)) == 0)
    return standings.with_precedence(flatten.standings(scheduled).drop("standing_pos"), standings.derive(scheduled)).unionByName(flatten.standings(rest).drop("standing_pos"), allowMissingColumns=True)


def with_standings(docs: DataFrame) -> DataFrame:
    """``docs`` with standings after new matches, as ``refreshed`` has them, made inside each row."""
    kind = docs.schema["standings"].dataType
    stored = F.coalesce("standings", F.array().cast(kind))
    official = F.filter(stored, lambda s: s["source"] == "pdf")
    named = F.transform(official, lambda s: s["group"])
    own = F.filter(standings.derived(F.col("matches")), lambda s: ~F.array_contains(named, s["group"]))
    names = [f.name for f in kind.elementType.fields]
    given = {"source": F.lit("derived")}
    own = F.transform(own, lambda s: F.struct(*((s[n] if n in ("group", "rank", "unit", "members") else given.get(n, F.lit(None))).alias(n) for n in names))).cast(kind)
    ordered = F.array_sort(F.transform(F.concat(official, own), lambda s, i: F.struct(s["group"].alias("g"), s["rank"].alias("r"), i.alias("i"), s.alias("s"))))
    fresh = F.transform(ordered, lambda x: x["s"])
    return docs.withColumn("standings", F.when(F.coalesce(F.size("matches"), F.lit(0)) > 0, fresh).otherwise(F.col("standings")))


def skipped(docs: DataFrame, force: bool = False) -> Column:
    """Tournaments whose documents are not fetched: made by hand, or finished with a result document."""
    has_result = F.exists(F.coalesce("documents", F.array()), lambda d: d["type"] == RESULT)
    return F.col("openid").startswith("manual-") | (F.lit(not force) & (F.col("status") == "finished") & F.coalesce(has_result, F.lit(False)))


def attached(docs: DataFrame, news: DataFrame) -> DataFrame:
    """``docs`` with the documents of ``news`` (openid, info), and ``changed``: whether anything differs from before.

    Rows without a link go; the first regulation and result links fill what is missing.
    """
    made = F.transform(
        F.filter("info", lambda x: utrim(nz(x["Link"])) != ""),
        lambda x: F.struct(
            F.replace(utrim(nz(x["Cont"])), F.lit("\n"), F.lit(" ")).alias("title"), utrim(nz(x["Link"])).alias("url"), nz(x["Stime"]).alias("date"), classify_document(x["Cont"], x["Link"]).alias("type")
        ),
    )
    rows = docs.join(news.select("openid", made.alias("_new")), "openid")
    first = lambda kind: F.get(F.filter("_new", lambda d: d["type"] == kind), 0)["url"]
    none = F.lit(None).cast("string")
    fields = ["organizer", "ball", "fee", "souvenir", "awards", "notes"]
    fresh = F.struct(*(none.alias(f) for f in fields), first(REGULATION).alias("pdf"))
    regulation = F.when(first(REGULATION).isNull(), F.col("regulation")).when(F.col("regulation").isNull(), fresh).when(~truthy(F.col("regulation.pdf")), F.col("regulation").withField("pdf", first(REGULATION))).otherwise(F.col("regulation"))
    result = F.when(truthy(F.col("resultPdf")), F.col("resultPdf")).otherwise(F.coalesce(first(RESULT), F.col("resultPdf")))
    changed = ~(F.col("_new").eqNullSafe(F.col("documents")) & regulation.eqNullSafe(F.col("regulation")) & result.eqNullSafe(F.col("resultPdf")))
    return rows.select("*", regulation.alias("_regulation"), result.alias("_result"), changed.alias("changed")).select(
        *(F.col({"documents": "_new", "regulation": "_regulation", "resultPdf": "_result"}.get(c, c)).alias(c) for c in docs.columns), "changed"
    )


def counters(rows: DataFrame, action: Column) -> DataFrame:
    return rows.groupBy(action.alias("action")).agg(F.count("*").alias("n"))
