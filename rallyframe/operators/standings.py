"""Final standings: derivation from matches, and precedence of official results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import base_group, entry_key, group_tags, is_promoted, let, member_units, nz, safe_int, side_members, unit_text, utrim
from ..sources.schemas import STANDING
from . import flatten

# Match types of finals, of the match for third place, and of final round robins.
FINALS, THIRD, ROUND_ROBIN = ("R2", "F2"), "R34", ("F3", "F4")


#: An array of standings that has none.
_NONE = "array<struct<group:string,rank:int,unit:string,members:array<string>,there:boolean>>"


def _bracket(matches: Column, group: Column, first: int) -> Column:
    """Both sides of the only match, the winner's first."""
    row = lambda side, rank: F.struct(group.alias("group"), rank.alias("rank"), side["unit"].alias("unit"), side["members"].alias("members"), side["there"].alias("there"))
    won = lambda m: F.when(m["winner"] == "A", F.array(m["A"], m["B"])).otherwise(F.array(m["B"], m["A"]))
    sides = let(F.get(matches, 0), won)
    return F.filter(F.transform(sides, lambda side, i: row(side, i + first)), lambda r: r["there"])


def _table(matches: Column, group: Column) -> Column:
    """Entries of a round robin in order: wins, then point difference, then first appearance."""

    def sides(m):
        one = lambda s, o: F.struct(m[s]["there"].alias("there"), m[s]["key"].alias("key"), m[s]["unit"].alias("unit"), m[s]["members"].alias("members"), (m["winner"] == s).cast("long").alias("win"), F.coalesce(m[s]["score"] - m[o]["score"], F.lit(0)).alias("difference"))
        return F.array(one("A", "B"), one("B", "A"))

    def entry(own, i):
        total = lambda field: F.aggregate(own, F.lit(0).cast("long"), lambda x, s: x + s[field])
        return F.struct((-total("win")).alias("w"), (-total("difference")).alias("d"), i.alias("i"), F.get(own, 0)["unit"].alias("unit"), F.get(own, 0)["members"].alias("members"))

    def entries(played):
        keys = F.array_distinct(F.transform(played, lambda s: s["key"]))
        return F.sort_array(F.transform(keys, lambda key, i: let(F.filter(played, lambda s: s["key"] == key), lambda own: entry(own, i))))

    made = let(F.filter(F.flatten(F.transform(matches, sides)), lambda s: s["there"]), entries)
    return F.transform(made, lambda e, i: F.struct(group.alias("group"), (i + 1).alias("rank"), e["unit"].alias("unit"), e["members"].alias("members"), F.lit(True).alias("there")))


def derived(matches: Column) -> Column:
    """Standings (group, rank, unit, members, there) of a document's matches as one array, of its own matches only."""

    def told(m):
        def side(s):
            unit = nz(m[f"team{s}"])
            of = lambda members: F.struct(((unit != "") | (F.size(members) > 0)).alias("there"), entry_key(unit, members).alias("key"), unit.alias("unit"), members.alias("members"), safe_int(m[f"{s}sidescore"]).alias("score"))
            return let(side_members(m["scoreinfo"], s), of)

        return F.struct(base_group(m["groupName"]).alias("group"), utrim(nz(m["matchtype"])).alias("kind"), m["winner"].alias("winner"), F.coalesce(m["winner"].isin("A", "B"), F.lit(False)).alias("decided"), side("A").alias("A"), side("B").alias("B"))

    all_matches = F.filter(F.transform(F.coalesce(matches, F.array()), told), lambda m: m["group"] != "")

    none = F.array().cast(_NONE)

    def of(group, own):
        podium = lambda finals, thirds: F.concat(_bracket(finals, group, 1), F.when(F.size(thirds) == 1, _bracket(thirds, group, 3)).otherwise(none))
        table = lambda rounds: F.when((F.size(rounds) > 0) & F.forall(rounds, lambda m: m["decided"]), _table(rounds, group)).otherwise(none)
        thirds = F.filter(own, lambda m: m["decided"] & (m["kind"] == THIRD))
        rounds = F.filter(own, lambda m: m["kind"].isin(*ROUND_ROBIN))
        ranked = lambda finals: F.when(F.size(finals) == 1, let(thirds, lambda t: podium(finals, t))).otherwise(let(rounds, table))
        return let(F.filter(own, lambda m: m["decided"] & m["kind"].isin(*FINALS)), ranked)

    groups = lambda x: F.array_distinct(F.transform(x, lambda m: m["group"]))
    return F.flatten(let(all_matches, lambda x: F.transform(groups(x), lambda g: let(F.filter(x, lambda m: m["group"] == g), lambda own: of(g, own)))))


def derive(docs: DataFrame) -> DataFrame:
    """(openid, group, rank, unit, members, source): a single decided final gives ranks 1 and 2, and then a single match for
    third place 3 and 4; else a round robin that is decided throughout is ranked by wins, point difference and first appearance.

    All of it happens inside each row; nothing is shuffled.
    """
    rows = docs.select("openid", F.inline(derived(F.col("matches"))))
    return rows.select("openid", "group", "rank", "unit", "members", F.lit("derived").alias("source"))


def built_entries(entries: DataFrame) -> DataFrame:
    """Transcribed entries as standing rows, with promotion and, for mixed pairs, units member by member."""
    units = F.col("units")
    return entries.select(
        "openid", "group", "rank", unit_text(units).alias("unit"), "members", F.lit("pdf").alias("source"), member_units(units).alias("memberUnits"), is_promoted(F.col("category"), F.col("group"), F.col("rank")).alias("promoted"), "event_pos", "entry_pos"
    )


def with_precedence(stored: DataFrame, derived: DataFrame) -> DataFrame:
    """Official rows of ``stored``, and derived rows of groups that have none; (group, rank) order is left to the reader."""
    official = stored.where("source = 'pdf'")
    rest = derived.join(official.select("openid", "group").distinct(), ["openid", "group"], "left_anti")
    return official.unionByName(rest, allowMissingColumns=True)


def apply_import(stored: DataFrame, entries: DataFrame) -> DataFrame:
    """``stored`` rows of groups that are not imported, and the imported ones; applying it twice changes nothing."""
    new = built_entries(entries)
    # joined by the openid alone, which the window needs as well: rows that are dealt by it are not shuffled again
    gone = new.groupBy("openid").agg(F.collect_set("group").alias("_gone"))
    kept = stored.join(gone, "openid", "left").where(~F.coalesce(F.array_contains("_gone", F.col("group")), F.lit(False))).drop("_gone")
    last = Window.partitionBy("openid").orderBy("group", "rank", "age", "position")
    place = lambda *c: F.struct(*(F.col(x).cast("long").alias(f"p{i}") for i, x in enumerate(c)))
    kept = kept.withColumn("age", F.lit(0)).withColumn("position", place("standing_pos", "standing_pos"))
    new = new.withColumn("age", F.lit(1)).withColumn("position", place("event_pos", "entry_pos")).drop("event_pos", "entry_pos")
    return kept.unionByName(new, allowMissingColumns=True).withColumn("standing_pos", F.row_number().over(last) - 1).drop("age", "position")


def missing_targets(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """Imported openids without a document."""
    return entries.select("openid").distinct().join(docs.select("openid"), "openid", "left_anti")


def missing_groups(groups: DataFrame, entries: DataFrame) -> DataFrame:
    """Groups to append for an import: names that the document does not have, with tags by name."""
    new = entries.groupBy("openid", F.col("group").alias("name")).agg(F.min("event_pos").alias("event_pos"))
    new = new.join(groups.select("openid", "name"), ["openid", "name"], "left_anti")
    return new.select("openid", F.lit("").alias("id"), "name", group_tags(F.col("name"), F.lit(None).cast("string")).alias("tags"), "event_pos")


def import_report(entries: DataFrame) -> DataFrame:
    """Entries, groups and promoted entries of each import."""
    return built_entries(entries).groupBy("openid").agg(F.count("*").alias("entries"), F.count_distinct("group").alias("groups"), F.count_if("promoted").alias("promoted"))


def nested(standings: DataFrame) -> DataFrame:
    """(openid, standings): back to the arrays of documents, in order."""
    fields = [f.split(":")[0] for f in STANDING[7:-1].replace("array<string>", "array").split(",")]
    row = F.struct("group", "rank", "standing_pos", F.struct(*fields).alias("s"))
    return standings.groupBy("openid").agg(F.transform(F.array_sort(F.collect_list(row)), lambda x: x["s"]).alias("standings"))


def imported_documents(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """``docs`` after an import: category and promotion set (also to null), missing groups appended, standings replaced group by group.

    Documents that are not imported stay as they are; applying it twice changes nothing.
    """
    heads = entries.groupBy("openid").agg(F.min_by(F.struct("category", "promotion"), F.struct("event_pos", "entry_pos")).alias("_head"))
    hit = docs.join(heads.select("openid"), "openid", "left_semi")
    rows = nested(apply_import(flatten.standings(hit), entries.join(docs.select("openid"), "openid", "left_semi"))).withColumnRenamed("standings", "_standings")
    new = missing_groups(flatten.groups(hit), entries)
    group = F.struct("id", "name", F.lit(None).cast("string").alias("drawUrl"), "tags")
    new = new.groupBy("openid").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_pos", "name", group.alias("g")))), lambda x: x["g"]).alias("_groups"))
    out = docs.join(heads, "openid", "left").join(rows, "openid", "left").join(new, "openid", "left")
    there = F.col("_head").isNotNull()
    changed = {
        "category": F.when(there, F.col("_head.category")).otherwise(F.col("category")),
        "promotion": F.when(there, F.col("_head.promotion")).otherwise(F.col("promotion")),
        "standings": F.coalesce("_standings", "standings"),
        "groups": F.when(F.col("_groups").isNull(), F.col("groups")).otherwise(F.concat(F.coalesce("groups", F.array().cast(docs.schema["groups"].dataType)), F.col("_groups").cast(docs.schema["groups"].dataType))),
    }
    return out.select(*(changed.get(c, F.col(c)).alias(c) for c in docs.columns))


def patched(docs: DataFrame, categories: dict[str, str]) -> DataFrame:
    """One-off categories of single documents; the last writer wins."""
    c = F.col("category")
    for openid, category in categories.items():
        c = F.when(F.col("openid") == openid, category).otherwise(c)
    return docs.withColumn("category", c)
