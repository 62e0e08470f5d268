"""Documents to flat tables; positions of lists are kept, because order decides ties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import base_group, let, nz, side_members, split_members


def tournaments(docs: DataFrame) -> DataFrame:
    return docs.drop("groups", "matches", "standings", "documents")


def matches(docs: DataFrame) -> DataFrame:
    rows = docs.select("openid", F.posexplode("matches").alias("match_pos", "m")).select("openid", "match_pos", "m.*")
    return rows.withColumn("base_group", base_group(F.col("groupName")))


def games(docs: DataFrame) -> DataFrame:
    return matches(docs).select("openid", "match_pos", "base_group", "winner", F.posexplode("scoreinfo").alias("game_pos", "g")).select("openid", "match_pos", "base_group", "winner", "game_pos", "g.*")


def groups(docs: DataFrame) -> DataFrame:
    return docs.select("openid", F.posexplode("groups").alias("group_pos", "g")).select("openid", "group_pos", "g.*")


def standings(docs: DataFrame) -> DataFrame:
    rows = docs.select("openid", F.posexplode("standings").alias("standing_pos", "s")).select("openid", "standing_pos", "s.*")
    return rows.withColumn("promoted", F.coalesce("promoted", F.lit(False)))


def documents(docs: DataFrame) -> DataFrame:
    return docs.select("openid", F.posexplode("documents").alias("document_pos", "d")).select("openid", "document_pos", "d.*")


def sides(matches_: DataFrame) -> DataFrame:
    """Two rows a match, A before B."""
    both = F.array(
        *(
            F.struct(F.lit(k).alias("side_pos"), F.lit(s).alias("side"), nz(F.col(f"team{s}")).alias("unit"), side_members(F.col("scoreinfo"), s).alias("members"), F.col(f"{s}sidescore").alias("own"), F.col(f"{o}sidescore").alias("other"))
            for k, (s, o) in enumerate((("A", "B"), ("B", "A")))
        )
    )
    return matches_.select("openid", "match_pos", "base_group", "matchtype", "winner", F.inline(both))


def listed(column: str) -> Column:
    """The list of a document; a missing one is empty."""
    return F.coalesce(F.col(column), F.array())


def _own_unit(units: Column, unit: Column, pos: Column) -> Column:
    """A member has its own unit by position; only a missing position takes the row's."""
    return F.when(F.coalesce(F.size(units), F.lit(0)) > pos, nz(F.get(units, pos))).otherwise(nz(unit))


def names() -> Column:
    """Array of (name, unit, group) inside a document's row: each name of each side of each game, and of each standing."""
    told = lambda texts, unit, group: F.transform(split_members(texts), lambda n: F.struct(n.alias("name"), unit.alias("unit"), group.alias("group")))

    def match(m):
        games = lambda group: F.flatten(F.transform(F.coalesce(m["scoreinfo"], F.array()), lambda g: F.concat(*(told(g[f"member{s}"], nz(m[f"team{s}"]), group) for s in "AB"))))
        return let(base_group(m["groupName"]), games)

    def standing(s):
        return F.flatten(F.transform(F.coalesce(s["members"], F.array()), lambda x, i: told(x, _own_unit(s["memberUnits"], s["unit"], i), s["group"])))

    return F.concat(F.flatten(F.transform(listed("matches"), match)), F.flatten(F.transform(listed("standings"), standing)))


def match_names(docs: DataFrame) -> DataFrame:
    """(openid, name, unit, group): each name of each side of each game."""
    rows = matches(docs).select("openid", "base_group", "teamA", "teamB", F.explode("scoreinfo").alias("g"))
    both = F.array(*(F.struct(nz(F.col(f"team{s}")).alias("unit"), split_members(F.col(f"g.member{s}")).alias("names")) for s in "AB"))
    return rows.select("openid", F.col("base_group").alias("group"), F.inline(both)).select("openid", F.explode("names").alias("name"), "unit", "group")


def standing_names(docs: DataFrame) -> DataFrame:
    """(openid, name, unit, group, rank): a member has its own unit by position; only a missing position takes the row's."""
    rows = standings(docs).select("openid", "standing_pos", "group", "rank", "unit", "memberUnits", F.posexplode("members").alias("pos", "member"))
    at = _own_unit(F.col("memberUnits"), F.col("unit"), F.col("pos"))
    return rows.select("openid", "standing_pos", F.explode(split_members(F.col("member"))).alias("name"), at.alias("unit"), "group", "rank")
