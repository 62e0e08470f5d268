"""Searches, profiles, histories and lists over the indexes."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import base_group, format_date, game_outcome, nz, result_label, split_members
from ..functions.names import TEAM
from ..sources.store import written
from . import flatten, postings

# executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHOWN, PAGE = 60, 150
#: Members of a group from which on its pairs are not listed.
HEAVY = 1000
#: Sets of large groups that a task holds of either side, and rows of them that it compares at a time.
BLOCK, TILE = 16_384, 256
#: Words of 64 large groups up to which sets are split by their groups; sets that a task then holds of either side, and pairs of
#: them that are compared one by one.
WORDS, HELD, LEAF = 8, 65_536, 1 << 18
#: Large groups that are numbered in one task.
NUMBERED = 4096
COLLATION = "zh_Hant"


def tournaments(index: DataFrame, status=None, city=None, year=None, month=None, keyword=None) -> DataFrame:
    """Filters that are given, latest first."""
    start = nz(F.col("dateStart"))
    for wanted, test in ((status, F.col("status") == status), (city, F.col("city") == city), (year, start.startswith(str(year))), (month, F.substring(start, 6, 2) == F.lpad(F.lit(str(month)), 2, "0"))):
        if wanted:
            index = index.where(test)
    if keyword and keyword.strip():
        index = index.where(F.col("name").contains(keyword.strip()))
    return index.orderBy(F.desc("dateStart"), "openid")


def overview(index: DataFrame) -> DataFrame:
    return index.agg(F.count("*").alias("tournaments"), F.max("dateStart").alias("latest"), F.bool_or(F.col("status") == "ongoing").alias("any_ongoing"))


def _named(rows: DataFrame, column: str, query: str) -> DataFrame:
    q = query.strip()
    return rows.where(F.col(column).contains(q) if q else F.lit(False))


def players_with(players: DataFrame, ranks: DataFrame, query: str) -> DataFrame:
    """(name, units, tournaments, ranks) of all names with the text: the first three units by tournament; blank text finds nothing."""
    # a row for each tournament and one for each unit of a name, so that no list has all tournaments of a name
    row = lambda openid, unit, first: F.struct(openid.alias("openid"), unit.alias("unit"), first.alias("first"))
    first = lambda i: F.struct("openid", "units", i.alias("i"))
    none = F.lit(None)
    told = F.concat(F.array(row(F.col("openid"), none.cast("string"), F.when(F.lit(False), first(F.lit(0))))), F.transform("units", lambda u, i: row(none.cast("string"), u, first(i))))
    rows = _named(players, "name", query).select("name", F.inline(told)).groupBy("name", "openid", "unit").agg(F.min("first").alias("first"))
    units = F.slice(F.array_sort(F.collect_list(F.when(F.col("first").isNotNull(), F.struct("first", "unit")))), 1, 3)
    people = rows.groupBy("name").agg(F.array_join(F.transform(units, lambda x: x["unit"]), "、").alias("units"), F.count("openid").alias("tournaments"))
    placed = _named(ranks, "name", query).groupBy("name").agg(F.count("*").alias("ranks"))
    return people.join(placed, "name", "left").withColumn("ranks", F.coalesce("ranks", F.lit(0)))


def units_with(units: DataFrame, query: str) -> DataFrame:
    """(unit, tournaments, players) of all units with the text; blank text finds nothing."""
    hit = _named(units, "unit", query).select("unit", "openid", F.explode_outer("players").alias("p"))
    return hit.groupBy("unit").agg(F.count_distinct("openid").alias("tournaments"), F.count_distinct("p").alias("players"))


def first_shown(found: DataFrame, column: str, shown: int = SHOWN) -> DataFrame:
    """The first rows in collated order."""
    return found.orderBy(F.expr(f"{column} collate {COLLATION}"), column).limit(shown)


def note(found: DataFrame, shown: int = SHOWN) -> DataFrame:
    """One row for the heading and the note below a list: how many are found and shown, and whether there are more."""
    n = found.agg(F.count("*").alias("found"))
    return n.select("found", F.least("found", F.lit(shown)).cast("bigint").alias("shown"), (F.col("found") > shown).alias("more"))


def find_players(players: DataFrame, ranks: DataFrame, query: str, shown: int = SHOWN) -> DataFrame:
    return first_shown(players_with(players, ranks, query), "name", shown)


def find_units(units: DataFrame, query: str, shown: int = SHOWN) -> DataFrame:
    return first_shown(units_with(units, query), "unit", shown)


def toggled(selected: list[str], name: str) -> list[str]:
    """The selected names with ``name`` put in or taken out."""
    return [x for x in selected if x != name] + [name] * (name not in selected)


def _with_dates(rows: DataFrame, index: DataFrame) -> DataFrame:
    named = index.select("openid", F.col("name").alias("tournament"), "dateStart")
    return rows.join(named, "openid", "left").withColumn("tournament", F.coalesce("tournament", "openid")).withColumn("dateStart", nz(F.col("dateStart")))


def player_ranks(ranks: DataFrame, index: DataFrame, name: str) -> DataFrame:
    return _with_dates(ranks.where(F.col("name") == name), index).orderBy(F.desc("dateStart"), "rank", "openid", "group")


def player_history(players: DataFrame, index: DataFrame, name: str) -> DataFrame:
    return _with_dates(players.where(F.col("name") == name), index).orderBy(F.desc("dateStart"), "openid")


def many_units(players: DataFrame) -> DataFrame:
    """Names with more than one unit, which may be different people."""
    return players.select("name", F.explode("units").alias("u")).groupBy("name").agg(F.count_distinct("u").alias("units")).where("units > 1")


def match_log(matches: DataFrame, name: str) -> DataFrame:
    """Matches of a player: the side of the earliest game with the name (A before B), both units, partners, opponents, and the games' scores."""
    games = F.transform(F.coalesce("scoreinfo", F.array()), lambda g: F.struct(split_members(g["memberA"], "display").alias("A"), split_members(g["memberB"], "display").alias("B"), g["scoreA"].alias("sA"), g["scoreB"].alias("sB")))
    rows = matches.withColumn("games", games)
    first = F.get(F.filter("games", lambda g: F.array_contains(g["A"], name) | F.array_contains(g["B"], name)), 0)
    rows = rows.withColumn("first", first).where(F.col("first").isNotNull()).withColumn("side", F.when(F.array_contains("first.A", name), "A").otherwise("B"))
    own = lambda g: F.when(F.col("side") == "A", g["A"]).otherwise(g["B"])
    other = lambda g: F.when(F.col("side") == "A", g["B"]).otherwise(g["A"])
    mine = F.filter("games", lambda g: F.array_contains(own(g), name))
    rows = rows.withColumn("mine", mine)

    def score(g):
        a, b = F.when(F.col("side") == "A", g["sA"]).otherwise(g["sB"]), F.when(F.col("side") == "A", g["sB"]).otherwise(g["sA"])
        return F.struct(nz(a).alias("own"), nz(b).alias("other"), game_outcome(a, b).alias("won"))

    return rows.select(
        "openid", "match_pos", "base_group", nz(F.col("matchtype")).alias("matchtype"), format_date(F.col("date")).alias("date"), nz(F.col("time")).alias("time"), "side",
        nz(F.when(F.col("side") == "A", F.col("teamA")).otherwise(F.col("teamB"))).alias("own_unit"), nz(F.when(F.col("side") == "A", F.col("teamB")).otherwise(F.col("teamA"))).alias("other_unit"),
        (nz(F.col("HeadGroup")) == TEAM).alias("team"), nz(F.col("abstain")).alias("abstain"), result_label(F.col("winner"), F.col("side")).alias("result"),
        F.array_distinct(F.filter(F.flatten(F.transform("mine", own)), lambda x: x != name)).alias("partners"),
        F.array_distinct(F.flatten(F.transform("mine", other))).alias("opponents"),
        F.transform("mine", score).alias("scores"),
    )


def _masks(crowd: DataFrame, large: DataFrame, groups: int) -> DataFrame:
    """(member, mask, fold): the large groups of each member as bits, an array of (word, bits) in order, and all its words in one; each group has one bit of a word."""
    parts = max(1, -(-groups // NUMBERED))
    numbered = large.select("group", F.pmod(F.xxhash64("group"), F.lit(parts)).cast("int").alias("part"))
    at = F.row_number().over(Window.partitionBy("part").orderBy("group")) - 1
    numbered = numbered.select("group", (at % 64).alias("bit"), (F.floor(at / 64).cast("int") * parts + F.col("part")).alias("word"))
    words = crowd.join(numbered, "group").groupBy("member", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
    return words.groupBy("member").agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("mask"), F.bit_or("bits").alias("fold"))


def _met(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """(set, n): how many members of ``right`` share a group with each set of ``left``; both have set, members, word and bits."""
    left_sets, left_at = np.unique(left["set"].to_numpy(), return_inverse=True)
    right_sets, first, right_at = np.unique(right["set"].to_numpy(), return_index=True, return_inverse=True)
    members = right["members"].to_numpy()[first].astype(np.float64)
    sides = [(at, df["word"].to_numpy(), df["bits"].to_numpy()) for at, df in ((left_at, left), (right_at, right))]
    words = np.intersect1d(sides[0][1], sides[1][1])
    (la, lb), (ra, rb) = ([{w: x[word == w] for w in words} for x in (at, bits)] for at, word, bits in sides)
    n = np.zeros(len(left_sets))
    for start in range(0, len(left_sets), TILE):
        meet = np.zeros((min(TILE, len(left_sets) - start), len(right_sets)), bool)
        for w in words:
            mine = (la[w] >= start) & (la[w] < start + TILE)
            meet[np.ix_(la[w][mine] - start, ra[w])] |= (lb[w][mine][:, None] & rb[w][None, :]) != 0
        n[start : start + TILE] = meet @ members
    return pd.DataFrame({"set": left_sets, "n": n.astype(np.int64)})


def _split(x: np.ndarray, y: np.ndarray, may: np.ndarray) -> tuple[int, np.uint64]:
    """Word and bit, of those in ``may``, that most pairs of a sample of both sides have."""
    one, bits = np.uint64(1), np.arange(64, dtype=np.uint64)
    best = (-1, 0, bits[0])
    for w in np.flatnonzero(may).tolist():
        shares = [((rows[:: max(1, len(rows) // 256), w, None] >> bits) & one).mean(axis=0) for rows in (x, y)]
        both = np.where((may[w] >> bits) & one == one, shares[0] * shares[1], -1)
        best = max(best, (both.max(), w, bits[both.argmax()]), key=lambda found: found[0])
    return best[1], best[2]


def _meetings(x: np.ndarray, y: np.ndarray, x_members: np.ndarray, y_members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many members of ``y`` share a bit with each row of ``x``, and the other way round.

    Both sides are split by a group: pairs that both have it meet and are not looked at again, nor are those without a common group.
    """
    one = np.uint64(1)
    n, m = np.zeros(len(x)), np.zeros(len(y))
    waiting = [(np.arange(len(x)), np.arange(len(y)))]
    while waiting:
        i, j = waiting.pop()
        a, b = x[i], y[j]
        may = np.bitwise_or.reduce(a, axis=0) & np.bitwise_or.reduce(b, axis=0)
        if not may.any():
            continue
        if (np.bitwise_and.reduce(a, axis=0) & np.bitwise_and.reduce(b, axis=0)).any():
            n[i] += y_members[j].sum()
            m[j] += x_members[i].sum()
        elif len(i) * len(j) <= LEAF:
            meet = np.zeros((len(i), len(j)), bool)
            for w in np.flatnonzero(may).tolist():
                meet |= (a[:, None, w] & b[None, :, w]) != 0
            meet = meet.astype(np.float64)
            n[i] += meet @ y_members[j]
            m[j] += x_members[i] @ meet
        else:
            w, bit = _split(a, b, may)
            own, other = (a[:, w] >> bit) & one == one, (b[:, w] >> bit) & one == one
            n[i[own]] += y_members[j[other]].sum()
            m[j[other]] += x_members[i[own]].sum()
            waiting += [(p, q) for p, q in ((i[own], j[~other]), (i[~own], j[other]), (i[~own], j[~other])) if len(p) and len(q)]
    return n, m


def _met_split(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """(set, n) of the sets of both sides, each counted on the other one; of ``left`` only where both are the same block."""
    sides = []
    words, at = np.unique(np.concatenate([left["word"], right["word"]]), return_inverse=True)
    for rows, place in ((left, at[: len(left)]), (right, at[len(left) :])):
        sets, first, own = np.unique(rows["set"].to_numpy(), return_index=True, return_inverse=True)
        bits = np.zeros((len(sets), len(words)), np.uint64)
        bits[own, place] = rows["bits"].to_numpy().view(np.uint64)
        sides.append((sets, bits, rows["members"].to_numpy()[first].astype(np.float64)))
    (sets, x, x_members), (others, y, y_members) = sides
    if not len(sets) or not len(others):
        return pd.DataFrame({"set": np.zeros(0, np.int64), "n": np.zeros(0, np.int64)})
    n, m = _meetings(x, y, x_members, y_members)
    if left["i"].iloc[0] != left["j"].iloc[0]:
        sets, n = np.concatenate([sets, others]), np.concatenate([n, m])
    return pd.DataFrame({"set": sets, "n": n.astype(np.int64)})


def _united(sets: DataFrame, words: int) -> DataFrame:
    """(set, n): how many members share a large group with each set of (set, mask, members), itself included; blocks of sets meet pair by pair.

    Sets of few words are put into blocks in the order of their bits, so that many pairs of blocks, or of their parts, meet as a whole.
    """
    total = sets.count()
    if words <= WORDS:
        blocks = max(1, -(-total // HELD))
        # written, so that both sides of a pair see the same blocks
        sets = written(sets.repartitionByRange(blocks, "mask").withColumn("own", F.spark_partition_id()), "blocks")
        rows = sets.select("set", "members", "own", F.inline("mask"))
        pairs = min(2000, blocks * (blocks + 1) // 2)
        left = rows.withColumnRenamed("own", "i").withColumn("j", F.explode(F.sequence("i", F.lit(blocks - 1))))
        right = rows.withColumnRenamed("own", "j").withColumn("i", F.explode(F.sequence(F.lit(0), "j")))
        left, right = (side.repartition(pairs, "i", "j").groupBy("i", "j") for side in (left, right))
        return left.cogroup(right).applyInPandas(lambda a, b: _met_split(a, b), "set long, n long").groupBy("set").agg(F.sum("n").alias("n"))
    blocks = max(2, -(-total // BLOCK))
    rows = sets.select("set", "members", F.pmod(F.xxhash64("set"), F.lit(blocks)).cast("int").alias("own"), F.inline("mask"))
    every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = rows.withColumnRenamed("own", "i").withColumn("j", every).groupBy("i", "j")
    right = rows.withColumnRenamed("own", "j").withColumn("i", every).groupBy("i", "j")
    return left.cogroup(right).applyInPandas(lambda a, b: _met(a, b), "set long, n long").groupBy("set").agg(F.sum("n").alias("n"))


def partner_counts(members: DataFrame, group: str, member: str, heavy: int = HEAVY) -> DataFrame:
    """(member, partners): how many others are in any group with a member, whose ids are whole numbers; members without others have no row.

    Groups of up to ``heavy`` members list their pairs, those left out that also meet in a larger group: each row carries the
    larger groups of its member as bits.  Partners in larger groups are counted once for each distinct set of such groups, by
    the bits of all such sets, so that pairs of members are never made; blocks of sets bound the memory of a task.
    Rows may repeat; those with a null group or member are left out.
    """
    rows = members.select(F.col(group).alias("group"), F.col(member).cast("long").alias("member")).where("group is not null and member is not null").distinct()
    rows = written(rows, "members")
    large = written(rows.groupBy("group").agg(F.count("*").alias("n")).where(F.col("n") > heavy).select("group"), "large")
    groups = large.count()
    words = -(-groups // 64)
    masks = written(_masks(rows.join(large, "group", "left_semi"), large, groups), "masks")
    # a group of one has no pairs; where all large groups are bits of one word, its bits tell whether two members meet there
    bits = masks.select("member", "fold", *(["mask"] if words > 1 else []))
    small = rows.join(large, "group", "left_anti").join(bits, "member", "left").select("group", *bits.columns)
    other = small.select("group", *(F.col(c).alias(f"other_{c}") for c in bits.columns))
    meet = F.col("fold").bitwiseAND(F.col("other_fold")) != 0
    if words > 1:
        shared = lambda a: F.exists("other_mask", lambda b: (a["word"] == b["word"]) & (a["bits"].bitwiseAND(b["bits"]) != 0))
        meet = meet & F.exists("mask", shared)
    light = small.join(other, "group").where((F.col("member") < F.col("other_member")) & ~F.coalesce(meet, F.lit(False)))
    light = light.select("member", "other_member").distinct()
    alone = light.select(F.explode(F.array("member", "other_member")).alias("member")).groupBy("member").agg(F.count("*").alias("n"))
    sets = written(masks.groupBy("mask").agg(F.count("*").alias("members")).withColumn("set", F.monotonically_increasing_id()), "sets")
    met = masks.join(sets.join(_united(sets, words), "set").select("mask", "n"), "mask").select("member", (F.col("n") - 1).alias("n"))
    return alone.unionByName(met).groupBy("member").agg(F.sum("n").alias("partners")).withColumnRenamed("member", member)


def player_profile(tables: dict[str, DataFrame], matches: DataFrame, name: str) -> dict[str, DataFrame]:
    """What the page of a player shows: units (more than one may be different people), ranks, history, and the log of all matches."""
    own = tables["players"].where(F.col("name") == name)
    units = own.select(F.explode("units").alias("unit")).distinct().orderBy("unit")
    return {"units": units, "ranks": player_ranks(tables["ranks"], tables["index"], name), "history": player_history(tables["players"], tables["index"], name), "log": match_log(matches, name)}


def tournament_detail(docs: DataFrame, openid: str, group: str | None = None, keyword: str | None = None, shown: int = PAGE) -> dict[str, DataFrame]:
    """What the page of a tournament shows: panels, documents, standings in order, and matches by group and keyword."""
    one = docs.where(F.col("openid") == openid)
    rows = flatten.matches(one)
    return {
        "panels": panels(one),
        "documents": flatten.documents(one).orderBy("document_pos"),
        "groups": flatten.groups(one).orderBy("group_pos"),
        "standings": flatten.standings(one).orderBy("group", "rank", "standing_pos"),
        "matches": filtered_matches(rows, group, keyword, shown),
        "match_groups": rows.select("base_group").distinct().orderBy("base_group"),
    }


def filtered_matches(matches: DataFrame, group: str | None = None, keyword: str | None = None, shown: int = PAGE) -> DataFrame:
    """One page of matches by base group and keyword in teams or members."""
    if group:
        matches = matches.where(base_group(F.col("groupName")) == group)
    if keyword and (k := keyword.strip()):
        members = F.exists(F.coalesce("scoreinfo", F.array()), lambda g: nz(g["memberA"]).contains(k) | nz(g["memberB"]).contains(k))
        matches = matches.where(nz(F.col("teamA")).contains(k) | nz(F.col("teamB")).contains(k) | members)
    return matches.orderBy("openid", "match_pos").limit(shown)


def variants(units: DataFrame, focus: str | None = None) -> DataFrame:
    """(focus, unit): other unit names that contain the focus, or, of two characters at least, are contained in it.

    All pairs of a unit table come from an equi join on the rarest bigram of the shorter name (or its one character), then the exact test.
    """
    names = units.select("unit").distinct()
    if focus is not None:
        inside = F.lit(focus).contains(F.col("unit")) if len(focus) >= 2 else F.lit(False)
        return names.where((F.col("unit") != focus) & (F.col("unit").contains(focus) | inside)).select(F.lit(focus).alias("focus"), "unit")
    pairs = postings.containing(names, "unit", names, "unit").where("text <> name")
    containing = pairs.select(F.col("text").alias("focus"), F.col("name").alias("unit"))
    contained = pairs.where(F.char_length("name") >= 2).select(F.col("name").alias("focus"), F.col("text").alias("unit"))
    return containing.unionByName(contained)


def unit_view(units: DataFrame, unit_ranks: DataFrame, index: DataFrame, selected: list[str]) -> tuple[DataFrame, DataFrame]:
    """Ranks, and history with merged players, of a set of unit names."""
    placed = _with_dates(unit_ranks.where(F.col("unit").isin(selected)), index).orderBy(F.desc("dateStart"), "rank", "openid", "group", "unit")
    rows = units.where(F.col("unit").isin(selected)).groupBy("openid").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("players")))).alias("players"), F.array_sort(F.collect_set("unit")).alias("units"))
    return placed, _with_dates(rows, index).orderBy(F.desc("dateStart"), "openid")


def cities(index: DataFrame) -> DataFrame:
    return index.select("city").distinct().orderBy("city")


def years(index: DataFrame) -> DataFrame:
    return index.select(F.substring(nz(F.col("dateStart")), 1, 4).alias("year")).where("year <> ''").distinct().orderBy(F.desc("year"))


def group_pages(rows: DataFrame, keys: list[str], order: list[str], page: int, size: int = PAGE) -> DataFrame:
    """Page ``page`` (from 1) of each key."""
    at = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_at", at).where((F.col("_at") > (page - 1) * size) & (F.col("_at") <= page * size)).drop("_at")



def panels(docs: DataFrame) -> DataFrame:
    """What the page of a tournament shows beside its lists."""
    none = F.lit(False)
    standing = lambda test: F.coalesce(F.exists("standings", test), none)
    return docs.select(
        "openid",
        ((F.col("category") == "排名賽") & (nz(F.col("promotion")) != "")).eqNullSafe(True).alias("promotion_panel"),
        standing(lambda s: F.coalesce(s["promoted"], none)).alias("any_promoted"),
        standing(lambda s: s["source"] == "pdf").alias("from_official"),
        (F.coalesce(F.size("matches"), F.lit(0)) == 0).alias("no_matches"),
        ((F.col("status") == "registering") & ~nz(F.col("registerEnd")).isin("", "0000-00-00")).alias("deadline"),
        ((F.col("status") == "registering") & F.coalesce("isSystem", none)).alias("sign_up"),
    )
