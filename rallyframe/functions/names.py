"""Names of groups, members, units and documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Terms that group names, tournament names and document titles are searched for.
LEVELS = "國小|國中|高中|大專|高國中|幼兒園|幼稚園"
OPEN_LEVEL = "歲|社會|公開|常青|長青"
GRADES = "低年級|中年級|高年級|[一二三四五六]年級|幼幼|大班|中班"
EVENTS = (("親子", "親子"), ("夫妻|夫婦", "夫妻"), ("混合雙打|混雙|男女混雙|混合", "混雙"), ("男(子)?雙|男子雙打", "男雙"), ("女(子)?雙|女子雙打", "女雙"), ("男(子)?單|男子單打", "男單"), ("女(子)?單|女子單打", "女單"))
TEAM, DOUBLES, SINGLES = "團體", "雙打", "單打"
RANKING, CHAMPIONSHIP = "排名賽", "錦標賽"
REGULATION, RESULT, OTHER_DOCUMENT = "規程", "成績", "其他"
REGULATION_TITLES = "規程|簡章|章程|競賽辦法"
OTHER_SPORTS = "匹克球|桌球|研習|裁判|柔道"
UNIT_JOINER = "／"
# Separators of member names, as the index and the match display split them.
SEPARATORS = {"index": "-、,", "display": "-、,，"}  # and the slash


def let(value: Column, use) -> Column:
    """``use`` of ``value``, which is made once, however often it is used: Spark makes a column anew at each use inside a lambda."""
    return F.get(F.transform(F.array(value), use), 0)


def nz(c: Column) -> Column:
    """Null strings become empty."""
    return F.coalesce(c, F.lit(""))


def truthy(c: Column) -> Column:
    """Neither null nor empty."""
    return nz(c) != ""


def utrim(c: Column) -> Column:
    """Trim of Unicode white space; ``trim`` knows the ASCII space only."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def base_group(c: Column) -> Column:
    """A group name without one trailing bracketed suffix; null gives empty."""
    return utrim(F.regexp_replace(nz(c), r"(?U)\[[^\]]*\]\s*$", ""))


def split_members(c: Column, flavour: str = "index") -> Column:
    """Array of single names; the display also splits at the full-width comma."""
    # one separator for all: Java compiles a pattern of several at each call
    same = F.translate(nz(c), SEPARATORS[flavour], "/" * len(SEPARATORS[flavour]))
    return F.filter(F.transform(F.split(same, "/"), utrim), lambda x: x != "")


def category_of(name: Column) -> Column:
    return F.when(name.contains(RANKING), RANKING).when(name.contains(CHAMPIONSHIP), CHAMPIONSHIP)


def _first(c: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(nz(c), pattern, 0), F.lit(""))


def level_tag(name: Column) -> Column:
    return F.coalesce(_first(name, LEVELS), F.when(name.rlike(OPEN_LEVEL), "社會"))


def grade_tag(name: Column) -> Column:
    return _first(name, GRADES)


def event_tag(name: Column, head: Column) -> Column:
    """The first event whose terms the name has; a team head overrides all."""
    chain = F.when(nz(head) == TEAM, TEAM)
    for pattern, event in EVENTS:
        chain = chain.when(name.rlike(pattern), event)
    for event in (TEAM, DOUBLES, SINGLES):
        chain = chain.when(name.contains(event), event)
    return chain.when(head.isin(SINGLES, DOUBLES), head)


def group_tags(name: Column, head: Column) -> Column:
    """Struct of level, grade, event and head; what cannot be told is null."""
    return F.struct(level_tag(name).alias("level"), grade_tag(name).alias("grade"), event_tag(name, head).alias("event"), F.nullif(head, F.lit("")).alias("head"))


def classify_document(title: Column, link: Column) -> Column:
    """Regulation terms decide before result terms."""
    text = F.concat(nz(title), F.lit(" "), nz(link))
    return F.when(text.rlike(REGULATION_TITLES), REGULATION).when(text.contains(RESULT), RESULT).otherwise(OTHER_DOCUMENT)


def is_promoted(category: Column, group: Column, rank: Column) -> Column:
    """In ranking tournaments, second-division singles up to rank 4 and doubles up to rank 3; by rank value, so ties count."""
    place = F.when(group.endswith(SINGLES), rank <= 4).when(group.endswith(DOUBLES), rank <= 3)
    return F.coalesce((category == RANKING) & group.startswith("乙組") & place, F.lit(False))


def unit_text(units: Column) -> Column:
    """Distinct units in the order of first occurrence, joined."""
    return F.array_join(F.array_distinct(units), UNIT_JOINER)


def member_units(units: Column) -> Column:
    """The units member by member, where they differ; else null."""
    return F.when(F.size(F.array_distinct(units)) > 1, units)


def side_members(games: Column, side: str) -> Column:
    """Distinct trimmed member texts of a side in the order of games; not split into names."""
    raw = F.transform(F.coalesce(games, F.array()), lambda g: utrim(nz(g[f"member{side}"])))
    return F.array_distinct(F.filter(raw, lambda x: x != ""))


def entry_key(unit: Column, members: Column) -> Column:
    return F.concat(nz(unit), F.lit("|"), F.array_join(members, "/"))


def safe_int(c: Column) -> Column:
    """An integer, or null where the text is none; null and empty count as zero."""
    text = F.when(truthy(c), utrim(c)).otherwise("0")
    return F.when(text.rlike(r"^[+-]?[0-9]+$"), text.try_cast("bigint"))
