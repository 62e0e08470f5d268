"""Texts that are shown: dates, statuses, ranks, scores, links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import REGULATION, RESULT, TEAM, nz, split_members

NO_DATE = "0000-00-00"
DASH = "—"
# Labels of statuses and of the first ranks.
STATUSES = {"registering": "報名中", "ongoing": "進行中", "finished": "已結束"}
RANKS = {1: "冠軍", 2: "亞軍", 3: "季軍", 4: "殿軍"}


def format_date(c: Column) -> Column:
    return F.when(nz(c).isin("", NO_DATE), "").otherwise(F.replace(c, F.lit("-"), F.lit("/")))


def format_range(start: Column, end: Column) -> Column:
    """A dash if both are missing, one date if the end is missing or equal, else both; a missing start leaves its side empty."""
    a, b = format_date(start), format_date(end)
    return F.when((a == "") & (b == ""), DASH).when((b == "") | (a == b), a).otherwise(F.concat(a, F.lit(" ~ "), b))


def status_label(c: Column) -> Column:
    out = None
    for k, v in STATUSES.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(c)


def rank_label(rank: Column) -> Column:
    out = None
    for k, v in RANKS.items():
        out = F.when(rank == k, v) if out is None else out.when(rank == k, v)
    return out.otherwise(F.concat(F.lit("第"), rank.cast("string"), F.lit("名")))


def rank_class(rank: Column) -> Column:
    return F.when(rank <= 3, F.concat(F.lit("rank-"), rank.cast("string"))).otherwise("")


def escape_html(c: Column) -> Column:
    out = nz(c)
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        out = F.replace(out, F.lit(raw), F.lit(safe))
    return out


def encode_component(c: Column) -> Column:
    """Percent-encoding that leaves ``!'()~`` and encodes a space as %20."""
    out = F.replace(F.url_encode(nz(c)), F.lit("+"), F.lit("%20"))
    for code, raw in (("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(code), F.lit(raw))
    return out


def _number(c: Column) -> Column:
    """A missing or unreadable score is no number; the empty text is zero."""
    return F.when(c == "", F.lit(0.0)).otherwise(c.try_cast("double"))


def game_outcome(own: Column, other: Column) -> Column:
    """Whether the own score is the larger number; false where either is none."""
    return F.coalesce(_number(own) > _number(other), F.lit(False))


def result_label(winner: Column, side: Column) -> Column:
    return F.when(~nz(winner).isin("A", "B"), DASH).when(winner == side, "勝").otherwise("負")


def score_text(head: Column, own: Column, other: Column, games: Column) -> Column:
    """Team matches show both totals apart; others show them close, or a dash without games."""
    team = F.concat(nz(own), F.lit(" : "), nz(other))
    return F.when(head == TEAM, team).when(F.coalesce(F.size(games), F.lit(0)) > 0, F.concat(nz(own), F.lit(":"), nz(other))).otherwise(DASH)


def display_members(members: Column) -> Column:
    return F.flatten(F.transform(F.coalesce(members, F.array().cast("array<string>")), lambda x: split_members(x, "display")))


def display_unit(units: Column, unit: Column) -> Column:
    """Distinct units of the members, else the unit, else a dash."""
    each = F.filter(F.array_distinct(F.coalesce(units, F.array().cast("array<string>"))), lambda x: x != "")
    return F.when(F.size(each) > 0, F.array_join(each, "、")).when(nz(unit) != "", unit).otherwise(DASH)


def type_icon(kind: Column) -> Column:
    return F.when(kind == REGULATION, "📋").when(kind == RESULT, "🏆").otherwise("📄")


def link(base: str, **parameters: Column) -> Column:
    """A url with encoded parameters, in the order given; null parameters are left out."""
    pairs = [F.concat(F.lit(f"{k}="), encode_component(v)) for k, v in parameters.items()]
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *(F.when(v.isNotNull(), p) for v, p in zip(parameters.values(), pairs))))


def origin(url: Column) -> Column:
    """Scheme and host of a url, without what follows; null if it has none."""
    return F.nullif(F.regexp_extract(url, "^(https?://[^/]+)", 1), F.lit(""))
