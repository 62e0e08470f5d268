"""Scalar functions on literal rows."""

import pytest
from pyspark.sql import functions as F

from rallyframe.functions import (
    base_group, category_of, classify_document, display_members, display_unit, encode_component, escape_html, format_range, game_outcome, group_tags,
    is_promoted, member_units, rank_label, result_label, safe_int, score_text, split_members, status_label, unit_text, utrim,
)


def one(spark, value):
    return spark.range(1).select(value.alias("x")).first().x


@pytest.mark.parametrize("text, want", [("g[1]", "g"), ("g[1] ", "g"), ("g[1]　", "g"), ("g[a][b]", "g[a]"), ("[1]", ""), (None, "")])
def test_base_group(spark, text, want):
    assert one(spark, base_group(F.lit(text).cast("string"))) == want


@pytest.mark.parametrize("text, index, display", [("甲/乙", 2, 2), ("甲-乙", 2, 2), ("甲、乙", 2, 2), ("甲,乙", 2, 2), ("甲，乙", 1, 2), (" 甲 /  ", 1, 1), (None, 0, 0)])
def test_split_members(spark, text, index, display):
    assert len(one(spark, split_members(F.lit(text).cast("string")))) == index
    assert len(one(spark, split_members(F.lit(text).cast("string"), "display"))) == display


@pytest.mark.parametrize(
    "name, head, want",
    [("國小五、六年級男子單打", None, ("國小", "六年級", "男單")), ("父母子女雙打組", None, (None, None, "女雙")), ("社會男女混雙", None, ("社會", None, "混雙")), ("公開組", "團體", ("社會", None, "團體")), ("甲組", "雙打", (None, None, "雙打")), ("高男團", None, (None, None, None))],
)
def test_group_tags(spark, name, head, want):
    got = one(spark, group_tags(F.lit(name), F.lit(head).cast("string")))
    assert (got.level, got.grade, got.event) == want


def test_promotion_counts_by_rank_value(spark):
    f = lambda *a: one(spark, is_promoted(*map(F.lit, a)))
    assert f("排名賽", "乙組男子單打", 4) and not f("排名賽", "乙組男子單打", 5)
    assert f("排名賽", "乙組女子雙打", 3) and not f("排名賽", "乙組女子雙打", 4)
    assert not f("錦標賽", "乙組男子單打", 1) and not f("排名賽", "甲組男子單打", 1)


def test_classification_and_category(spark):
    assert one(spark, classify_document(F.lit("競賽規程與成績"), F.lit("u"))) == "規程"
    assert one(spark, classify_document(F.lit("成績總表"), F.lit(None).cast("string"))) == "成績"
    assert one(spark, classify_document(F.lit(None).cast("string"), F.lit("x"))) == "其他"
    assert one(spark, category_of(F.lit("全國排名賽錦標賽"))) == "排名賽"


def test_units(spark):
    units = F.array(F.lit("a"), F.lit("b"), F.lit("a"))
    assert one(spark, unit_text(units)) == "a／b" and one(spark, member_units(units)) == ["a", "b", "a"]
    assert one(spark, member_units(F.array(F.lit("a"), F.lit("a")))) is None
    assert one(spark, display_unit(units, F.lit("z"))) == "a、b" and one(spark, display_unit(F.lit(None).cast("array<string>"), F.lit(""))) == "—"


@pytest.mark.parametrize("a, b, want", [("0000-00-00", "", "—"), ("2025-01-02", "2025-01-02", "2025/01/02"), ("2025-01-02", "2025-01-03", "2025/01/02 ~ 2025/01/03"), ("2025-01-02", "", "2025/01/02"), ("", "2025-01-03", " ~ 2025/01/03")])
def test_ranges(spark, a, b, want):
    assert one(spark, format_range(F.lit(a), F.lit(b))) == want


def test_scores(spark):
    f = lambda a, b: one(spark, game_outcome(F.lit(a).cast("string"), F.lit(b).cast("string")))
    assert f("21", "9") and not f("9", "21") and not f("棄", "3") and not f("5", None) and f("1", "")
    assert one(spark, safe_int(F.lit(" 5 "))) == 5 and one(spark, safe_int(F.lit("棄"))) is None and one(spark, safe_int(F.lit(""))) == 0
    assert one(spark, result_label(F.lit(""), F.lit("A"))) == "—" and one(spark, result_label(F.lit("A"), F.lit("A"))) == "勝"
    games = F.array(F.struct(F.lit(1).alias("g")))
    assert one(spark, score_text(F.lit("團體"), F.lit("3"), F.lit("2"), games)) == "3 : 2" and one(spark, score_text(F.lit("單打"), F.lit("3"), F.lit("2"), games)) == "3:2"


def test_texts(spark):
    assert one(spark, escape_html(F.lit("<a&'\">"))) == "&lt;a&amp;&#39;&quot;&gt;"
    assert one(spark, encode_component(F.lit("a b(1)~!'"))) == "a%20b(1)~!'"
    assert one(spark, utrim(F.lit("　x　 "))) == "x"
    assert one(spark, rank_label(F.lit(1))) == "冠軍" and one(spark, rank_label(F.lit(7))) == "第7名" and one(spark, status_label(F.lit("ongoing"))) == "進行中"
    assert one(spark, display_members(F.array(F.lit("a，b"), F.lit("c")))) == ["a", "b", "c"]
