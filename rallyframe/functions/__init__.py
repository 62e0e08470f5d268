"""Column functions of the tournament domain; all are built from Catalyst expressions."""

from .labels import (
    display_members,
    display_unit,
    encode_component,
    escape_html,
    format_date,
    format_range,
    game_outcome,
    link,
    origin,
    rank_class,
    rank_label,
    result_label,
    score_text,
    status_label,
    type_icon,
)
from .names import (
    base_group,
    category_of,
    classify_document,
    entry_key,
    event_tag,
    grade_tag,
    group_tags,
    is_promoted,
    let,
    level_tag,
    member_units,
    nz,
    safe_int,
    side_members,
    split_members,
    truthy,
    unit_text,
    utrim,
)

__all__ = [n for n in dir() if not n.startswith("_")]
