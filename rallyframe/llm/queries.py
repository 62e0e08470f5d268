"""One query per operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers

from . import chat, count_join, decontaminate, hard_negatives, language_id, licences, near_dedup, neighbours, packing, pii, substring_dedup, time_encoding, url_filter
from .common import table

#: The tokenizer's file; a parameter of ``packing.pack``.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_urls(spark, sf_dir):
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op2_neighbours(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op3_pii(spark, sf_dir):
    return pii.find_spans(table(spark, sf_dir, "documents"), ["doc_id"])


def op4_decontaminate(spark, sf_dir):
    return decontaminate.digest(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_pack(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER)


def op6_language(spark, sf_dir):
    return language_id.identify(table(spark, sf_dir, "documents"))


def op7_chat(spark, sf_dir):
    return chat.render(table(spark, sf_dir, "conversations"))


def op8_licences(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


def op9_near_dedup(spark, sf_dir):
    return near_dedup.components(table(spark, sf_dir, "documents"))


def op10_substrings(spark, sf_dir):
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op11_time_encoding(spark, sf_dir):
    return time_encoding.encode(*(table(spark, sf_dir, name) for name in ("sale_lines", "sales", "items", "vendors", "clients")))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_count_join(spark, sf_dir):
    return count_join.join(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_urls, op2_neighbours, op3_pii, op4_decontaminate, op5_pack, op6_language, op7_chat, op8_licences, op9_near_dedup, op10_substrings, op11_time_encoding, op12_hard_negatives, op13_count_join)}

ORACLE_SQL = {"op7_chat": chat.ORACLE, "op4_decontaminate": decontaminate.ORACLE, "op9_near_dedup": near_dedup.ORACLE, "op10_substrings": substring_dedup.ORACLE, "op11_time_encoding": time_encoding.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE, "op13_count_join": count_join.ORACLE}
