"""Licence scans: a trained paragraph classifier, confirmed by comparison with templates; built-in functions alone.

Paragraphs are the blocks of a text between blank lines, and, in blocks of several lines, its lines too, for a notice may
be a line of a longer block or be wrapped over several.  The distinct word 1- and 2-grams of a paragraph are hashed, sparse
multinomial logistic regression gives each family a probability, calibrated by a temperature, and the best family
stands if it is not ``other``, reaches ``LEAST``, and the paragraph holds a template of the family: a template of up to ``SHORT_TEMPLATE``
words, which are the words that tell the family from others, in one piece, and a longer one with ``COVERED`` of its pairs of
neighbouring words.  So words in another order, or the notice of a licence with another name, confirm nothing.
All others are of the unknown class.  Weights come from ``labelled_paragraphs()``, a small table of fixed size.

A paragraph without any of ``MARKS`` can have no template confirmed: each template has more pairs with a marked word than it may
lack (``proved`` tells).  Such paragraphs are of the unknown class without being scored.
"""

from __future__ import annotations

import re
import zlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import linear
from .common import column

SLOTS = 2048
LEAST, COVERED, SHORT_TEMPLATE = 0.5, 0.8, 7
UNKNOWN, OTHER = "unknown", "other"
#: Texts of which every confirmed paragraph has one, in lower case, and such that are words of their own.
MARKS = ("licen", "gpl", "apache", "creative", "domain", "proprietary", "reserved", "permission", "hereby", "granted", "obtaining", "redistribut", "modification", "permitted", "unencumbered", "bsd")
SHORT = ("cc", "cc0", "mpl")

#: Names and notices of the licence families, in lower case without punctuation.
TEMPLATES = {
    "apache": ("apache license version 2 0", "under the apache license", "under apache 2 0", "spdx license identifier apache 2 0"),
    "mit": ("mit license", "permission is hereby granted free of charge to any person obtaining a copy of this software", "spdx license identifier mit"),
    "gpl": ("gnu general public license", "gnu gpl", "gplv3", "gplv2", "gpl version 3", "gpl version 2", "spdx license identifier gpl"),
    "lgpl": ("gnu lesser general public license", "gnu lgpl", "lgplv3", "lgplv2", "spdx license identifier lgpl"),
    "agpl": ("gnu affero general public license", "gnu agpl", "agplv3", "spdx license identifier agpl"),
    "mpl": ("mozilla public license", "mpl 2 0", "spdx license identifier mpl"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", "bsd license", "bsd 3 clause", "bsd 2 clause", "spdx license identifier bsd"),
    "cc-by": ("cc by 4 0", "cc by 3 0", "creative commons attribution 4 0", "creative commons attribution license"),
    "cc-by-nc": ("cc by nc 4 0", "cc by nc 3 0", "creative commons attribution noncommercial 4 0", "creative commons attribution noncommercial license"),
    "cc-by-sa": ("cc by sa 4 0", "cc by sa 3 0", "creative commons attribution sharealike 4 0", "creative commons attribution sharealike license"),
    "unlicense": ("this is free and unencumbered software released into the public domain", "the unlicense", "spdx license identifier unlicense"),
    "public-domain": ("is in the public domain", "dedicated to the public domain", "cc0 1 0", "spdx license identifier cc0"),
    "proprietary": ("all rights reserved", "proprietary and confidential"),
}
FAMILIES = (*TEMPLATES, OTHER)
#: Other names, in whose notices no family may be found.
FOREIGN = ("eclipse public license version 2 0", "artistic license version 2 0", "boost software license version 1 0", "zlib license", "isc license", "european union public license", "microsoft public license", "sample license version 2 0", "epl 2 0", "upl 1 0", "wtfpl", "ofl 1 1")


def marked(word: str) -> bool:
    return word in SHORT or any(m in word for m in MARKS)


def pairs(tokens: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in zip(tokens, tokens[1:])]


def proved() -> bool:
    """Whether no paragraph without marks can hold a template."""
    for template in (t for ts in TEMPLATES.values() for t in ts):
        tokens = template.split()
        if len(tokens) <= SHORT_TEMPLATE:
            if not any(map(marked, tokens)):
                return False
        elif sum(not any(map(marked, p.split())) for p in set(pairs(tokens))) >= COVERED * len(set(pairs(tokens))):
            return False
    return True


def holds(tokens: list[str], template: str) -> bool:
    """Whether a short template is in one piece in the words, or enough pairs of a long one are."""
    if len(template.split()) <= SHORT_TEMPLATE:
        return f" {template} " in f" {' '.join(tokens)} "
    wanted = set(pairs(template.split()))
    return len(wanted & set(pairs(tokens))) >= COVERED * len(wanted)


def words(text: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", text.lower())


def slots(tokens: list[str]) -> list[int]:
    return sorted({zlib.crc32(g.encode()) % SLOTS for g in [*tokens, *pairs(tokens)]})


def labelled_paragraphs() -> list[tuple[str, str]]:
    """(text, family): notices with words before and after, such of other licences, and prose with a licence term."""
    before = ("", "this project is ", "note ", "licensed under the ", "text and data ", "released under ")
    after = ("", " see license for details", " by the authors", " version 2 0", " 2 1 or later", " version 3 only", " 2020", " unless stated otherwise")
    notices = [*((t, family) for family, ts in TEMPLATES.items() for t in ts), *((t, OTHER) for t in FOREIGN), *((f"spdx license identifier {t}", OTHER) for t in FOREIGN)]
    rows = [(f"{b}{t}{a}", family) for t, family in notices for i, b in enumerate(before) for j, a in enumerate(after) if (i + j) % 2 == 0]
    others = (
        "the general public license fee", "a driving license is needed to rent a car", "the warranty covers two years of use", "she got her pilot license in may", "licensed doctors work in the clinic", "copyright law is hard to read",
        "permission is needed to enter", "the search warrant was signed", "the work permit and license fee went up", "fishing license for the season", "redistribute the load over all nodes",
        "the store is licensed to sell wine", "the book entered the public domain debate", "licence plates of old cars", "no warranty claims were made last year", "copyright notices are short",
    )
    return rows + [(f"{b}{t}{a}", OTHER) for t in others for b in ("", "they said ", "in short ") for a in ("", " again", " of and the")]


@lru_cache(maxsize=1)
def trained() -> tuple[list[list[float]], list[float], float]:
    """Weights (families x slots), biases and temperature; every fifth row, and all of some other licences, only calibrate."""
    unseen = set(FOREIGN[::3])
    rows = [(slots(words(t)), FAMILIES.index(f), i % 5 == 0 or any(x in t for x in unseen)) for i, (t, f) in enumerate(labelled_paragraphs())]
    w, bias = linear.fit([(at, y) for at, y, held in rows if not held], len(FAMILIES), SLOTS, epochs=30, rate=1.0)
    w = [[x if abs(x) > 1e-3 else 0.0 for x in c] for c in w]
    t = linear.calibrate([(linear.scores(at, w, bias), y) for at, y, held in rows if held])
    return w, bias, t


def classify(text: str) -> str:
    """What ``scan`` gives a candidate paragraph, in plain Python; for tests."""
    w, bias, t = trained()
    tokens = words(text)
    p = linear.softmax([z / t for z in linear.scores(slots(tokens), w, bias)])
    best = max(range(len(p)), key=lambda c: (p[c], -c))
    family = FAMILIES[best]
    if family == OTHER or p[best] < LEAST:
        return UNKNOWN
    return family if any(holds(tokens, t) for t in TEMPLATES[family]) else UNKNOWN


def _bound(value: Column, then) -> Column:
    """``then`` of a lambda's variable that holds ``value``: inside other lambdas an expression would be computed again and again."""
    return F.get(F.transform(F.array(value), then), 0)


def _family(line: Column) -> Column:
    w, bias, t = trained()

    def grams_of(have: Column) -> Column:
        neighbours = F.transform(F.sequence(F.lit(1), F.greatest(F.size(have) - 1, F.lit(1))), lambda i: F.concat(F.get(have, i - 1), F.lit(" "), F.get(have, i)))
        return F.array_distinct(F.concat(have, F.when(F.size(have) > 1, neighbours).otherwise(F.array().cast("array<string>"))))

    def confirmed(family: str, have: Column, grams: Column) -> Column:
        text = F.concat(F.lit(" "), F.array_join(have, " "), F.lit(" "))
        found = F.lit(False)
        for template in TEMPLATES[family]:
            tokens = template.split()
            if len(tokens) <= SHORT_TEMPLATE:
                found = found | text.contains(f" {template} ")
            else:
                wanted = sorted(set(pairs(tokens)))
                found = found | (F.size(F.array_intersect(F.array(*map(F.lit, wanted)), grams)) >= COVERED * len(wanted))
        return found

    def chosen(found: Column, have: Column, grams: Column) -> Column:
        scale = F.sqrt(F.greatest(F.size(found), F.lit(1)).cast("double"))

        def score(c: int) -> Column:
            weights = F.split(F.lit(",".join(f"{x:.6g}" for x in w[c])), ",").cast("array<double>")
            total = F.aggregate(found, F.lit(0.0), lambda a, i: a + F.element_at(weights, (i + 1).cast("int")))
            return (F.lit(bias[c]) + total / scale) / F.lit(t)

        scored = F.array(*(F.struct(score(c).alias("z"), F.lit(-c).alias("order"), F.lit(f).alias("family")) for c, f in enumerate(FAMILIES)))

        def decided(s: Column) -> Column:
            best = F.array_max(s)
            total = F.aggregate(s, F.lit(0.0), lambda a, x: a + F.exp(x["z"] - best["z"]))
            return F.struct(best["family"].alias("family"), (F.lit(1.0) / total >= LEAST).alias("likely"))

        def told(best: Column) -> Column:
            out = F.when(~best["likely"], F.lit(UNKNOWN))
            for family in TEMPLATES:
                out = out.when((best["family"] == family) & confirmed(family, have, grams), F.lit(family))
            return out.otherwise(F.lit(UNKNOWN))

        return _bound(_bound(scored, decided), told)

    tokens = F.filter(F.split(F.lower(line), "[^a-z0-9]+"), lambda x: x != "")
    slots_of = lambda grams: F.array_distinct(F.transform(grams, lambda g: F.crc32(g.cast("binary")) % SLOTS))
    return _bound(tokens, lambda have: _bound(grams_of(have), lambda grams: _bound(slots_of(grams), lambda at: chosen(at, have, grams))))


def _marked(low: Column) -> Column:
    any_ = F.lit(False)
    for word in SHORT:
        any_ = any_ | (low.contains(word) & low.rlike(f"(^|[^a-z0-9]){word}($|[^a-z0-9])"))
    for mark in MARKS:
        any_ = any_ | low.contains(mark)
    return any_


def paragraphs(text: Column) -> Column:
    """Blocks between blank lines, and the lines of blocks of several; distinct, in order; those without a letter or digit go."""
    blocks = F.transform(F.split(text, r"\n[ \t\r]*(?=\n)"), lambda x: F.btrim(x, F.lit(" \t\r\n")))
    lines = F.transform(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(" \t\r\n")))
    return F.array_distinct(F.filter(F.concat(blocks, lines), lambda x: x.rlike(r"[\p{L}\p{Nd}]")))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_paragraphs, n_candidates, n_confirmed, families of every document.

    ``n_paragraphs`` counts distinct paragraphs, ``n_candidates`` those that are scored, ``n_confirmed`` those of a licence family;
    ``families`` are the distinct families of these, sorted and joined by commas.  Null or empty text: zeros and the empty string.
    Repeated rows are each answered; a tie of scores goes to the family listed first.  Very long texts are taken whole, paragraph by
    paragraph.  Empty table: no rows.  Other columns may have any names.
    """
    text = F.coalesce(column(docs, "text"), F.lit(""))
    rows = docs.select(column(docs, "doc_id").alias("doc_id"), paragraphs(text).alias("each"), _marked(F.lower(text)).alias("any"))
    # a text without marks has no paragraph with one
    candidates = F.when(F.col("any"), F.filter("each", lambda x: _bound(F.lower(x), _marked))).otherwise(F.array().cast("array<string>"))
    rows = rows.select("doc_id", F.size("each").cast("long").alias("n_paragraphs"), candidates.alias("candidates"))
    rows = rows.select("doc_id", "n_paragraphs", F.size("candidates").cast("long").alias("n_candidates"), F.transform("candidates", _family).alias("found"))
    confirmed = F.filter("found", lambda x: x != UNKNOWN)
    return rows.select("doc_id", "n_paragraphs", "n_candidates", F.size(confirmed).cast("long").alias("n_confirmed"), F.array_join(F.array_sort(F.array_distinct(confirmed)), ",").alias("families"))
