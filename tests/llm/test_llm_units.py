"""Parts of the operators without Spark, against brute force."""

import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rallyframe.llm import components, decontaminate, language_id, licences, linear, near_dedup, packing, pii, substring_dedup
from rallyframe.llm.queries import TOKENIZER

WORDS = st.lists(st.sampled_from(["a", "b", "c", "d", "é", "A", "x1"]), max_size=60)


@settings(max_examples=60, deadline=None)
@given(WORDS, st.lists(st.lists(st.sampled_from(["a", "b", "c", "é"]), min_size=1, max_size=4), max_size=6))
def test_wu_manber_finds_all(words, patterns):
    found = decontaminate.Searcher([([w.encode() for w in p], i) for i, p in enumerate(patterns)]).search([" ".join(words).encode(), None, b""])
    low = [w.lower() if w.isascii() else w for w in words]
    hit, items = set(), set()
    for i, p in enumerate(patterns):
        for s in range(len(low) - len(p) + 1):
            if low[s : s + len(p)] == p:
                hit |= set(range(s, s + len(p)))
                items.add(i)
    counts, spans, got = found
    assert counts == [len(words), 0, 0] and set(got[0]) == items and not got[1] and not got[2]
    assert {k for a, b in spans[0].tolist() for k in range(a, b)} == hit


def brute_spans(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1])) % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a0.1@-+ ()25é\n[", max_size=40))
def test_base_spans_are_those_of_the_patterns(text):
    base, added = pii.Finder(pii.trained()).find([text])[0]
    assert sorted(base) == brute_spans(text)
    assert not any(x < b and a < y for _, a, b in added for _, x, y in base)


def test_field_learns_its_table_and_is_quiet():
    field = pii.trained()
    assert field.quiet
    rows = pii.labelled_table()
    got = field.decode([[field.vectors(w) for w in s.split()] for s, _ in rows])
    assert sum([pii.LABELS[i] for i in y] == want.split() for y, (_, want) in zip(got, rows)) > 0.97 * len(rows)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abAZé.-_%,!?;:'|&ß日 ", min_size=1, max_size=14).map(lambda x: x.replace(" ", "")).filter(bool))
def test_plain_words_have_the_feature_sets_of_the_proof(word):
    assert set(pii.features(word)) in [set(x) for x in pii.PLAIN_SETS]


def held_out_sentences(seed=99):
    """Sentences of other words and forms than the labelled table's: (text, the personal data in it)."""
    rng = random.Random(seed)
    words = "please send our team news about seven green houses while nobody knew why that old bridge fell last Monday".split()
    d = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    f = lambda n: rng.choice("23456789") + d(n - 1)
    w = lambda: "".join(rng.choice("aeioubdklmnprst") for _ in range(rng.randrange(4, 9)))
    data = [lambda: f"({f(3)}) {f(3)}-{d(4)}", lambda: f"({f(3)}) {f(3)} {d(4)}", lambda: f"{f(3)}-{f(3)}-{d(4)}", lambda: f"{f(3)}.{f(3)}.{d(4)}", lambda: f"({f(3)}){f(3)}-{d(4)}", lambda: f"{w()} [at] {w()} [dot] com", lambda: f"{w()}(at){w()}.org", lambda: f"{w()}[at]{w()}[dot]net", lambda: f"{w()} (at) {w()} (dot) de", lambda: "[.]".join(str(rng.randrange(1, 255)) for _ in range(4))]
    clean = [lambda: f"in {rng.randrange(1800, 2030)}", lambda: f"part 1{d(2)}.{f(3)}.{d(4)}", lambda: f"version {f(1)}.{d(1)}.{d(2)}", lambda: f"pages {f(2)}-{f(3)}", lambda: f"[{d(2)}] and ({d(1)})", lambda: f"id {f(8)}", lambda: f"{f(3)},{d(3)} people", lambda: f"room ({f(3)}) for {f(3)}", lambda: f"20{d(2)}-0{f(1)}-1{d(1)}", lambda: f"{w()}.com", lambda: f"at {f(2)} dot", lambda: f"{d(2)}:{d(2)}:{d(2)}", lambda: f"sku {w()}-{f(4)}", lambda: f"{f(2)}.{d(2)} percent", lambda: f"({w()}) [sic]"]
    rows = []
    for make, personal in [(m, True) for m in data for _ in range(20)] + [(m, False) for m in clean for _ in range(20)]:
        x = make()
        a, b = (" ".join(rng.choice(words) for _ in range(rng.randrange(1, 6))) for _ in range(2))
        rows.append((f"{a} {x} {b}{rng.choice(['', '.', '!'])}", x if personal else None))
    return rows


def test_added_spans_on_held_out_sentences():
    """Exact spans; the base patterns find none of these."""
    rows, finder = held_out_sentences(), pii.Finder(pii.trained())
    hit = told = 0
    for (text, want), (base, added) in zip(rows, finder.find([t for t, _ in rows])):
        assert not base
        told += len(added)
        hit += sum(text[a:b] == want for _, a, b in added)
    personal = sum(w is not None for _, w in rows)
    assert hit / personal >= 0.9 and hit / told >= 0.95, (hit / personal, hit / told)


def test_viterbi_is_the_best_path():
    field, rng = pii.trained(), random.Random(1)
    import itertools

    words = ["call", "(684)", "555-8031", "[at]", "example.com", "12", "4.3", "now."]
    for _ in range(5):
        s = [rng.choice(words) for _ in range(4)]
        v = [field.vectors(w) for w in s]
        e = [v[i][0] + (v[i - 1][1] if i else 0) + (v[i + 1][2] if i + 1 < len(v) else 0) for i in range(len(v))]
        best = max(itertools.product(range(len(pii.LABELS)), repeat=4), key=lambda y: field.start[y[0]] + sum(e[i][y[i]] for i in range(4)) + sum(field.pairs[y[i], y[i + 1]] for i in range(3)))
        assert field.decode([v])[0].tolist() == list(best)


def test_added_spans_and_redaction():
    finder = pii.Finder(pii.trained())
    text = "call (684) 555-8031 or bob [at] example [dot] com, ip 10[.]1[.]2[.]3, card 4111 1111 1111 1111"
    base, added = finder.find([text])[0]
    assert {pii.KINDS[k] for k, _, _ in added} == {"phone", "email", "ip"} and {pii.KINDS[k] for k, _, _ in base} == {"card"}
    assert pii.redact_text(text, base + added) == "call [PHONE] or [EMAIL], ip [IP], card [CARD]"
    assert finder.find(["In 1999 it was v2.10, 3.14 and 1,000 of [12]. The end (of it)."])[0] == ([], [])


def test_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    t.encode_special_tokens = True
    texts = ["It's we'll DON'T ''s", "a\x85b\xa0c\x1cd", "<|endoftext|> x", "½ ² ³x 12³", "Ünï ß µ ª × ÷", "“quote” – dash… ’s l’été", "日本語 é ΑΣ İ", "", " \n\t", "x" * 3000, "!" * 500, "\x00 </w> w>"]
    rng = random.Random(3)
    texts += ["".join(rng.choice("ab'sétre 1²!.-\n’ß") for _ in range(80)) for _ in range(200)]
    for text, ids in zip(texts, packing.Encoder(TOKENIZER, np.dtype("<u2")).encode(texts, None)):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=0, max_size=80))
def test_super_kmers_cover_each_window_once(words):
    h = substring_dedup.word_hashes([w.encode() for w in words])
    start, size, value = substring_dedup.runs_of(h, 5, 2)
    assert size.sum() == max(0, len(words) - 4) and (np.cumsum(size) - size).tolist() == start.tolist()
    windows = {}
    for s, n, v in zip(start, size, value):
        for w in range(s, s + n):
            assert windows.setdefault(tuple(words[w : w + 5]), v) == v  # equal windows have equal minimisers


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=3, max_size=60))
def test_later_windows(ids):
    ids = np.array(ids, dtype=np.int64)
    at = np.arange(len(ids) - 2)
    seen, want = set(), []
    for i in at:
        w = tuple(ids[i : i + 3])
        want.append(w in seen)
        seen.add(w)
    assert substring_dedup.later_windows(ids, at, [np.zeros(len(at)), at], 3).tolist() == want


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12)), max_size=20))
def test_stars(edges):
    parts = {x: {x} for e in edges for x in e}
    for a, b in edges:
        joined = parts[a] | parts[b]
        for x in joined:
            parts[x] = joined
    assert dict(components.stars(edges)) == {x: min(p) for x, p in parts.items() if min(p) != x}


def test_links_are_exact():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 60, 40, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.choice(base, n, replace=False), rng.integers(0, 1 << 60, 3, dtype=np.uint64)])) for n in rng.integers(25, 41, 30)]
    got = near_dedup._links(sets, 80)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert got[i, j] == (i != j and 100 * both >= 80 * (len(a) + len(b) - both))


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    minima, base = near_dedup.Minima(), rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    for share in (0.5, 0.8, 0.9):
        n = int(500 * 2 * share / (1 + share))
        other = np.concatenate([base[:n], rng.integers(0, 1 << 63, 500 - n, dtype=np.uint64)])
        a, b = (np.frombuffer(minima.signature(x), np.uint8) for x in (base, other))
        labels = 2 * near_dedup.TREES * near_dedup.DEPTH
        assert abs((a[:labels].view(np.uint16) == b[:labels].view(np.uint16)).mean() - share) < 0.15


def test_grams_of_blocks_are_those_of_the_whole(monkeypatch):
    text = "Größe und Maß sind wichtig. " * 20
    whole = language_id.counts(text)
    monkeypatch.setattr(language_id, "_BLOCK", 37)
    assert (language_id.counts(text) == whole).all() and whole.sum() == 3 * len(text) - 3


@pytest.mark.parametrize("text, want", [("½ ² ³ Ⅷ ٣ _ 12 !", False), ("½a", True), ("12 ª", True), ("日", True), ("", False)])
def test_letters(text, want):
    assert language_id.has_letter(text) == want


def test_temperature_and_ftrl():
    rng = np.random.default_rng(6)
    samples = [("ab"[i % 2], np.array([i % 2, 2 + i % 3], np.int32), np.array([0.1, 0.1])) for i in range(200)]
    w, bias = language_id.ftrl(lambda: [samples[:120], samples[120:]], np.ones(8), ["a", "b"])
    right = [np.argmax((tf * language_id.SCALE) @ w[s] + bias) == (lang == "b") for lang, s, tf in samples]
    assert np.mean(right) == 1.0 and (w[5:] == 0).all()
    z = rng.standard_normal((500, 3)) * 5
    p = np.exp(z / 5) / np.exp(z / 5).sum(1, keepdims=True)
    y = np.array([rng.choice(3, p=x) for x in p])
    assert 3 < language_id.temperature(z, y) < 8


def test_licence_classifier():
    held = {"Licensed under the Apache License, Version 2.0.": "apache", "Released under the MIT License.": "mit", "This work is licensed under the GNU General Public License, version 3.": "gpl", "Licensed under CC BY-NC 4.0.": "cc-by-nc", "All rights reserved.": "proprietary", "Your driving license has expired, officer.": "unknown", "Licensed under the terms of my friend": "unknown"}
    assert {t: licences.classify(t) for t in held} == held
    wrapped = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the 'Software'), to deal\nin the Software without restriction, including the rights to use and copy"
    more = {wrapped: "mit", "Released under Apache 2.0": "apache", "Text and data available under CC BY-SA 4.0": "cc-by-sa", "This work is under a Creative Commons Attribution 4.0 International": "cc-by", "Released under GPLv3.": "gpl"}
    assert {t: licences.classify(t) for t in more} == more
    assert licences.proved()


def test_licence_names_are_not_confused():
    """Names that take each other's place, names alone, and the same words in another order."""
    want = {
        "SPDX-License-Identifier: GPL-2.0-only": "gpl", "SPDX-License-Identifier: MPL-2.0": "mpl", "SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl", "SPDX-License-Identifier: Apache-2.0": "apache",
        "Licensed under the Mozilla Public License version 2.0": "mpl", "GNU Lesser General Public License version 2.1": "lgpl", "GNU Affero General Public License version 3": "agpl",
        "this work is in the public garden and domain of arts": "unknown", "MIT License": "mit", "Apache License\n                           Version 2.0, January 2004": "apache", "GPLv3": "gpl", "CC BY-SA 4.0": "cc-by-sa", "GNU GPL version 3 or later": "gpl",
        "Licensed under the Fictional License, Version 2.0": "unknown", "Released under the Acme Public License": "unknown", "SPDX-License-Identifier: CDDL-1.0": "unknown", "Licensed under the PHP License": "unknown",
        "Licensed under the Common Development and Distribution License version 1.0": "unknown", "license public general gnu": "unknown", "The general public license fee for gnu herds": "unknown",
        "This is free and unencumbered software released into the public domain.": "unlicense", "Licensed under CC BY-NC 4.0": "cc-by-nc", "Licensed under CC BY 4.0": "cc-by", "Licensed under CC BY-ND 4.0": "unknown",
    }
    assert {t: licences.classify(t) for t in want} == want


def test_licences_on_paragraphs_that_were_not_learned():
    """Precision and recall on notices in other surroundings, and on prose with the same words."""
    before = ["", "Copyright 2019 J. Doe. ", "All files here are ", "Unless noted, content is ", "(c) 2021 Example Ltd. ", "* "]
    after = ["", " You may obtain a copy at the web site.", " See the file for more.", "\nThe rest follows."]
    other = [
        "The licensed electrician came under the old rules at nine", "She has the right to public speech under the law", "The museum reserved all rooms for the meeting", "His fishing permission was granted in spring",
        "A public work of art stood in the domain of the king", "Apache helicopters and gnu herds were released", "The license plate version 2 of the car", "Creative people attribute success to common sense", "cc the author by mail, version 4",
        "He was released under the condition of silence", "Redistribution of income is a general public matter", "Modification of the house is permitted", "The pilot license exam has 3 parts", "rights of way are reserved for trams",
    ]
    want = [(b + t[0].upper() + t[1:] + "." + a, f) for f, ts in licences.TEMPLATES.items() for t in ts for b in before for a in after]
    got = [(licences.classify(t), f) for t, f in want]
    clean = [licences.classify(t + a) for t in other for a in after]
    right = sum(g == f for g, f in got)
    told = sum(g != "unknown" for g, _ in got) + sum(c != "unknown" for c in clean)
    assert right / len(got) >= 0.9 and right / told >= 0.95, (right / len(got), right / told, sum(c != "unknown" for c in clean))


def test_linear():
    rows = [([0, 2], 0), ([1, 2], 1)] * 20
    w, bias = linear.fit(rows, 2, 3)
    assert all(np.argmax(linear.scores(at, w, bias)) == y for at, y in rows)
    assert linear.calibrate([(linear.scores(at, w, bias), y) for at, y in rows]) <= 1


def test_slots_are_crc32():
    assert licences.slots(["a", "b"]) == sorted({zlib.crc32(x) % licences.SLOTS for x in (b"a", b"b", b"a b")})


@pytest.mark.parametrize("text, want", [(None, 0), ("", 0), (" \t\n", 0), ("one", 1), ("One one", 1), ("a b a b", 2)])
def test_shingles(text, want):
    assert len(near_dedup.shingles(text.encode() if text is not None else None)) == want


def test_sketch_bound_seldom_loses_a_pair_at_the_threshold():
    from math import ceil, comb

    agree, n = 0.8 + 0.2 / 256, near_dedup.SKETCH
    least = ceil((near_dedup.ESTIMATE * (1 - 1 / 256) + 1 / 256) * n)
    assert sum(comb(n, k) * agree**k * (1 - agree) ** (n - k) for k in range(least)) < 1e-6
