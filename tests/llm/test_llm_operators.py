"""Operators on small tables with nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import hashlib
import os
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rallyframe.llm import chat, decontaminate, language_id, licences, near_dedup, neighbours, packing, pii, substring_dedup, url_filter
from rallyframe.llm.components import connected
from rallyframe.llm.queries import TOKENIZER

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n, words="the of river stone light under paper north seven garden music window".split()):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) + rng.choice(["", "", "s", "er"]) for _ in range(n))


GERMAN = "der die und ist nicht schön über Straße Fenster gegen immer wieder Zeichnung".split()


def texts():
    base = prose(1, 90).split()
    near = base[:40] + ["changed"] + base[41:]
    passage = prose(2, 45)
    return [
        None, "", "  \t\n ", "one", "One", " ".join(base), " ".join(near), " ".join(base), " ".join(base[:45] + ["other", "words"] + base[47:]),
        prose(3, 30) + " " + passage + " " + prose(4, 20), passage + " " + prose(5, 25), "x y " * 60, "12345 67890 !!!", "mail a.b@c.de +1 (684) 555-8031 4111111111111111 or 4111 1111 1111 1111 at 10.0.0.1 end",
        prose(6, 4000) + "\n" + prose(7, 3000), "w" * 20_000, prose(8, 60, GERMAN), prose(9, 80, GERMAN), "émile ÀB naïve — “x”",
    ]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "de" if i in (16, 17) else None if i % 5 == 0 else "en", "s", len(t or "")) for i, t in enumerate(texts())]
    rows += [rows[5], rows[10], (None, texts()[6], "en", "s", 1), (100, "some more words of the river", "en", "s", 1), (100, "not the same text at all, north", "en", "s", 1)]
    rows += [(200 + i, prose(50 + i, 60, GERMAN) if i % 2 else prose(50 + i, 60), "de" if i % 2 else "en", "s", 1) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("N_words", "spans", "score", "h", "m", "digest", "rep", "a", "part", "ids", "words", "start"):  # clash with names used inside
        df = df.withColumn(c, F.lit("clash"))
    return df.repartition(3)


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def everything(spark):
    return [(r.doc_id, r.text) for r in spark]


def folded(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def test_decontaminate(spark, docs):
    bench = spark.createDataFrame([(0, " ".join(prose(2, 45).upper().split()[5:30])), (1, "one"), (2, None), (3, "!!"), (4, "one"), (10, "naïve x"), (None, "river")], "item_id long, text string").withColumn("WM_WORDS", F.lit(1))
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = [(r.item_id, tuple(w[i : i + 10])) for r in bench.collect() if r.item_id is not None and (w := split(r.text)) for i in range(max(1, len(w) - 9))]
    want = []
    for r in docs.collect():
        w = split(r.text)
        hits = [(i, s, len(p)) for i, p in windows for s in range(len(w) - len(p) + 1) if tuple(w[s : s + len(p)]) == p]
        items = sorted({str(i) for i, _, _ in hits})
        n = len({k for _, s, m in hits for k in range(s, s + m)})
        want.append((r.doc_id, len(w), n, len(items), hashlib.sha256(",".join(items).encode()).hexdigest(), n > 0))
    columns = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(decontaminate.digest(docs, bench), *columns) == sorted(want, key=repr)
    assert rows_of(decontaminate.digest(docs, bench, chunk=4), *columns) == sorted(want, key=repr)
    assert rows_of(decontaminate.digest(docs.withColumn("wm_words_0", F.lit(1)), bench, chunk=2), *columns) == sorted(want, key=repr)
    # however many chunks, one written table is left: the one that the result reads
    folder = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    left = lambda: {f for f in os.listdir(folder) if f.startswith(("searched", "patterns"))}
    before = left()
    assert rows_of(decontaminate.digest(docs, bench, chunk=2), *columns) == sorted(want, key=repr)
    assert len(left() - before) == 1
    clean = decontaminate.clean(docs, bench)
    assert clean.columns == docs.columns and clean.count() == sum(not w[-1] for w in want)
    assert decontaminate.digest(docs.limit(0), bench).count() == 0 and not decontaminate.digest(docs, bench.limit(0)).where("n_hit > 0").count()


def test_pii(docs):
    got = pii.find_spans(docs, ["doc_id"])
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == docs.count() and by[0].spans == "" and by[0].base_sha256 == hashlib.sha256(b"").hexdigest()
    t = texts()[13]
    # the phone and card patterns run on into the digits after them and fail; the field finds both
    assert (by[13].n_email, by[13].n_ip, by[13].n_card, by[13].n_phone) == (1, 1, 1, 0) and f"phone:{t.index('+1')}:{t.index(' 4111')}" in by[13].spans and by[13].spans.count("card") == 2
    out = pii.redact(docs)
    assert out.columns == docs.columns
    red = {r.doc_id: r for r in out.collect()}
    assert red[13].text == "mail [EMAIL] [PHONE] [CARD] or [CARD] at [IP] end" and red[13].n_chars == len(red[13].text) and red[0].text is None and red[5].text == texts()[5]
    assert pii.find_spans(docs.limit(0), ["doc_id"]).count() == 0


def test_packing(docs):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    got = packing.pack(docs, TOKENIZER, length=256).collect()
    assert sorted((r.sequence_id, r.offset) for r in got) == sorted(set((r.sequence_id, r.offset) for r in got))
    at = 0
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert (r.sequence_id, r.offset) == divmod(at, 256) and r.offset + r.length <= 256 and r.length > 0
        at += r.length
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append([*t.encode(r.text or "", add_special_tokens=False).ids, 2])
    assert at == sum(len(x) for w in want.values() for x in w)
    for r in got:
        assert any(r.doc_tokens == len(x) and r.ids_crc32 == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in x[r.start : r.start + r.length])) for x in want[r.doc_id])
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0
    one = docs.where("doc_id = 3").limit(1)
    assert [r.padded_to for r in packing.pack(one, TOKENIZER).collect()] == [2]


def test_packing_finds_added_tokens(spark):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(TOKENIZER)
    texts = ["end <|endoftext|> next", "<|startoftext|>It's<|endoftext|>", "a <|ENDOFTEXT|> b", "<|endoftext| > plain", "no token"]
    want = {i: [*t.encode(x, add_special_tokens=False).ids, 2] for i, x in enumerate(texts)}
    got = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), TOKENIZER).collect()
    assert {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in got} == {i: (len(x), zlib.crc32(b"".join(k.to_bytes(4, "little") for k in x))) for i, x in want.items()}


def test_language(spark, docs):
    got = language_id.identify(docs)
    by = {r.doc_id: r for r in got.collect()}
    assert got.count() == docs.count()
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (0, 1, 2, 12)) and all(0 <= r.score <= 1 for r in by.values())
    lang = {r.doc_id: r.lang for r in docs.where("doc_id >= 200").collect()}
    held = [i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1]
    assert held and all(by[i].held_out for i in held) and sum(by[i].lang_pred == lang[i] for i in held) >= 0.95 * len(held)
    # labels of held-out documents do not matter
    other = docs.withColumn("lang", F.when(language_id.held_out(), "xx").otherwise(F.col("lang")))
    assert rows_of(language_id.identify(other), "doc_id", "lang_pred", "score") == rows_of(got, "doc_id", "lang_pred", "score")
    kept = language_id.accept(docs)
    assert kept.columns == docs.columns and not kept.where("doc_id in (0, 1, 2, 12)").count() and kept.where("doc_id in (5, 16)").count() == 3
    assert language_id.identify(docs.limit(0)).count() == 0
    unlabelled = language_id.identify(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def brute_slots(text):
    codes, out = [ord(c) for c in text.lower()], []
    for order in (1, 2, 3):
        for i in range(len(codes) - order + 1):
            h = 0
            for k in range(order):
                h = (h * 0x01000193 + (codes[i + k] + k + 1) * 0x9E3779B1) % 2**32
            out.append(((h ^ h >> 15) * 0x85EBCA6B) % 2**32 >> 17)
    return out


def test_language_equals_plain_python(spark):
    """TF-IDF, FTRL and probabilities of a small table, step by step with dictionaries and floats."""
    import math

    import numpy as np

    rows = [(i, prose(400 + i, 12, GERMAN) if i % 3 == 0 else prose(400 + i, 12), "de" if i % 3 == 0 else "en") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    order = {r.doc_id: r.h for r in df.select("doc_id", F.xxhash64(F.col("doc_id").cast("string"), "text").alias("h")).collect()}
    learned = sorted((r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 != 1), key=lambda r: order[r[0]])
    tf = {}
    for d, text, _ in rows:
        slots = brute_slots(text)
        tf[d] = {x: float(np.float32(slots.count(x) / len(slots))) for x in set(slots)}
    df_, languages = defaultdict(int), ["de", "en"]
    for d, _, _ in learned:
        for x in tf[d]:
            df_[x] += 1
    idf = lambda x: math.log((1 + len(learned)) / (1 + df_[x])) + 1
    scale, bias = language_id.SCALE, "bias"
    z, n = defaultdict(lambda: [0.0, 0.0]), defaultdict(lambda: [0.0, 0.0])

    def weight(x, c):
        if abs(z[x][c]) <= language_id.L1:
            return 0.0
        return -(z[x][c] - math.copysign(language_id.L1, z[x][c])) / ((language_id.BETA + math.sqrt(n[x][c])) / language_id.ALPHA + language_id.L2)

    def scores(d, known=True):
        f = {x: v * idf(x) * scale for x, v in tf[d].items()}
        f[bias] = 1.0
        return f, [sum(v * weight(x, c) for x, v in f.items()) for c in (0, 1)]

    def soft(s):
        e = [math.exp(x - max(s)) for x in s]
        return [x / sum(e) for x in e]

    rng = np.random.default_rng(7)
    for _ in range(language_id.EPOCHS):
        for i in rng.permutation(len(learned)):
            d, _, lang = learned[i]
            f, s = scores(d)
            p = soft(s)
            step = {}
            for x, v in f.items():
                for c in (0, 1):
                    g = v * (p[c] - (languages[c] == lang))
                    sigma = (math.sqrt(n[x][c] + g * g) - math.sqrt(n[x][c])) / language_id.ALPHA
                    step[x, c] = (g, sigma * weight(x, c))
            for (x, c), (g, w) in step.items():
                z[x][c] += g - w
                n[x][c] += g * g
    loss = lambda t: -sum(math.log(soft([x / t for x in scores(d)[1]])[languages.index(lang)]) for d, _, lang in learned)
    model = language_id.train(df)
    t = model.temperature
    assert model.languages == languages and (t == 0.05 or loss(t) <= min(loss(t * 1.01), loss(t / 1.01)) + 1e-9)
    for r in language_id.predict(df, model, ["doc_id"]).collect():
        p = soft([x / t for x in scores(r.doc_id)[1]])
        assert r.lang_pred == languages[p.index(max(p))] and abs(r.score - max(p)) < 1e-3


def test_texts_in_no_learned_language_go(spark):
    rng = random.Random(3)
    clean = [(i, prose(500 + i, rng.randrange(3, 120), GERMAN if i % 2 else prose(1, 60).split()), "de" if i % 2 else "en") for i in range(300)]
    junk = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(300)), "日本語の文章はここにあります。" * 6, "w" * 300, "Это предложение написано на русском языке. " * 4, "½ ² Ⅷ", "12345"]
    df = spark.createDataFrame(clean + [(1000 + i, t, None) for i, t in enumerate(junk)], "doc_id long, text string, lang string").withColumn("__surprise", F.lit(1))
    assert sorted(r.doc_id for r in language_id.accept(df).collect()) == [r[0] for r in clean]
    two = spark.createDataFrame([(i, "the same text in a language", "en") for i in range(3000)], "doc_id long, text string, lang string")
    assert language_id.train(two.union(two)).languages == ["en"]


def test_sample_in_chunks_and_repeated_rows(spark, docs, monkeypatch):
    """Labels of rows that all repeat are learned; features in several chunks give as good a model."""
    monkeypatch.setattr(language_id, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(language_id, "SAMPLE_PER_LANGUAGE", 3)
    rows = [(7, "immer wieder schön", "de")] * 50 + [(i, prose(i, 20), "en") for i in range(100, 200)]
    table = spark.createDataFrame([*rows, *[(3, "et toujours le même", "fr")] * 40], "doc_id long, text string, lang string")
    assert language_id.train(table).languages == sorted({r[2] for r in [*rows, (3, "", "fr")] if zlib.crc32(str(r[0]).encode()) % 3 != 1})
    monkeypatch.setattr(language_id, "SAMPLE_PER_LANGUAGE", 600)
    lang = {r.doc_id: r.lang for r in docs.where("doc_id >= 200").collect()}
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs).where("held_out and doc_id >= 200").collect()}
    assert got and sum(lang[i] == p for i, p in got.items()) >= 0.95 * len(got)


def brute_components(rows):
    sets = []
    for _, text in rows:
        w = folded(text)
        sets.append({tuple(w[i : i + 2]) for i in range(max(1, len(w) - 1))} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    out = []
    for i, (d, _) in enumerate(rows):
        c = min((x for x in least[find(i)] if x is not None), default=None)
        out.append((d, len(sets[i]), c, d == c))
    return sorted(out, key=repr)


def test_near_dedup(docs):
    columns = ("doc_id", "n_shingles", "component_id", "kept")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert rows_of(near_dedup.components(docs), *columns) == brute_components(rows)
    kept = near_dedup.representatives(docs)
    assert kept.columns == docs.columns
    assert near_dedup.components(docs.limit(0)).count() == 0


def test_near_dedup_of_large_groups(spark, monkeypatch):
    """Blocks smaller than the group of near copies: hubs and candidate pairs across blocks connect it."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    base, rows = prose(1, 120).split(), []
    rng = random.Random(8)
    for i in range(90):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, prose(200 + i, 100)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(near_dedup.components(df), "doc_id", "n_shingles", "component_id", "kept") == brute_components(rows)


def test_near_dedup_of_large_groups_without_hubs_and_candidate_pairs(spark, monkeypatch):
    """Classes of different blocks meet even if neither is a hub and their pair is no candidate."""
    for name, value in {"BLOCK": 8, "HUBS": 1, "LOOSE": 4, "LOOSE_BLOCKS": 2}.items():
        monkeypatch.setattr(near_dedup, name, value)
    # candidates only hold the group together
    monkeypatch.setattr(near_dedup, "_candidates", lambda classes, threshold: spark.createDataFrame([(i, 0) for i in range(1, 120)], "a long, b long"))
    rng, rows = random.Random(9), []
    bases = [prose(300 + k, 90).split() for k in range(20)]
    for i in range(120):
        w = list(bases[i * 7 % 20])
        for _ in range(rng.randrange(3, 8)):
            w[rng.randrange(len(w))] = f"new{rng.randrange(10**6)}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert rows_of(near_dedup.components(df), "doc_id", "n_shingles", "component_id", "kept") == brute_components(rows)


def one_word_apart(n, positions, seed=1):
    """Texts of codes: two that differ in one position are near copies, in two are not; and their components."""
    codes = random.Random(seed).sample(range(1 << positions), n)
    rows = [(i, " ".join(["head", *(f"p{k}v{c >> k & 1}" for k in range(positions)), "mid", "tail"])) for i, c in enumerate(codes)]
    at, root = {c: i for i, c in enumerate(codes)}, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, c in enumerate(codes):
        for k in range(positions):
            if (j := at.get(c ^ (1 << k))) is not None:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return rows, {i: find(i) for i in range(n)}


def test_near_dedup_loses_no_link_in_a_dense_region(spark):
    """All of 16,000 documents are alike; only those one word apart are linked."""
    rows, want = one_word_apart(16_000, 17)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert {r.doc_id: r.component_id for r in near_dedup.components(df).collect()} == want and len(set(want.values())) == 2234


def test_near_dedup_finishes_regions_beyond_the_neighbours(spark, monkeypatch):
    for name, value in {"NEAR": 1, "REGION": 64, "OUTSIDE": 16, "BLOCK": 64}.items():
        monkeypatch.setattr(near_dedup, name, value)
    rows, want = one_word_apart(1_200, 17, seed=5)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert {r.doc_id: r.component_id for r in near_dedup.components(df).collect()} == want


def brute_substrings(rows, window=20):
    seen, out = set(), {}
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = set()
        for i in range(len(w) - window + 1):
            g = tuple(w[i : i + window])
            if g in seen:
                gone |= set(range(i, i + window))
            seen.add(g)
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, text] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_substring_dedup(docs, monkeypatch, hot):
    if hot:
        monkeypatch.setattr(substring_dedup, "HOT", 1)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    brute = brute_substrings(set(rows))
    want = sorted(((d, *brute[d, t]) for d, t in rows), key=repr)
    assert rows_of(substring_dedup.dedup(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == want
    assert substring_dedup.dedup(docs.limit(0)).count() == 0


def checked_neighbours(table, rows, k=20):
    """Results against products of all pairs: ranks, scores and order are exact; the share of the nearest that is found."""
    import numpy as np

    got = defaultdict(list)
    for r in neighbours.nearest(table).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    ids, m = [i for i, _ in rows], np.array([v for _, v in rows], dtype=np.float64)
    at = {i: n for n, i in enumerate(ids)}
    assert set(got) == {i for i in ids if i % 20 == 0}
    hits = total = 0
    for q, found in got.items():
        s = m @ m[at[q]]
        s[at[q]] = -np.inf
        found.sort()
        n = min(k, len(ids) - 1)
        assert [f[0] for f in found] == list(range(1, n + 1)) and all(abs(f[2] - s[at[f[1]]]) < 1e-9 for f in found)
        assert found == sorted(found, key=lambda f: (-f[2], f[1]))
        hits += sum(f[2] >= np.sort(s)[-n] - 1e-12 for f in found)
        total += n
    return hits / max(total, 1)


def test_neighbours(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    m = rng.standard_normal((900, 16))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)] + [(1000 + i, [float(x) for x in m[40]]) for i in range(60)]
    others = [(2000, None), (2020, [0.0] * 16), (2040, [1.0] * 15 + [float("nan")]), (2060, [None] * 16), (None, rows[1][1]), rows[7], (2100, []), (2120, [float("inf")] * 16)]
    table = spark.createDataFrame(rows + others, "vec_id long, embedding array<double>").withColumn("node", F.lit(1)).withColumn("v", F.lit(1)).withColumn("PART", F.lit(1))
    assert checked_neighbours(table, rows) >= 0.99
    few = neighbours.nearest(table.where("vec_id < 5"))
    assert rows_of(few, "query_id", "rank") == [(0, 1), (0, 2), (0, 3), (0, 4)]
    assert neighbours.nearest(table.limit(0)).count() == 0


def test_neighbours_of_repeated_ids_and_other_lengths(spark):
    rows = [(0, [1.0, 0.0]), (0, [2.0, 0.0]), (1, [3.0, 1.0]), (2, [0.0, 1.0]), (20, [1.0, 1.0, 1.0]), (21, [1.0, 2.0, 1.0]), (40, [5.0])]
    got = rows_of(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), "query_id", "rank", "vec_id", "score")
    assert got == [(0, 1, 1, 3.0), (0, 1, 1, 6.0), (0, 2, 0, 2.0), (0, 2, 0, 2.0), (0, 3, 2, 0.0), (0, 3, 2, 0.0), (20, 1, 21, 4.0)]


def test_neighbours_in_a_group_of_near_copies(spark):
    """A third of all vectors lies within rounding of one; magnitudes beyond single precision do no harm."""
    import numpy as np

    rng = np.random.default_rng(2)
    m = rng.standard_normal((3000, 64))
    m[:1000] = m[0] + rng.standard_normal((1000, 64)) * 0.0005
    m *= 1e60
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got = neighbours.nearest(table).collect()
    hits = 0
    for q in range(0, 3000, 20):
        s = m @ m[q]
        s[q] = -np.inf
        hits += len(set(np.argsort(-s)[:20].tolist()) & {r.vec_id for r in got if r.query_id == q})
    assert hits >= 0.97 * 20 * 150


def test_neighbours_of_twenty_thousand(spark):
    import numpy as np

    m = np.random.default_rng(3).standard_normal((20_000, 48)).astype(np.float32)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(8)
    assert checked_neighbours(table, rows) >= 0.95


def test_urls(spark):
    rows = ["http://A.Example.com/en/71?x", "https://x.com/en/1", "https://y.net/de/8", "https://a.example.net/de/8#t", "https://q.org/es/", "https://notcom/en/", None, "no scheme", "https://com", "https://casino-free.example.net/fr/1", "https://garden.example.net/fr/1", "a://b://c/d", "x://H?p=/q"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string").withColumn("HOST", F.lit("clash"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages).collect()}
    assert got[0] == ("a.example.com", "/en/71", "example.com/en/7", "allow") and got[1] == ("x.com", "/en/1", "com/en/", "block")
    assert got[2] == ("y.net", "/de/8", "net/de/", "allow") and got[3] == ("a.example.net", "/de/8", "example.net/de/8", "block") and got[4][2:] == ("org/es/", "block")
    assert got[5][2] is None and got[6][:3] == ("", "", None) == got[7][:3] and got[8][:2] == ("com", "")
    assert got[9][3] == "block" and got[10][3] == "allow" and got[11][:2] == ("b:", "//c/d") and got[12][:2] == ("h", "")
    many = [*url_filter.RULES, *((f"h{i}.com", "/", "allow") for i in range(300))]
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, many).collect()} == got
    assert url_filter.judge(pages.limit(0)).count() == 0
    # the model, by plain Python
    import math

    w, bias = url_filter.trained(spark)
    for r in url_filter.judge(pages).collect():
        at = set()
        for mark, text in (("h", r.host), ("p", r.path)):
            for n in url_filter.GRAMS:
                marked = f"^{text}$"
                at |= {zlib.crc32(f"{mark}{n}:{marked[i : i + n]}".encode()) % url_filter.SLOTS for i in range(len(marked) - n + 1)} if text else set()
        z = bias + sum(w[i] for i in at) / math.sqrt(max(1, len(at)))
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-4


def test_a_very_long_url_takes_seconds(spark):
    import time

    urls = ["http://example.com/" + "é𝄞x/" * 40_000, "http://" + "a" * 160_000, None]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    began = time.time()
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    assert time.time() - began < 30 and len(got) == 3 and len(got[0].path) == 160_001


def test_urls_that_were_not_learned(spark):
    """Precision and recall of the classifier on hosts that the labelled table does not have."""
    bad = "mycasino pokerstar slotsking bigbets bettingclub jackpotcity adultvideo pornsite xxxmovies livesexcam spammail cheappills buyviagra paydayloan replicawatch warezdown torrentz crackkey malwarehub phishing luckycasino pokernight eslots sportsbetting superjackpot adultchat freeporn hotxxx sexcams pillstore".split()
    good = "citylibrary artmuseum highschool sciencenow rosegarden oldrecipes worldhistory jazzmusic traveltips healthcare sportnews cookbooks mydocs openwiki dailyherald sundaytimes morningpost readingroom trainstation newspaper bookshop gardentools musicschool weathermap historybooks museumshop cityguide schoolbus traveller recipebox".split()
    rows = [(i, f"https://{('www.', '')[i % 2]}{h}.example.{('com', 'net', 'org')[i % 3]}/{'fr' if i % 2 else 'x'}/{i}") for i, h in enumerate(bad + good)]
    got = {r.page_id: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), ()).collect()}
    hit = sum(got[i].verdict == "block" for i in range(len(bad)))
    false = sum(got[len(bad) + i].verdict == "block" for i in range(len(good)))
    assert hit / len(bad) >= 0.9 and hit / (hit + false) >= 0.9, (hit / len(bad), hit / (hit + false))


#: Words that the labelled table of urls does not have.
UNSEEN_BAD = "gambling roulette hentai keygen craps sportsbook pokies stripper lesbian swingers milfs xxxtube levitra ambien painkiller anabolic cashadvance richquick hyip airdrop sweepstakes fakerolex bootleg torrents cracks serials warezz ransomware phishing scareware".split()
UNSEEN_GOOD = "lawyer pottery piano castle orchestra bicycle meadow kindergarten beekeeping astronomy bookshop mathematics cathedral sculpture vegetables surgery veterinary parliament lighthouse joinery upholstery philosophy grammar aquarium ballet marathon gymnastics notary brewery optician".split()


def judged(spark, told):
    """Precision and recall of blocking on hosts of unseen words, with paths that tell, or not."""
    words = [(w, True) for w in UNSEEN_BAD] + [(w, False) for w in UNSEEN_GOOD]
    assert not {w for w, _ in words} & set(" ".join([*url_filter.BAD_WORDS.values(), *url_filter.GOOD_WORDS.values()]).split())
    path = lambda i, bad: f"/{('bonus-free/', 'order-cheap/', 'girls-videos/')[i % 3] if bad else ('article-archive/', 'course-guide/', 'event-report/')[i % 3]}{i}" if told else f"/x/{i}"
    rows = [(i, f"https://{('www.', '')[i % 2]}{w}.example.{('com', 'net', 'org')[i % 3]}{path(i, bad)}") for i, (w, bad) in enumerate(words)]
    got = {r.page_id: r.verdict == "block" for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), ()).collect()}
    hit, false = (sum(got[i] for i, (_, bad) in enumerate(words) if bad == kind) for kind in (True, False))
    return hit / (hit + false), hit / len(UNSEEN_BAD)


def test_urls_of_unseen_words(spark):
    """Hosts of words that are not learned.  Paths made of parts of learned ones decide; by the host alone the classifier is
    near chance (0.58 and 0.50 when measured, see README), so no bound is set for that."""
    figures = {told: judged(spark, told) for told in (False, True)}
    print("precision and recall by host alone, and with a path that tells:", figures)
    assert min(figures[True]) >= 0.8, figures


def test_rules_against_brute_force(spark):
    """Host, path and rule of all pages by plain Python."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")

    def plain(url):
        if url is None or "://" not in url:
            return "", "", None, None
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        path = re.split("[?#]", rest[end:])[0]
        fits = [(len(h + p), h + p, a) for h, p, a in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *(max(fits)[1:] if fits else (None, None)))

    urls = {r.page_id: r.url for r in pages.collect()}
    got = url_filter.judge(pages).collect()
    assert len(got) == pages.count() and len({r.rule for r in got}) == len(url_filter.RULES) + 1
    for r in got:
        host, path, rule, action = plain(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and (action is None or r.verdict == action)


def test_chat(spark, monkeypatch):
    conv = lambda i, *turns: [(i, k, "user" if k % 2 == 0 else "assistant", t) for k, t in enumerate(turns)]
    long = [(8, k, "user", str(k) * 5) for k in range(300)]
    rows = conv(1, "a", "b") + conv(2, "a", "b", "c") + conv(3, "a", "b", "c") + conv(4, "a", "x") + conv(5, "a") + conv(6, "z") + conv(6, "z") + [(None, 0, "user", "n"), (7, None, None, None), (7, None, "b", "w" * 100_000)] + long + [(9, *r[1:]) for r in long[:200]]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(0)).withColumn("LINE", F.lit(0)).withColumn("size", F.lit(0)).repartition(3)
    got = rows_of(chat.render(table), "conv_id", "part", "copies", "n_turns")
    assert got == sorted([(2, 0, 2, 3), (4, 0, 1, 2), (6, 0, 1, 1), (7, 0, 1, 2), (8, 0, 1, 300)], key=repr)
    text = {r.conv_id: r.chat for r in chat.render(table).collect()}
    assert text[4] == "<|user|>\na<|end|>\n<|assistant|>\nx<|end|>\n" and text[8] == "".join(f"<|user|>\n{t}<|end|>\n" for _, _, _, t in long)
    monkeypatch.setattr(chat, "PART", 1000)
    parts = [r for r in chat.render(table).orderBy("part").collect() if r.conv_id == 8]
    assert len(parts) > 3 and "".join(r.chat for r in parts) == text[8] and [r.part for r in parts] == list(range(len(parts)))
    assert chat.render(table.limit(0)).count() == 0


def test_licences(spark, docs):
    lines = ["Licensed under the Apache License, Version 2.0.", "prose and more", "", "All rights reserved.", "Your driving license has expired, officer.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0."]
    wrapped = "Some prose.\n \t\r\n\nPermission is hereby granted, free of charge, to any\nperson obtaining a copy of this\nsoftware, to deal in it.\n\n\nEnd"
    extra = [(999, "\n".join(lines)), (998, "\n".join(lines[:2])), (997, wrapped), (996, "x\n" * 30_000 + lines[0]), (995, "under cc by 4 0, licensed"), (994, "½\n%%\n٣")]
    table = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("found", F.lit(1)).withColumn("EACH", F.lit(1))

    def brute(text):
        """All paragraphs are scored, marks or not."""
        found = [x.strip(" \t\r\n") for x in [*re.split(r"\n[ \t\r]*(?=\n)", text or ""), *(text or "").split("\n")]]
        found = list(dict.fromkeys(x for x in found if any(c.isalpha() or c.isdecimal() for c in x)))
        families = [f for x in found if len(x) < 10_000 and (f := licences.classify(x)) != "unknown"]
        return len(found), len(families), ",".join(sorted(set(families)))

    got = sorted(((r.doc_id, r.n_paragraphs, r.n_confirmed, r.families) for r in licences.scan(table).collect()), key=repr)
    want = sorted(((r.doc_id, *brute(r.text)) for r in table.collect()), key=repr)
    assert [g for g in got if g[0] != 996] == [w for w in want if w[0] != 996]
    by = {g[0]: g for g in got}
    assert {"apache", "mit", "proprietary", "cc-by-nc"} <= set(by[999][3].split(",")) and by[998][3] == "apache" and by[997][3] == "mit" and by[996][3] == "apache" and by[995][3] == "cc-by"
    assert licences.scan(table.limit(0)).count() == 0
    held = [*lines, *(f"{x} license {y}" for x in ("some", "a gnu", "the MIT", "bsd") for y in ("text", "version 3", ""))]
    one = spark.createDataFrame([(i, t) for i, t in enumerate(held)], "doc_id long, text string")
    assert {r.doc_id: r.families or "unknown" for r in licences.scan(one).collect()} == {i: licences.classify(t) for i, t in enumerate(held)}


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(k, k + 1) for k in range(400, 440)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = dict(__import__("rallyframe.llm.components", fromlist=["stars"]).stars(edges))
    assert dict(map(tuple, connected(df).collect())) == want
    assert connected(df.limit(0)).count() == 0


def test_components_in_rounds(spark, monkeypatch):
    from rallyframe.llm import components

    monkeypatch.setattr(components, "CONTRACTED", 30)
    edges = [(k, k + 1) for k in range(100)] + [(200, k) for k in range(201, 230)]
    df = spark.createDataFrame(edges, "a long, b long").repartition(5)
    assert dict(map(tuple, connected(df).collect())) == dict(components.stars(edges))


def test_pipeline(spark, docs, tmp_path):
    bench = spark.createDataFrame([(0, " ".join(prose(2, 45).split()[5:30]))], "item_id long, text string")
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    frame = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages, columns = {}, frame.columns
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, frame, str(tmp_path))
        stages[name] = frame = out
        assert name == "packing" or out.columns == columns
    ids = {n: sorted({r.doc_id for r in f.select("doc_id").collect()}, key=repr) for n, f in stages.items()}
    assert not {0, 1, 2, 12} & set(ids["language_id"]) and 7 not in ids["near_dedup"] and 6 not in ids["near_dedup"] and 5 in ids["near_dedup"]
    assert not {9, 10} & set(ids["decontaminate"]) and set(ids["pii"]) == set(ids["decontaminate"]) == set(ids["packing"])
    assert "[EMAIL]" in stages["pii"].where("doc_id = 13").first().text
    key = lambda df: sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.length) for r in df.select("doc_id", "start", "length").where("start = 0").collect())
    assert [k[0] for k in key(corpus_pipeline.run(spark, str(tmp_path)))] == [k[0] for k in key(stages["packing"])]


def test_pipeline_equals_brute_force(spark, tmp_path):
    """All stages again on collected rows: components by sets of five words, windows by comparison, ids by the tokenizer."""
    from tokenizers import Tokenizer

    t, rng = Tokenizer.from_file(TOKENIZER), random.Random(21)
    texts = [prose(700 + i, 60 + i % 90, GERMAN if i % 3 == 0 else prose(1, 60).split()) for i in range(120)]
    for i in range(100, 120):  # near copies, some of them beyond the threshold
        w = texts[i - 100].split()
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = "other"
        texts[i] = " ".join(w)
    item = " ".join(prose(1, 60).split()[:14])
    texts[30] += " " + item
    texts[40] += " mail a.b@c.de or (684) 555-8031"
    texts += ["日本語の文章はここにあります。" * 6, "".join(rng.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(300)), "123 456", None, ""]
    docs = spark.createDataFrame([(i, x, None if i >= 120 else "de" if i % 3 == 0 else "en", "s", len(x or ""), "c", 1) for i, x in enumerate(texts)], SCHEMA + ", Spans string, __kept int").repartition(3)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(0, item), (1, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    model = language_id.train(spark.read.parquet(str(tmp_path / "documents.parquet")))
    left = {}
    for i, x in enumerate(texts):
        lang, score, surprise = model.predict(x)
        if lang != "und" and score >= language_id.LEAST_SCORE and surprise <= model.most:
            left[i] = x
    assert set(range(120)) == set(left)
    words = {i: folded(x) for i, x in left.items()}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, w in words.items()}
    root = {i: i for i in sets}
    for i in sorted(sets):  # components by growing: a later document joins all earlier ones it is alike to
        alike = {root[j] for j in sets if j < i and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])} | {i}
        root = {j: min(alike) if r in alike else r for j, r in root.items()}
    kept = [i for i in sets if root[i] == i]
    split = lambda x: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", x.lower())
    windows = {tuple(split(item)[k : k + 10]) for k in range(5)}
    kept = [i for i in kept if not any(tuple(split(left[i])[k : k + 10]) in windows for k in range(len(split(left[i]))))]
    assert 30 not in kept and 40 in kept and len(kept) < 119
    finder = pii.Finder(pii.trained())
    want = {}
    for i in kept:
        base, added = finder.find([left[i]])[0]
        want[i] = [*t.encode(pii.redact_text(left[i], base + added), add_special_tokens=False).ids, 2]
    got = defaultdict(list)
    for r in corpus_pipeline.run(spark, str(tmp_path)).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(want) and "[EMAIL]" in pii.redact_text(left[40], [*finder.find([left[40]])[0][0], *finder.find([left[40]])[0][1]])
    for i, pieces in got.items():
        ids, at = want[i], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    frame = docs
    for name, stage in corpus_pipeline.STAGES:  # empty tables, and the columns of the input
        frame = stage(spark, frame.limit(0), str(tmp_path))
        assert frame.count() == 0 and (name == "packing" or frame.columns == docs.columns)


def test_pipeline_stage_compares_five_words(spark):
    rng, rows = random.Random(12), []
    for k in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        rows += [(10 * k, " ".join(base)), (10 * k + 1, " ".join([*base[:50], "new", *base[51:]]))]
        rows.append((10 * k + 2, " ".join("other" + w if i % 20 == 10 else w for i, w in enumerate(base))))  # 0.82 by two words, 0.59 by five
    fives = {d: {tuple(w[i : i + 5]) for i in range(len(w) - 4)} for d, t in rows if (w := t.split())}
    alike = lambda a, b: len(a & b) >= 0.8 * len(a | b)
    want = [d for d in fives if not any(e < d and alike(fives[d], fives[e]) for e in fives)]
    assert {d % 10 for d in want} == {0, 2}
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    assert sorted(r.doc_id for r in stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()) == sorted(want)
