"""Personal data: base patterns, and a linear-chain conditional random field that adds spans the patterns miss.

The field labels white-space tokens of a sentence with O or B-/I- of a kind.  Its features are shapes of the word and of
its neighbours; its weights are fitted by gradient descent on ``labelled_table()``; decoding is Viterbi over many
sentences at once in numpy.  A sentence is decoded if it has an anchor: a digit, ``@``, ``+`` or a bracket.  ``Field.quiet`` proves from the weights that any other sentence is labelled O throughout; were it not so, all
sentences would be decoded.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, free, map_texts, share

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOTTED = re.compile(r"[0-9][0-9.]*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANCHOR = re.compile(r"[0-9@\[\]()<>+]")
_TOKEN = re.compile(r"\S+")
_DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = ord(c) - 48
        total += x if i % 2 == 0 else 2 * x - 9 * (x > 4)
    return total % 10 == 0


def _emails(line: str):
    at = line.find("@")
    done = 0
    while at >= 0:
        start = at
        while start > done and line[start - 1] in _LOCAL:
            start -= 1
        m = _EMAIL.match(line, start) if start < at else None
        if m:
            yield m.start(), m.end()
            done = m.end()
        else:
            done = at + 1
        at = line.find("@", done)


def _ips(line: str):
    for m in _DOTTED.finditer(line):
        if m[0].count(".") < 3:
            continue
        at, run = m.start(), []
        for part in m[0].split("."):
            if not part:
                run = []
            else:
                run.append((at, part))
                if len(run) == 4:
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for _, p in run):
                        yield run[0][0], at + len(part)
                    run = []
            at += len(part) + 1


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns in one text without line breaks between parts of a match; ends are exclusive."""
    out = []
    if "@" in text:
        out += [(0, a, b) for a, b in _emails(text)]
    if _DIGIT.search(text):
        out += [(1, a, b) for a, b in _ips(text)]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append((2, m.start(), m.end()))
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


# ---- features


def _shape(word: str) -> str:
    """Digits become d, letters x, others stay; runs of letters shrink to one, runs of digits to their length up to 5."""
    out, last, run = [], "", 0
    for c in word:
        s = "d" if "0" <= c <= "9" else "x" if c.isalpha() else c
        run = run + 1 if s == last else 1
        if s == "d" and run <= 5 or s != last:
            out.append(s)
        last = s
    return "".join(out)


def features(word: str) -> list[str]:
    """Names of the shape features of a word; a plain word (no digit, @, brackets) has one of a few fixed sets."""
    core = word.strip(".,;:!?\"'")
    if not re.search(r"[0-9@\[\]()<>+]", word):
        case = "lower" if core.islower() else "upper" if core.isupper() else "title" if core[:1].isupper() else "none"
        f = [f"plain {case}", f"ends {word[-1:] in '.!?,;:'}"]
        if re.fullmatch(r"[A-Za-z0-9._%+-]+\.[A-Za-z]{2,6}", core):
            f.append("host")
        return f
    digits = sum("0" <= c <= "9" for c in core)
    size = next(n for n, most in (("0", 0), ("1-2", 2), ("3", 3), ("4", 4), ("5-6", 6), ("7", 7), ("8-9", 9), ("10", 10), ("11-12", 12), ("13-15", 15), ("16-19", 19), ("20+", 10**9)) if digits <= most)
    f = ["marked", f"shape {_shape(core)}", f"digits {size}", f"all {core.isdigit()}", f"letters {any(c.isalpha() for c in core)}"]
    f += [f"has {c}" for c in "@[]()-.+" if c in core]
    if core.lower() in ("[at]", "(at)", "[dot]", "(dot)"):
        f.append(f"word {core.lower()[1:-1]}")
    if re.search(r"\[(at|dot|\.)\]|\((at|dot)\)", core.lower()):
        f.append("defanged")
    if re.fullmatch(r"(\(\d{3}\)|\d{3})[-.]\d{3}[-.]\d{4}", core):
        f.append("phone form")
        f.append(f"area {core.strip('(')[0] in '01'}")  # no area code begins with 0 or 1
    if re.fullmatch(r"\d{3}[-.]\d{4}", core):
        f.append("local form")
    if re.fullmatch(r"\(\d{3}\)", core):
        f.append(f"bracketed area {core[1] in '01'}")
    return f


#: Feature sets that plain words can have, for the proof in ``Field.quiet``.
PLAIN_SETS = [[f"plain {c}", f"ends {e}", *extra] for c in ("lower", "upper", "title", "none") for e in (True, False) for extra in ([], ["host"])]


def labelled_table() -> list[tuple[str, str]]:
    """The labelled sentences: tokens by spaces, and a label for each.  Made by rule, the same at each call."""
    rng = np.random.default_rng(20)
    fill = "the of and a to in on for with we they has was very good over under les una der sich mit pour call write from near office line today Please Contact Some".split()
    digits = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    first = lambda n: str(rng.integers(2, 10)) + digits(n - 1)
    name = lambda: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), rng.integers(3, 9)))
    octet = lambda: str(rng.integers(1, 255))
    tld = lambda: str(rng.choice(["com", "org", "net", "de"]))
    makers = [
        lambda: ([f"({first(3)})", f"{first(3)}-{digits(4)}"], "phone"),
        lambda: ([f"({first(3)})", first(3), digits(4)], "phone"),
        lambda: ([f"{first(3)}-{first(3)}-{digits(4)}"], "phone"),
        lambda: ([f"{first(3)}.{first(3)}.{digits(4)}"], "phone"),
        lambda: ([f"({first(3)}){first(3)}-{digits(4)}"], "phone"),
        lambda: ([f"+{first(1)}", f"({first(3)})", f"{first(3)}-{digits(4)}"], "phone"),
        lambda: ([f"+{first(11)}"], "phone"),
        lambda: ([f"{name()}.{digits(2)}@{name()}.{tld()}"], "email"),
        lambda: ([f"{name()}@{name()}.{tld()}"], "email"),
        lambda: ([name(), "[at]", name(), "[dot]", tld()], "email"),
        lambda: ([name(), "(at)", name(), "(dot)", tld()], "email"),
        lambda: ([f"{name()}[at]{name()}[dot]{tld()}"], "email"),
        lambda: ([f"{name()}(at){name()}.{tld()}"], "email"),
        lambda: ([f"{octet()}.{octet()}.{octet()}.{octet()}"], "ip"),
        lambda: ([f"{octet()}[.]{octet()}[.]{octet()}[.]{octet()}"], "ip"),
        lambda: (["4" + digits(15)], "card"),
        lambda: (["4" + digits(3), digits(4), digits(4), digits(4)], "card"),
        lambda: ([f"4{digits(3)}-{digits(4)}-{digits(4)}-{digits(4)}"], "card"),
    ]
    others = [
        lambda: [digits(1)], lambda: [digits(2)], lambda: [first(3)], lambda: ["19" + digits(2)], lambda: [f"20{digits(2)}-0{first(1)}-1{digits(1)}"], lambda: [f"{digits(2)}.{digits(2)}"],
        lambda: [f"{first(1)}.{digits(1)}.{digits(1)}"], lambda: [f"v{digits(1)}.{digits(2)}"], lambda: [f"[{digits(1)}]"], lambda: [f"({digits(2)})"], lambda: [f"${first(3)}"], lambda: [first(5)], lambda: [first(8)],
        lambda: [f"{name()}{digits(3)}{name()}{digits(4)}"], lambda: [f'"{digits(2)}{name()}{digits(5)}{name()}{digits(6)}"'], lambda: ["version", f"{digits(1)}.{digits(1)}"], lambda: ["at", digits(2)], lambda: [f"({name()})"], lambda: [f"[{name()}]"],
        lambda: ["@"], lambda: [f"@{name()}"], lambda: ["dot"], lambda: ["a", "dot", name()], lambda: [f"{first(3)},{digits(3)}"], lambda: [f"{digits(1)}-{digits(1)}"], lambda: [f"{first(4)}-{digits(2)}"], lambda: [first(3), first(3)], lambda: [first(20)],
        lambda: [f"{rng.integers(0, 2)}{digits(2)}.{first(3)}.{digits(4)}"], lambda: [f"{rng.integers(0, 2)}{digits(2)}-{first(3)}-{digits(4)}"], lambda: [f"({first(3)})", first(3)], lambda: [first(3), first(4)], lambda: [f"(19{digits(2)})", first(3), first(4)],
        lambda: [f"{name()}:{first(4)}"], lambda: [f"#{first(6)}"], lambda: [f"{name()}.{tld()}"], lambda: ["at", name()],
    ]
    rows = []
    words = lambda: [str(x) for x in rng.choice(fill, rng.integers(0, 6))]
    for k in range(6):
        for make in makers:
            got, kind = make()
            tail = str(rng.choice(["", "", ".", ","])) if k % 3 == 0 else ""
            before, after = words(), words()
            tokens = [*before, *got[:-1], got[-1] + tail, *after]
            labels = ["O"] * len(before) + [f"B-{kind}"] + [f"I-{kind}"] * (len(got) - 1) + ["O"] * len(after)
            rows.append((" ".join(tokens), " ".join(labels)))
        for make in others:
            tokens = [*words(), *make(), *words()]
            rows.append((" ".join(tokens), " ".join(["O"] * len(tokens))))
        for _ in range(10):
            rows.append((" ".join(w := [*words(), str(rng.choice(["the", "at", "End", "end.", "HERE,", "|", f"{name()}.{tld()}", "at,"])), *words()]), " ".join(["O"] * len(w))))
    return rows


class Field:
    """Weights of features of the word, the one before and the one after, and of label pairs."""

    PENALTY, STEPS, RATE = 5e-4, 120, 0.2

    def __init__(self, table: list[tuple[str, str]]):
        sentences = [(s.split(), y.split()) for s, y in table]
        self.names: dict[str, int] = {}
        for tokens, _ in sentences:
            for t in tokens:
                for f in features(t):
                    self.names.setdefault(f, len(self.names))
        n, k, longest = len(sentences), len(LABELS), max(len(t) for t, _ in sentences)
        size = len(self.names)
        used = np.zeros((n, longest, 3 * size), dtype=np.float32)
        gold = np.zeros((n, longest), dtype=np.int64)
        mask = np.zeros((n, longest), dtype=bool)
        for i, (tokens, labels) in enumerate(sentences):
            own = [[self.names[f] for f in features(t)] for t in tokens]
            for j in range(len(tokens)):
                used[i, j, own[j]] = 1
                if j:
                    used[i, j, [size + f for f in own[j - 1]]] = 1
                if j + 1 < len(tokens):
                    used[i, j, [2 * size + f for f in own[j + 1]]] = 1
                gold[i, j], mask[i, j] = LABELS.index(labels[j]), True
        w, t = np.zeros((3 * size, k)), np.zeros((k, k))
        moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
        flat = used.reshape(-1, 3 * size)
        for step in range(1, self.STEPS + 1):
            gw, gt = self._gradient(flat, used.shape[:2], gold, mask, w, t)
            for p, g, m, v in ((w, gw / n + self.PENALTY * w, *moments[:2]), (t, gt / n + self.PENALTY * t, *moments[2:])):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= self.RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        self.own, self.before, self.after, self.pairs = w[:size], w[size : 2 * size], w[2 * size :], t
        for a, x in enumerate(LABELS):
            for b, y in enumerate(LABELS):
                if y[0] == "I" and x[2:] != y[2:]:
                    self.pairs[a, b] = -1e3  # a kind goes on only after itself
        self.start = np.array([-1e3 if y[0] == "I" else 0.0 for y in LABELS])
        self.quiet = self._proved()

    @staticmethod
    def _gradient(flat, shape, gold, mask, w, t):
        n, longest = shape
        k = t.shape[0]
        e = (flat @ w).reshape(n, longest, k)
        alpha = np.zeros((longest, n, k))
        beta = np.zeros((longest, n, k))
        alpha[0] = e[:, 0]
        lse = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
        for j in range(1, longest):
            alpha[j] = np.where(mask[:, j, None], lse(alpha[j - 1][:, :, None] + t[None], 1) + e[:, j], alpha[j - 1])
        for j in range(longest - 2, -1, -1):
            beta[j] = np.where(mask[:, j + 1, None], lse(t[None] + (e[:, j + 1] + beta[j + 1])[:, None, :], 2), beta[j + 1])
        z = lse(alpha[-1], 1)
        p = np.exp(alpha + beta - z[None, :, None]).transpose(1, 0, 2) * mask[:, :, None]
        np.subtract.at(p, (np.arange(n)[:, None], np.arange(longest)[None], gold), mask.astype(float))
        gt = np.zeros_like(t)
        for j in range(1, longest):
            m = mask[:, j]
            q = np.exp(alpha[j - 1][m][:, :, None] + t[None] + (e[m, j] + beta[j][m])[:, None, :] - z[m][:, None, None]).sum(0)
            np.subtract.at(q, (gold[m, j - 1], gold[m, j]), 1.0)
            gt += q
        return flat.T @ p.reshape(-1, k), gt

    def vectors(self, word: str) -> np.ndarray:
        at = [self.names[f] for f in features(word) if f in self.names]
        return np.stack([self.own[at].sum(0), self.before[at].sum(0), self.after[at].sum(0)])

    def _proved(self) -> bool:
        """Whether no path over plain words scores as much as O throughout.

        Nodes are pairs of a plain feature set and a label; edges carry the label pair and what the two words give each
        other; all scores are relative to O.  Longest paths must not return to O, or end, at or above zero.
        """
        own, before, after = (np.stack([m[[self.names[f] for f in s if f in self.names]].sum(0) for s in PLAIN_SETS]) for m in (self.own, self.before, self.after))
        own, before, after = own - own[:, :1], before - before[:, :1], after - after[:, :1]
        c, k = own.shape
        edge = (self.pairs - self.pairs[0, 0])[None, :, None, :] + before[:, None, None, :] + after.T[None, :, :, None] + own[None, None]
        edge = edge.reshape(c * k, c * k)
        o = np.arange(0, c * k, k)
        begin = (own + self.start).reshape(-1)
        best = begin.copy()
        best[o] = 0.0
        leave = np.delete(np.arange(c * k), o)
        for _ in range(c * k):
            longer = np.maximum(best, (best[:, None] + edge).max(0))
            if (best[leave, None] + edge[np.ix_(leave, o)]).max() >= 0 or best[leave].max() >= 0:
                return False
            if (longer <= best + 1e-12).all():
                return True
            best = longer
        return False

    def decode(self, sentences: list[list[np.ndarray]]) -> list[np.ndarray]:
        """Best labels of each sentence; a sentence is a list of ``vectors`` of its words.  Ties go to the label listed first."""
        out: list[np.ndarray] = [np.zeros(0, np.int8)] * len(sentences)
        order = sorted(range(len(sentences)), key=lambda i: -len(sentences[i]))
        for a in range(0, len(order), 512):
            part = [i for i in order[a : a + 512] if sentences[i]]
            if not part:
                continue
            size = np.array([len(sentences[i]) for i in part])
            flat = np.concatenate([np.stack(sentences[i]) for i in part])
            first = np.cumsum(size) - size
            e = flat[:, 0].copy()
            e[1:] += flat[:-1, 1]
            e[first[1:]] -= flat[first[1:] - 1, 1]
            e[:-1] += flat[1:, 2]
            e[first[1:] - 1] -= flat[first[1:], 2]
            score, back = e[first] + self.start, np.zeros((len(flat), len(LABELS)), np.int8)
            final = score.copy()
            for j in range(1, size[0]):
                n = np.count_nonzero(size > j)
                step = final[:n, :, None] + self.pairs[None]
                at = first[:n] + j
                back[at] = step.argmax(1)
                final[:n] = step.max(1) + e[at]
            y = final.argmax(1)
            labels = np.zeros(len(flat), np.int8)
            for j in range(size[0] - 1, -1, -1):
                n = np.count_nonzero(size > j)
                at = first[:n] + j
                labels[at] = y[:n]
                y[:n] = np.where(j > 0, back[at, y[:n]], y[:n])
            for i, f, s in zip(part, first, size):
                out[i] = labels[f : f + s]
        return out


@lru_cache(maxsize=1)
def trained() -> Field:
    return Field(labelled_table())


def _plausible(kind: str, text: str) -> bool:
    digits = "".join(c for c in text if "0" <= c <= "9")
    if kind in ("phone", "card") and not re.fullmatch(r"[0-9+().\x20-]+", text):
        return False
    if kind == "phone":
        return 10 <= len(digits) <= 15 or 7 <= len(digits) and text[0] == "+"
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    if kind == "ip":
        parts = re.split(r"[^0-9]+", text.strip("[]()"))
        return len(parts) == 4 and all(p and int(p) <= 255 for p in parts)
    return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+\s*(@|\[at\]|\(at\)|\bat\b)\s*[A-Za-z0-9-]+(\s*(\.|\[dot\]|\(dot\)|\bdot\b)\s*[A-Za-z0-9-]+)+", text, re.I))


class Finder:
    """All spans of whole texts; remembers the vectors of words."""

    def __init__(self, field: Field):
        self.field, self.known = field, {}

    def _vectors(self, word: str) -> np.ndarray:
        v = self.known.get(word)
        if v is None:
            if len(self.known) > 100_000:
                self.known.clear()
            v = self.known[word] = self.field.vectors(word)
        return v

    def find(self, texts: list[str]) -> list[tuple[list, list]]:
        """For each text the base spans and the added spans, as (kind, start, end)."""
        found = [([], []) for _ in texts]
        where, sentences = [], []
        for d, text in enumerate(texts):
            at = 0
            while at < len(text):
                if self.field.quiet:
                    m = _ANCHOR.search(text, at)
                    hit = m.start() if m else -1
                    if hit < 0:
                        break
                else:
                    hit = at
                begin, end = text.rfind("\n", 0, hit) + 1, text.find("\n", hit)
                end = len(text) if end < 0 else end
                line = text[begin:end]
                found[d][0].extend((k, begin + a, begin + b) for k, a, b in base_spans(line))
                sentence: list = []
                for m in _TOKEN.finditer(line):
                    sentence.append((begin + m.start(), m[0]))
                    if m[0][-1] in ".!?" and not _DIGIT.search(m[0]):
                        self._take(sentence, d, where, sentences)
                        sentence = []
                self._take(sentence, d, where, sentences)
                at = end + 1
        for (d, tokens), labels in zip(where, self.field.decode(sentences)):
            if labels.any():
                found[d][1].extend(self._spans(texts[d], tokens, labels, found[d][0]))
        return found

    def _take(self, tokens: list, d: int, where: list, sentences: list) -> None:
        if tokens and (not self.field.quiet or any(_ANCHOR.search(t) for _, t in tokens)):
            where.append((d, tokens))
            sentences.append([self._vectors(t) for _, t in tokens])

    @staticmethod
    def _spans(text: str, tokens: list, labels: np.ndarray, base: list):
        i = 0
        while i < len(tokens):
            if labels[i] == 0:
                i += 1
                continue
            kind = LABELS[labels[i]][2:]
            j = i + 1
            while j < len(tokens) and LABELS[labels[j]] == f"I-{kind}":
                j += 1
            a, b = tokens[i][0], tokens[j - 1][0] + len(tokens[j - 1][1])
            while a < b and text[a] in "\"'<,;:":
                a += 1
            while b > a and text[b - 1] in "\"'>.,;:!?":
                b -= 1
            if a < b and _plausible(kind, text[a:b]) and not any(x < b and a < y for _, x, y in base):
                yield KINDS.index(kind), a, b
            i = j


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def find_spans(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns with n_email, n_ip, n_card, n_phone (base matches), base_sha256 and spans (base and added) of whole texts.

    Null and empty text: no spans.  Offsets are code points, ends exclusive.  Repeated documents are each answered; columns
    named like a result are replaced.  An added span that overlaps a base one is left out.
    """
    fields = [T.StructField(f"n_{k}", T.LongType()) for k in KINDS] + [T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())]
    shared = share(docs.sparkSession, trained())  # a few hundred features

    def make():
        finder = Finder(shared())

        def run(texts):
            found = finder.find([t.decode("utf-8", "replace") if t else "" for t in texts])
            counts = [[sum(s[0] == k for s in base) for base, _ in found] for k in range(4)]
            return [*counts, [hashlib.sha256(told(base).encode()).hexdigest() for base, _ in found], [told(base + added) for base, added in found]]

        return run

    names = [f.name for f in fields]
    return map_texts(docs, make, fields, [c for c in keep if c.lower() not in names])


def redact_text(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with spans replaced by ``[EMAIL]`` and so on; overlapping spans become one, named after the first."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans redacted in ``text`` and ``n_chars`` counted anew; null text stays null, empty text empty.

    Repeated rows are redacted alike, overlapping spans become one, and very long texts are taken whole.  Empty table: empty
    result.  Other columns stay as they were, whatever their names.
    """
    shared = share(docs.sparkSession, trained())

    def make():
        finder = Finder(shared())

        def run(texts):
            plain = [t.decode("utf-8", "replace") if t else "" for t in texts]
            return [[None if t is None else redact_text(p, [*base, *added]) for t, p, (base, added) in zip(texts, plain, finder.find(plain))]]

        return run

    made = free(docs, "__redacted")
    out = map_texts(docs, make, [T.StructField(made, T.StringType())], [c for c in docs.columns if c != "text"])
    chosen = [
        F.col(made).alias("text") if c == "text" else F.length(made).cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else column(out, c)
        for c in docs.columns
    ]
    return out.select(*chosen)
