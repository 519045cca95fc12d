"""PII by candidate gradient boosting.

The base rules (fixed patterns with validation) always mark their matches.
Beside them, high-recall generators propose overlapping candidate spans per
kind, also inside longer runs and in obfuscated spellings. Boosted regression
trees (logistic loss, depth 2, numpy) score each candidate from its format
and its context, Platt scaling on held-out examples calibrates the scores,
and per kind the lowest threshold (a half at least) with the wanted held-out
precision selects what is added. Of overlapping accepted candidates the likelier (then longer,
then earlier) stays; none may overlap a base span. An obfuscated address is proposed
with up to 64 characters before the @ and 63 a label, the limits of such
addresses; base spans know no limit. Time is linear in a text's length.

The model is trained on ``TRAIN_ROWS`` examples drawn from a seeded grammar
of positives and look-alikes (the tables have no labels of personal data); it
is the same at every size of input, and every candidate of every whole text
is scored.

Defined results: a null text is empty and has no spans. Repeated rows each
give a row, a null id is passed through, an empty table gives an empty
result. ``spans`` ignores columns but ``doc_id`` and ``text``; ``redact``
keeps all columns.
"""

from __future__ import annotations

import hashlib
import math
import re
from bisect import bisect_left
from functools import lru_cache
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches

KINDS = ("email", "ip", "card", "phone")
#: Fixed base patterns.
BASE = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Generators: look-ahead patterns propose a span at every place, overlaps included.
GENERATE = {
    "email": re.compile(r"(?<![A-Za-z0-9._%+-])(?=([A-Za-z0-9._%+-]{1,64}(?:@|\x20?(?:\(at\)|\[at\])\x20?|\x20at\x20)[A-Za-z0-9-]{1,63}(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?|\x20dot\x20)[A-Za-z0-9-]{1,63})+))"),
    "ip": re.compile(r"(?<![0-9.])(?=([0-9]{1,3}(?:\.[0-9]{1,3}){3})(?![0-9]))"),
    "card": re.compile(r"(?<![0-9])(?=([0-9]{4}(?:[\x20.-]?[0-9]{4}){2}[\x20.-]?[0-9]{1,7})(?![0-9]))"),
    "phone": re.compile(r"(?<![0-9A-Za-z+])(?=((?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,4}\)?){2,4})(?![0-9A-Za-z]))"),
    "secret": re.compile(r"(?<![A-Za-z0-9])(?=(AKIA[A-Z0-9]{16})(?![A-Za-z0-9]))"),
}
#: Phone numbers of two groups or with longer ones, of seven digits at least.
LONG_PHONE = re.compile(r"(?<![0-9A-Za-z+])(?=(?:[^0-9A-Za-z]{0,4}[0-9]){7})(?=((?:\+|00)?\(?[0-9]{1,5}(?:\)[\x20./-]{0,2}|[\x20./-]{1,2})(?:\(0\)[\x20./-]?)?\(?[0-9]{2,10}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,10}\)?){0,3})(?![0-9A-Za-z]))")
#: A keyword's value runs to the next white space or quote, however long it is.
SECRET_HEAD = re.compile(r"(?<![A-Za-z0-9])(?i:password|passwd|token|secret|api_key|apikey)[\x20]?[=:][\x20]?\"?")
VALUE_END = re.compile(r"[\s\"]")
#: Characters of a span that its features look at (its length is always the whole one).
SEEN = 512
ALL_KINDS = KINDS + ("secret",)
#: A text without any of these characters or words has no candidate of the kind.
NEEDS = {"email": ("@", "(at)", "[at]", " at "), "secret": ("AKIA", "=", ":")}
DIGIT = re.compile(r"[0-9]")
CUES = {
    "email": ("mail", "contact", "write", "reach", "@"), "ip": ("ip", "host", "server", "address", "addr"),
    "card": ("card", "visa", "credit", "pay", "cc"), "phone": ("phone", "tel", "call", "fax", "mobile", "cell"),
    "secret": ("key", "password", "token", "secret", "akia"),
}
LOOKALIKE_CUES = ("version", "release", "section", "isbn", "order", "page", "chapter", "rfc", "build", "id")

ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
TRAIN_ROWS = 6000
SEED = 7
TREES, RATE, PRECISION = 40, 0.3, 0.98


# base rules -----------------------------------------------------------------

def luhn(digits: str) -> bool:
    odd = sum(int(c) for c in digits[-1::-2])
    even = sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(c)] for c in digits[-2::-2])
    return (odd + even) % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


VALID = {
    "email": lambda s: True,
    "ip": octets,
    "card": lambda s: 12 <= len(d := digits_of(s)) <= 19 and luhn(d),
    "phone": lambda s: 9 <= len(digits_of(s)) <= 15,
}


#: The same matches as ``BASE`` in time linear in the text. An address has its
#: own @; four dotted numbers begin where a run of digits begins.
LOCAL, DOMAIN = re.compile(r"[A-Za-z0-9._%+-]+"), re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
DOTTED = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")


def emails(text: str):
    """(start, end) of what the base pattern finds: from each @ its local part
    is read backwards, as far as the match before it or the @ before it."""
    free, at = 0, text.find("@")
    while at >= 0:
        local = LOCAL.match(text[free:at][::-1])
        domain = local and DOMAIN.match(text, at + 1)
        if domain:
            yield at - local.end(), domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", at + 1)


def base_matches(kind: str, text: str):
    if kind == "email":
        return emails(text)
    return (m.span() for m in (DOTTED if kind == "ip" else BASE[kind]).finditer(text))


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base rules, by start and kind order."""
    out = []
    has_digit = DIGIT.search(text) is not None
    for kind in KINDS:
        if kind == "email" and "@" not in text or kind != "email" and not has_digit or kind == "phone" and "+" not in text:
            continue
        valid = VALID[kind]
        out += [(a, b, kind) for a, b in base_matches(kind, text) if valid(text[a:b])]
    return sorted(out, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


# candidates -----------------------------------------------------------------

def keyword_secrets(text: str):
    """Spans from a keyword to the end of its value; keywords within a value
    share its end, which is looked up once."""
    end = -1
    for m in SECRET_HEAD.finditer(text):
        if end < m.end():
            stop = VALUE_END.search(text, m.end())
            end = stop.start() if stop else len(text)
        if end - m.end() >= 8:
            after = text[end + 1:end + 2]
            closed = text[end:end + 1] == '"' and not (after.isascii() and after.isalnum())
            yield m.start(), end + closed, "secret"


def candidates(text: str) -> list[tuple[int, int, str]]:
    out = []
    has_digit = DIGIT.search(text) is not None
    for kind in ALL_KINDS:
        need = NEEDS.get(kind)
        if (need and not any(x in text for x in need)) or (not need and not has_digit):
            continue
        out += [(m.start(1), m.end(1), kind) for m in GENERATE[kind].finditer(text)]
        if kind == "secret":
            out += keyword_secrets(text)
        if kind == "phone":
            out += [(m.start(1), m.end(1), kind) for m in LONG_PHONE.finditer(text)]
    return list(dict.fromkeys(out))


def shape(s: str, d: str, parts: list[str]) -> list[float]:
    """How the groups of a phone candidate are laid out."""
    n = [len(p) for p in parts]
    return [
        float(d[:1] == "0"), float(s[:2] == "00"), float(any(len(p) == 4 and p[:2] in ("19", "20") for p in parts)),
        n[0], n[1] if len(n) > 1 else 0.0, float("." in s), float("-" in s), float(n == [3, 3, 4]), float(7 <= len(d) <= 15),
    ]


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    s = text[start:min(end, start + SEEN)]
    before, after = text[max(0, start - 24):start].lower(), text[end:end + 12].lower()
    d = digits_of(s)
    others = [c for c in s if c not in "0123456789"]
    parts = [p for p in re.split(r"[^0-9]+", s) if p]
    value = s.split("=")[-1].split(":")[-1].strip('" ') if kind == "secret" else s
    freq = [value.count(c) / len(value) for c in set(value)] if value else [1.0]
    return [
        float(ALL_KINDS.index(kind)), end - start, len(d), len(others), len(parts),
        max([len(p) for p in parts], default=0), float(luhn(d)) if 12 <= len(d) <= 19 else -1.0,
        float(kind == "ip" and octets(s)), float(s[:1] == "+"), float("(" in s), float("@" in s),
        sum(c.isalpha() for c in s) / len(s), -sum(f * math.log2(f) for f in freq),
        float(any(c in before for c in CUES[kind])), float(any(c in before for c in LOOKALIKE_CUES)),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float(before[-1:] in "$€£#"),
        float(after.lstrip()[:1] in "%$€£"), len(set(d)) / (len(d) or 1),
        float(s[:4] == "AKIA"), *(shape(s, d, parts) if kind == "phone" else [0.0] * 9),
    ]


# training -------------------------------------------------------------------

def _examples(rows: int, seed: int):
    """(text, start, end, kind, label) of a seeded grammar."""
    import random

    rnd = random.Random(seed)
    word = lambda a=2, b=9: "".join(rnd.choice("abcdefghijklmnoprstuvwz") for _ in range(rnd.randint(a, b)))
    num = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    octet = lambda: str(rnd.randint(0, 255))
    first = lambda: rnd.choice("123456789")
    cased = lambda s: rnd.choice([s, s, s.upper(), s.capitalize()])
    mixed = lambda letters, n: "".join(rnd.choice(letters) for _ in range(n))

    def card(ok):
        while True:
            d = rnd.choice("3456") + num(15)
            if luhn(d) == ok:
                g = rnd.choice(["", " ", "-", "."])
                return g.join(d[i:i + 4] for i in range(0, 16, 4))

    positive = {
        "email": lambda: f"{word()}{rnd.choice(['', '.' + num(2)])}{rnd.choice([' at ', '(at)', '[at]', ' (at) '])}{word(3)}{rnd.choice(['.', ' dot ', '[dot]'])}com",
        "ip": lambda: ".".join(octet() for _ in range(4)),
        "card": lambda: card(True),
        "phone": lambda: rnd.choice([f"({num(3)}) {num(3)}-{num(4)}", f"{num(3)}-{num(3)}-{num(4)}", f"00{num(2)} {num(3)} {num(4)}", f"+{num(2)} {num(3)} {num(4)}",
                                     f"0{num(rnd.randint(2, 4))}{rnd.choice(' /-')}{first()}{num(rnd.randint(5, 7))}", f"(0{num(rnd.randint(2, 4))}) {first()}{num(rnd.randint(5, 7))}",
                                     f"+{num(2)} (0){num(rnd.randint(2, 3))} {first()}{num(rnd.randint(5, 7))}", f"00{num(2)} {num(rnd.randint(2, 3))} {first()}{num(rnd.randint(5, 7))}"]),
        "secret": lambda: rnd.choice(["AKIA" + mixed("ABCDEFGHIJKLMNOPQRSTUVWXYZ" + rnd.choice(["", "234567"]), 16),
                                      f"{cased('password')}={mixed('0123456789abcdef', 18)}", f'{cased("token")} = "{mixed("0123456789abcdef", 40)}"',
                                      f'{cased(rnd.choice(["token", "secret", "api_key", "apikey", "passwd"]))}{rnd.choice(["=", ": ", " = "])}{mixed(ALNUM, rnd.choice([16, 24, 40, 128, 200, 400]))}',
                                      f'{cased(rnd.choice(["token", "secret"]))}{rnd.choice(["=", ": ", " = "])}{".".join(mixed(ALNUM + "-_", rnd.randint(20, 120)) for _ in range(3))}']),
    }
    negative = {
        "email": lambda: f"{word()} at {word()}.{word().capitalize()}",
        "ip": lambda: rnd.choice([".".join([octet(), num(1), num(1), "999"]), ".".join(str(rnd.randint(256, 999)) for _ in range(4))]),
        "card": lambda: card(False),
        "phone": lambda: rnd.choice([f"{rnd.randint(1900, 2030)}-{num(2)}-{num(2)}", f"{num(2)}/{num(2)}/{num(4)}", f"{num(1)} {num(3)} {num(3)}", f"{num(4)} {num(4)} {num(4)} {num(4)}", f"{num(3)}.{num(3)}.{num(2)}",
                                     f"{rnd.randint(1900, 2030)}-{rnd.randint(1900, 2030)}", f"{first()}{num(3)}-{first()}{num(3)}", f"{first()}{num(4)}-{num(4)}",
                                     f"{num(1)}.{num(rnd.randint(6, 9))}", f"{rnd.randint(1900, 2030)}{rnd.choice('-/ ')}{num(rnd.randint(3, 8))}", f"97{rnd.choice('89')}-{num(10)}",
                                     f"{first()}{num(rnd.randint(0, 2))} {first()}{num(rnd.randint(5, 8))}"]),
        "secret": lambda: rnd.choice([f"password: {word(8, 12)}", f"token = {word(8, 12)}", f"secret: {word(8, 10)}",
                                      f"{cased(rnd.choice(['password', 'token', 'secret', 'api_key']))}{rnd.choice(['=', ': ', ' = '])}{word(8, 12)}",
                                      f"{cased(rnd.choice(['token', 'secret']))}: {rnd.choice('._-/').join(word(4, 9) for _ in range(rnd.randint(3, 30)))}"]),
    }
    made = 0
    while made < rows:
        kind, label = rnd.choice(ALL_KINDS), rnd.random() < 0.5
        s = (positive if label else negative)[kind]()
        cue = rnd.random()
        near = rnd.choice(CUES[kind]) if cue < (0.4 if label else 0.15) else rnd.choice(LOOKALIKE_CUES) if cue > (0.95 if label else 0.6) else word()
        text = f"{word()} {near}{rnd.choice([':', '', ''])} {s} {word()}{rnd.choice(['.', ''])} {word()}"
        start = text.index(s, 2)
        hits = [c for c in candidates(text) if c[2] == kind and c[0] >= start - 1 and c[0] < start + len(s)]
        if hits:
            made += 1
            a, b, _ = max(hits, key=lambda c: c[1] - c[0])
            yield text, a, b, kind, label


def fit_trees(x, y, trees: int = TREES, rate: float = RATE):
    """Gradient boosting with depth-2 regression trees on the logistic loss."""
    import numpy as np

    def split(rows, grad, hess):
        best = (1e-9, None)
        g, h = grad[rows].sum(), hess[rows].sum()
        for f in range(x.shape[1]):
            order = rows[np.argsort(x[rows, f], kind="stable")]
            v, cg, ch = x[order, f], grad[order].cumsum(), hess[order].cumsum()
            cut = np.flatnonzero(v[1:] > v[:-1])
            if len(cut):
                gain = cg[cut] ** 2 / (ch[cut] + 1) + (g - cg[cut]) ** 2 / (h - ch[cut] + 1) - g ** 2 / (h + 1)
                i = int(gain.argmax())
                if gain[i] > best[0]:
                    best = (float(gain[i]), (f, float((v[cut[i]] + v[cut[i] + 1]) / 2)))
        return best[1]

    def grow(rows, grad, hess, depth):
        cut = split(rows, grad, hess) if depth and len(rows) > 20 else None
        if cut is None:
            return float(rate * grad[rows].sum() / (hess[rows].sum() + 1))
        left = x[rows, cut[0]] <= cut[1]
        return (*cut, grow(rows[left], grad, hess, depth - 1), grow(rows[~left], grad, hess, depth - 1))

    score, out, rows = np.zeros(len(y)), [], np.arange(len(y))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = grow(rows, y - p, p * (1 - p), 2)
        out.append(tree)
        score += np.array([_leaf(tree, r) for r in x])
    return out


def _leaf(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def raw_score(trees, row) -> float:
    return sum(_leaf(t, row) for t in trees)


@lru_cache(maxsize=4)
def train(rows: int = TRAIN_ROWS, seed: int = SEED):
    """(trees, (slope, intercept) of Platt scaling, threshold per kind)."""
    import numpy as np

    made = list(_examples(rows, seed))
    x = np.array([features(*r[:4]) for r in made])
    y = np.array([float(r[4]) for r in made])
    half = np.arange(len(y)) % 3 != 0
    trees = fit_trees(x[half], y[half])
    held = np.array([raw_score(trees, r) for r in x[~half]])
    target, a, b = y[~half], 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a * held + b)))
        a -= 0.5 * float(((p - target) * held).mean())
        b -= 0.5 * float((p - target).mean())
    prob = 1 / (1 + np.exp(-(a * held + b)))
    limits = {}
    for k, kind in enumerate(ALL_KINDS):
        mine = x[~half][:, 0] == k
        order = np.argsort(-prob[mine], kind="stable")
        p, good = prob[mine][order], target[mine][order].cumsum() / np.arange(1, mine.sum() + 1)
        ok = np.flatnonzero(good >= PRECISION)
        limits[kind] = max(0.5, float(p[ok[-1]])) if len(ok) else 2.0
    return trees, (a, b), limits


class Covered:
    """Spans, to be asked whether one meets another."""

    def __init__(self, spans):
        spans = sorted((s, e) for s, e, _ in spans)
        self.starts = [s for s, _ in spans]
        self.furthest = list(accumulate((e for _, e in spans), max))

    def meets(self, start: int, end: int) -> bool:
        at = bisect_left(self.starts, end)
        return at > 0 and self.furthest[at - 1] > start


def added_spans(text: str, base, model) -> list[tuple[int, int, str]]:
    """Accepted candidates, likelier first, none overlapping base or another."""
    found = candidates(text)
    if not found:
        return []
    trees, (a, b), limits = model
    scored, of_base = [], Covered(base)
    for s, e, kind in found:
        if of_base.meets(s, e):
            continue
        p = 1 / (1 + math.exp(-max(-60.0, min(60.0, a * raw_score(trees, features(text, s, e, kind)) + b))))
        if p >= limits[kind]:
            scored.append((-p, s - e, s, e, kind))
    kept: list[tuple[int, int, str]] = []
    starts: list[int] = []  # of kept spans and, with their ends, in order: they don't overlap
    ends: list[int] = []
    for _, _, s, e, kind in sorted(scored):
        at = bisect_left(starts, e)
        if not at or ends[at - 1] <= s:
            kept.append((s, e, kind))
            starts.insert(at, s)
            ends.insert(at, e)
    return kept


def all_spans(text: str, model) -> tuple[list, list]:
    """(base spans, all spans), by start, then kind as listed."""
    base = base_spans(text)
    more = added_spans(text, base, model)
    return base, sorted(base + more, key=lambda x: (x[0], ALL_KINDS.index(x[2]), x[1]))


def written(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def mask(text: str, spans) -> str:
    """The text with each span, or run of overlapping ones, replaced by the
    name of its first kind."""
    out, at, i = [], 0, 0
    while i < len(spans):
        s, e, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] < e:
            e = max(e, spans[i][1])
            i += 1
        out += [text[at:s], f"<{kind.upper()}>"]
        at = e
    return "".join(out) + text[at:]


# Spark ----------------------------------------------------------------------

def _spans(model):
    def run(batches):
        import pyarrow as pa

        for b in batches:
            rows = []
            for doc, t in zip(b.column("doc_id").to_pylist(), b.column("text")):
                base, every = all_spans(t.as_py() or "", model)
                count = [sum(k == kind for _, _, k in base) for kind in KINDS]
                rows.append((doc, *count, hashlib.sha256(written(base).encode()).hexdigest(), written(every)))
            types = [pa.int64()] * 5 + [pa.string()] * 2
            cols = list(zip(*rows)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"])
    return run


def spans(docs: DataFrame) -> DataFrame:
    """doc_id, base counts, base_sha256 and all spans of each document."""
    bounded_batches(docs.sparkSession)
    schema = "doc_id long, " + "".join(f"n_{k} long, " for k in KINDS) + "base_sha256 string, spans string"
    return docs.selectExpr("cast(doc_id AS long) AS doc_id", "text").mapInArrow(_spans(train()), schema)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with all spans of ``text`` replaced; ``n_chars``, where there
    is one, follows the new text; a null text stays null."""
    bounded_batches(docs.sparkSession)
    model, at = train(), docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            texts = []
            for t in b.column(at):
                s = t.as_py()
                texts.append(s if not s else mask(s, all_spans(s, model)[1]))
            yield b.set_column(at, b.schema.field(at), pa.array(texts, b.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
