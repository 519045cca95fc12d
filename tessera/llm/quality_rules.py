"""Quality rules: a threshold table compiled into one Spark projection.

Every rule is a row ``(name, metric, low, high)`` of ``RULES``: the metric is
an exact integer ratio ``weight * numerator / denominator`` and the text
passes when ``low <= ratio <= high``. ``compile_rules`` turns the table into
boolean columns over the metric columns; no user function runs.

Defined results: a null or empty text has no words, all its counts are 0 and
it fails the base rule. Repeated rows are judged alike, one row out per row
in; a null ``doc_id`` is passed through. An empty table gives an empty
result. Extra input columns are ignored by ``judge`` and kept by ``filter``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, free_name, let

SPLIT = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50

#: Frequent function words of the four languages of the tables.
STOP_WORDS = (
    "the and of to in is that with for it as on are by be this was at or an a "
    "la le les de des un une et est que qui dans en par pour sur au du avec pas il elle "
    "der die das und ist ein eine zu den von mit im nicht sich auf für dem es ich sie "
    "el los las y del por con para se su una lo como más al"
).split()

#: name, numerator, denominator, low and high percent of the ratio (None: open).
RULES = (
    ("symbol_ratio", "n_symbols", "word_chars", None, 7),
    ("word_length", "word_chars", "n_words", 200, 1500),
    ("stop_word_ratio", "n_stop_words", "n_words", 2, None),
    ("dup_line_ratio", "n_dup_lines", "n_lines", None, 50),
    ("digit_ratio", "n_digits", "word_chars", None, 30),
    ("bullet_line_ratio", "n_bullet_lines", "n_lines", None, 90),
)
#: A text of one line after another needs some lines before line ratios mean anything.
LINE_RULES = {"dup_line_ratio": 4, "bullet_line_ratio": 4}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
METRICS = BASE + ("n_lines", "n_stop_words", "n_digits", "n_bullet_lines")


def repeat_words(words: Column) -> Column:
    """Words inside a three-word window that the array holds twice or more.
    All window hashes distinct: none (equal windows have equal hashes). Else
    the windows whose hash repeats are sorted by text and place, equal
    neighbours are repeats, and the places cover three words each (overlaps
    counted once)."""
    def hashes(w):
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(w[i], w[i + 1], w[i + 2]).alias("h"), i.alias("i")))

    def twice(s):
        return F.filter(s, lambda x, j: (F.get(s, j + 1)["h"] == x["h"]) | (F.get(s, j - 1)["h"] == x["h"]))

    def named(s, w):
        return F.sort_array(F.transform(s, lambda x: F.struct(
            F.concat_ws(" ", w[x["i"]], w[x["i"] + 1], w[x["i"] + 2]).alias("t"), x["i"].alias("i"))))

    def repeated(s):
        hit = F.filter(s, lambda x, j: (F.get(s, j + 1)["t"] == x["t"]) | (F.get(s, j - 1)["t"] == x["t"]))
        return F.sort_array(F.transform(hit, lambda x: x["i"]))

    def covered(p):
        step = F.transform(p, lambda x, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(p, j - 1))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def count(w, s):
        keys = F.transform(s, lambda x: x["h"])
        return F.when(F.size(F.array_distinct(keys)) == F.size(s), F.lit(0)).otherwise(
            let(F.sort_array(s), lambda z: let(named(twice(z), w), lambda n: let(repeated(n), covered))))

    return let(words, lambda w: F.when(F.size(w) < 4, F.lit(0)).otherwise(let(hashes(w), lambda s: count(w, s))))


def metrics(text: Column) -> dict[str, Column]:
    """Integer metrics of a text, each a column over ``text``."""
    t = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(t, SPLIT, -1), "")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(HAS_WORD))
    return {
        "n_words": F.size(words),
        "word_chars": F.length(F.translate(t, SPACES, "")),
        "n_symbols": F.length(t) - F.length(F.translate(t, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))),
        "n_repeat_words": repeat_words(words),
        "n_lines": F.size(lines),
        "n_stop_words": F.size(F.filter(F.split(F.lower(t), SPLIT, -1), lambda w: w.isin(STOP_WORDS))),
        "n_digits": F.length(t) - F.length(F.translate(t, "0123456789", "")),
        "n_bullet_lines": F.size(F.filter(lines, lambda x: x.rlike(r"^[\x20\t]*[-*•]"))),
    }


def compile_rules(rules=RULES, at=F.col) -> Column:
    """One boolean column over the metrics (``at`` names one): all rules hold.
    A rule with a zero denominator, or under its least number of lines, holds."""
    def one(name, num, den, low, high):
        n, d = at(num) * 100, at(den)
        ok = F.lit(True)
        if low is not None:
            ok = ok & (n >= d * low)
        if high is not None:
            ok = ok & (n <= d * high)
        return ok | (d < LINE_RULES.get(name, 1))

    return reduce(lambda a, b: a & b, [one(*r) for r in rules], F.lit(True))


def base_failed(at=F.col) -> Column:
    return (at("n_words") < MIN_WORDS) | (at("n_repeat_words") * 100 > at("n_words") * 50)


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, the base counts, base_failed and kept, one row per document."""
    m = metrics(F.col("text"))
    rows = docs.select("doc_id", *[m[k].cast("long").alias(k) for k in METRICS])
    return rows.select("doc_id", *BASE, base_failed().alias("base_failed"),
                       (~base_failed() & compile_rules(rules)).alias("kept"))


def filter_docs(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns only."""
    name = free_name(docs, "quality")
    m = metrics(F.col("text"))
    judged = docs.withColumn(name, F.struct(*[m[k].cast("long").alias(k) for k in METRICS]))
    at = lambda k: F.col(name)[k]
    return judged.filter(~base_failed(at) & compile_rules(rules, at)).drop(name)
