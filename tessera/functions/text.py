"""Text column expressions: tokeniser, word filters, byte-hash buckets.

All of these are built-in Spark expressions (JVM side, whole-stage codegen);
no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's word definition.
# Token separators are the five white-space characters of a default
# java.util.StringTokenizer; a token is lower-cased and loses every leading
# and trailing character outside a-z; empty tokens are dropped.
SEPARATORS = " \t\n\r\f"
STRIP_PATTERN = "(^[^a-z]+|[^a-z]+$)"
ALPHA_WORD = "^[A-Za-z]+$"
DEFAULT_REDUCERS = 5

# One regular-expression pass over the lower-cased text yields the same
# tokens: a token runs from the first a-z letter of a white-space separated
# chunk to its last a-z letter (interior characters are kept).
_TOKEN_PATTERN = r"[a-z](?:[^ \t\n\r\f]*[a-z])?"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def tokenize(text) -> Column:
    """FN-1: ``array<string>`` of normalised words of ``text``.

    Equivalent to split on white space -> lower -> strip non a-z at both
    ends -> drop empties, done as a single regex scan of the whole text.
    """
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(_TOKEN_PATTERN), 0)


def tokenize_stepwise(text) -> Column:
    """FN-1 written step by step (split, lower, strip, drop empties).

    Same result as :func:`tokenize`; kept as the literal definition and used
    by tests to check the one-pass form.
    """
    words = F.split(_col(text), "[ \\t\\n\\r\\f]+")
    stripped = F.transform(words, lambda w: F.regexp_replace(F.lower(w), STRIP_PATTERN, ""))
    return F.filter(stripped, lambda w: w != "")


def is_alpha_word(word) -> Column:
    """FN-4 / FLT-5: the whole word is ASCII letters."""
    return _col(word).rlike(ALPHA_WORD)


# White space stripped by FN-6 (``\r`` included; Spark's plain trim only
# removes spaces).
WHITESPACE = " \t\n\x0b\f\r"


def strip_ws(s) -> Column:
    """FN-6: trim every white-space character (``\\r`` included) at both ends."""
    return F.trim(_col(s), F.lit(WHITESPACE))


def byte_hash(s) -> Column:
    """31-polynomial hash over the signed UTF-8 bytes of ``s``, start 1, as int32.

    Returned as a non-negative BIGINT in [0, 2^32). The UTF-8 bytes are
    re-read as ISO-8859-1 text, one character per byte whose code point is
    the unsigned byte value; splitting that text into characters gives the
    byte sequence, folded by one ``aggregate`` (the array is built once,
    outside the lambda), so the whole expression stays in Spark SQL.
    """
    latin = F.decode(F.encode(_col(s), "UTF-8"), "ISO-8859-1")

    def step(h, ch):
        byte = F.ascii(ch).cast("long")
        signed = F.when(byte >= 128, byte - 256).otherwise(byte)
        return (h * 31 + signed).bitwiseAND(F.lit(0xFFFFFFFF))

    return F.when(
        F.length(latin) > 0,
        F.aggregate(F.split(latin, ""), F.lit(1).cast("long"), step),
    ).otherwise(F.lit(1).cast("long"))


def hash_bucket(s, n: int = DEFAULT_REDUCERS) -> Column:
    """SNK-6: the output part (0..n-1) a hash-partitioned job puts key ``s`` in."""
    return (byte_hash(s).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(n)).cast("int")
