"""Cell cleaning: suppression markers, lenient numbers, header names."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def strip_marker(col, marker: str = "<") -> Column:
    """Remove every literal ``marker`` ("<5" -> "5").  NULL stays NULL."""
    return F.replace(_c(col), F.lit(marker), F.lit(""))


def lenient_number(col) -> Column:
    """Text -> double; anything that is not a number becomes NULL."""
    return _c(col).try_cast("double")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once: a lambda variable is not
    inlined into nested lambdas as a projected expression is."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _latin_base() -> tuple[str, str]:
    """Accented Latin letters and the plain letters that their decomposition starts with."""
    pairs = [(chr(i), unicodedata.normalize("NFD", chr(i))[0]) for i in range(0xC0, 0x250)]
    pairs = [(c, d) for c, d in pairs if d.isascii() and c != d]
    return "".join(c for c, _ in pairs), "".join(d for _, d in pairs)


ACCENTED, PLAIN = _latin_base()


def _clean_one(name: Column) -> Column:
    s = F.translate(F.trim(name), ACCENTED, PLAIN)
    s = F.regexp_replace(s, "[\"'\u2018\u2019\u201c\u201d]", "")
    s = F.regexp_replace(s, "([A-Z]+)([A-Z][a-z])", "$1_$2")   # "ABCDef" -> "ABC_Def"
    s = F.regexp_replace(s, "([a-z0-9])([A-Z])", "$1_$2")      # "JobSeeker" -> "Job_Seeker"
    s = F.lower(s)
    s = F.regexp_replace(s, "%", "_percent_")
    s = F.regexp_replace(s, "#", "_number_")
    s = F.regexp_replace(s, "[^a-z0-9]+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    return F.when(s.rlike("^[0-9]"), F.concat(F.lit("x"), s)).otherwise(s)


def clean_header_names(names) -> Column:
    """Array of raw header cells -> array of snake_case column names.

    Per position ``p`` (1-based): a blank or NULL cell becomes ``x<p>``; a label
    that occurs more than once in the same header gets ``_<p>`` appended; every
    other label loses its quotes and accents, has ``%`` and ``#`` spelled out,
    is split at camelCase boundaries and lower-cased; runs of other characters
    become one ``_``, and a leading digit gets an ``x`` prefix.
    Labels that only collide after cleaning ("a b", "a_b") are numbered from
    their second occurrence on ("a_b", "a_b_2"); a numbered name that still
    meets an earlier name gets its position ("a_b_2_p3"), so names repeat only
    if a label is itself spelled like such a generated name.  Works on the whole
    header in one row, so no shuffle is needed however many sheets are
    processed; each step's array is built once (``let``).
    """
    def cleaned(labels: Column) -> Column:
        def one(h, i):
            pos = (i + 1).cast("string")
            return let(_clean_one(h), lambda base: F.when(h.isNull() | (base == ""), F.concat(F.lit("x"), pos))
                       .when(F.size(F.filter(labels, lambda o: o == h)) > 1, F.concat(base, F.lit("_"), pos))
                       .otherwise(base))
        return F.transform(labels, one)

    def numbered(first: Column) -> Column:
        # names equal only after cleaning: 2nd, 3rd ... occurrence get _2, _3 ...
        def one(n, i):
            return let(F.size(F.filter(F.slice(first, 1, i), lambda o: o == n)) + 1, lambda k: F.when(
                k > 1, F.concat(n, F.lit("_"), k.cast("string"))).otherwise(n))
        return F.transform(first, one)

    def unique(second: Column) -> Column:
        # a generated name may still equal another label: later copies take
        # their position as a suffix
        def one(n, i):
            return F.when(F.array_contains(F.slice(second, 1, i), n),
                          F.concat(n, F.lit("_p"), (i + 1).cast("string"))).otherwise(n)
        return F.transform(second, one)

    trimmed = F.transform(_c(names), lambda h: F.trim(h))
    return let(let(let(trimmed, cleaned), numbered), unique)
