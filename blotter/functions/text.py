"""Text column expressions: block-name cleaning and display case.

Everything here is a built-in Spark expression (higher-order functions over
``split`` arrays): evaluated in the JVM, without a Python worker.  (Lambdas
over arrays are interpreted there, not compiled into generated code.)  Words are split on a single space and empty
words are kept, so spacing survives exactly as in the input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _words(c: Column) -> Column:
    return F.split(c, " ", -1)


def _join(words: Column) -> Column:
    return F.array_join(words, " ")


def unwrap_quoted(c: str | Column) -> Column:
    """A block starting with a double quote keeps only the text between it
    and the next double quote (or the end).  Others are unchanged; an
    empty string stays empty."""
    c = _col(c)
    inner = F.substring_index(F.substr(c, F.lit(2)), '"', 1)
    return F.when(c.startswith('"'), inner).otherwise(c)


def drop_masked_words(c: str | Column) -> Column:
    """Drop every word that starts with a digit and contains ``x`` (masked
    house numbers like ``10xx``) and every word equal to ``x``."""
    def keep(w: Column) -> Column:
        masked_number = w.rlike("^[0-9]") & (F.instr(w, "x") > 0)
        return ~(masked_number | (w == "x"))
    return _join(F.filter(_words(_col(c)), keep))


def before_alias(c: str | Column) -> Column:
    """Text before the first ``/`` (an alias follows it); trailing space is
    kept."""
    return F.substring_index(_col(c), "/", 1)


def ordinal(word: Column) -> Column:
    """All-digit word -> ordinal number text: leading zeros are dropped
    (``007`` -> ``7th``); 11th-13th of every hundred take ``th``; otherwise
    the last digit picks ``st``/``nd``/``rd``/``th``.  Works for digit
    strings of any length (no numeric overflow)."""
    digits = F.regexp_replace(word, "^0+(?=[0-9])", "")
    last_two = F.right(digits, F.lit(2)).cast("int")
    last = last_two % 10
    teen = (last_two % 100 >= 11) & (last_two % 100 <= 13)
    suffix = (
        F.when(teen, F.lit("th"))
        .when(last == 1, F.lit("st"))
        .when(last == 2, F.lit("nd"))
        .when(last == 3, F.lit("rd"))
        .otherwise(F.lit("th"))
    )
    return F.concat(digits, suffix)


def normalise_words(c: str | Column) -> Column:
    """``av`` -> ``ave``; an all-digit word -> its ordinal."""
    def fix(w: Column) -> Column:
        return (
            F.when(w == "av", F.lit("ave"))
            .when(w.rlike("^[0-9]+$"), ordinal(w))
            .otherwise(w)
        )
    return _join(F.transform(_words(_col(c)), fix))


def drop_full_masks(c: str | Column) -> Column:
    """Drop words equal to ``xxxx`` (a fully masked street)."""
    return _join(F.filter(_words(_col(c)), lambda w: w != "xxxx"))


def clean_block(c: str | Column) -> Column:
    """Block-name cleaning chain, in fixed order: unwrap quotes, drop masked
    words, cut the alias, normalise words, drop full masks.  Expects
    lower-cased text; an all-masked block ends as ``''`` and is kept."""
    return drop_full_masks(normalise_words(before_alias(drop_masked_words(unwrap_quoted(c)))))


def capitalize(c: str | Column) -> Column:
    """First letter upper case, the rest lower case (``other theft`` ->
    ``Other theft``)."""
    c = _col(c)
    return F.concat(F.upper(F.substr(c, F.lit(1), F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def title_hyphenated(c: str | Column) -> Column:
    """Title case that also breaks on hyphens (``grandview-woodland`` ->
    ``Grandview-Woodland``; ``kensington-cedar cottage`` ->
    ``Kensington-Cedar Cottage``)."""
    return F.array_join(F.transform(F.split(_col(c), "-", -1), lambda p: F.initcap(p)), "-")
