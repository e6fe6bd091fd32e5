"""Null/blank notions and the SCD2 change signature.

Three different notions of "empty" coexist and must not be mixed:

* pre-load blank (``blank_preload``): NULL, or a *string* that is empty after
  stripping every Unicode whitespace character (including the four
  information separators U+001C..U+001F);
* stored blank (``blank_stored``): NULL, or ``TRIM(CAST(x AS STRING)) = ''``
  where TRIM removes spaces only;
* change equality (``change_signature``): NULL and ``''`` compare equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: characters a Python-style strip() treats as whitespace, expressed
# as a Java regex ((?U) makes \s the Unicode White_Space class).
PRELOAD_BLANK_PATTERN = r"(?U)^[\s\x1c-\x1f]*$"


def blank_preload(c: Column, dtype: T.DataType | None = None) -> Column:
    """Missing before load: NULL, or a whitespace-only string. Non-strings are
    missing only when NULL."""
    if dtype is not None and not isinstance(dtype, T.StringType):
        return c.isNull()
    return c.isNull() | c.rlike(PRELOAD_BLANK_PATTERN)


def blank_stored(c: Column) -> Column:
    """Missing in a stored table: ``x IS NULL OR TRIM(CAST(x AS STRING)) = ''``."""
    return c.isNull() | (F.trim(c.cast("string")) == F.lit(""))


def change_signature(cols: Sequence[Column | str]) -> Column:
    """Struct of ``COALESCE(CAST(x AS STRING), '')``; two rows differ when any
    field differs. Never NULL, so ``!=`` on it is two-valued."""
    parts = []
    for i, c in enumerate(cols):
        col = F.col(c) if isinstance(c, str) else c
        parts.append(F.coalesce(col.cast("string"), F.lit("")).alias(f"a{i}"))
    return F.struct(*parts)


def truthy_flag(text: Column) -> Column:
    """JSON flag text to BOOLEAN, absent/NULL -> false. Under ANSI mode, text
    that is not a boolean literal raises, like a bad cast should."""
    return F.coalesce(text.cast("boolean"), F.lit(False))


def json_truthy(text: Column, raw: Column) -> Column:
    """Truthiness of a JSON value from its STRING-parsed ``text`` (strings
    unquoted, other tokens as source text; NULL when absent or null).

    The text alone decides unless it reads as a numeric zero or ``false``:
    then the token type matters (number 0 is falsy, string "0" is not), and
    the type of ``raw`` -- the same value as VARIANT -- is looked at, for those
    rows only: of such texts only strings are truthy."""
    ambiguous = (text == F.lit("false")) | F.coalesce(text.try_cast("double") == F.lit(0.0), F.lit(False))
    plain = text.isNotNull() & ~text.isin("", "[]", "{}")
    return F.when(ambiguous, F.schema_of_variant(raw) == F.lit("STRING")).otherwise(plain)


def first_truthy(*pairs: tuple[Column, Column]) -> Column:
    """Text of the first truthy value among ``(text, raw)`` pairs, else ``''``."""
    return F.coalesce(*[F.when(json_truthy(t, raw), t) for t, raw in pairs], F.lit(""))


def key_concat(*cols: Column, sep: str) -> Column:
    """NULL-propagating composite key (``concat_ws`` would drop a NULL part)."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(c)
    return F.concat(*parts)
