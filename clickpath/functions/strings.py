"""String Column helpers with the reference's Java string semantics."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java String.trim() strips every char <= U+0020, not only spaces. ``\z`` is the
# true end of input (``$`` would also match before a final line terminator).
_JAVA_BLANK = r"^[\x00-\x20]*\z"


def is_not_empty(c: Column) -> Column:
    """Not null and not blank after Java ``trim`` (F2)."""
    return c.isNotNull() & ~c.rlike(_JAVA_BLANK)


def java_split(c: Column, delim: str) -> Column:
    """``String.split`` by a literal delimiter.

    Java keeps inner empty fields but drops trailing ones; ``""`` gives one
    empty field and an all-delimiter string gives none. Spark's ``split`` keeps
    trailing empties, so strip trailing delimiters first. Null stays null.
    """
    pattern = re.escape(delim)
    if len(delim) == 1:
        stripped = F.rtrim(c, F.lit(delim))     # no regex for the common case
    else:
        stripped = F.regexp_replace(c, f"({pattern})+\\z", "")
    return (F.when((c != F.lit("")) & (stripped == F.lit("")), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, pattern)))


def java_split_lines_words(text: Column) -> Column:
    """All words of a text as one array: lines at ``\\n``, then ``java_split`` on
    one space. For row pipelines prefer exploding lines, then words (see
    ``operators.words``): higher-order functions run interpreted.
    """
    return F.flatten(F.transform(F.split(text, "\n"), lambda line: java_split(line, " ")))


def substring0(c: Column, start: int, end: int | None = None) -> Column:
    """Java ``substring(start[, end])`` with 0-based, end-exclusive bounds."""
    if end is None:
        return F.substring(c, start + 1, 2**31 - 1)
    return F.substring(c, start + 1, end - start)


def concat_key(sep: str, *cols: Column) -> Column:
    """Delimiter-joined key, ``a + sep + b`` (X8). Prefer separate columns."""
    return F.concat_ws(sep, *[c.cast("string") for c in cols])
