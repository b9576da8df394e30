"""Scalar string, list and key functions (F4-F9, F11-F13), all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: characters kept in a title slug (Hangul jamo and syllables,
# digits, ASCII letters, '.', '-', '~' and space); everything else is removed.
SLUG_DROP_PATTERN = r"[^ㄱ-ㅎ가-힣0-9a-zA-Z.\-~ ]"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def split_trim(col, sep: str = ",") -> Column:
    """split on a separator and trim every item: all characters up to
    U+0020 go at both ends, as a JVM ``String.trim`` does."""
    import re
    return F.transform(F.split(_c(col), re.escape(sep)),
                       lambda x: F.regexp_replace(x, r"^[\x00-\x20]+|[\x00-\x20]+$", ""))


def split_drop_trailing(col, sep: str = "|") -> Column:
    """Split like a JVM ``String.split``: trailing empty items are dropped
    (``"a|b||"`` -> ``[a, b]``, ``"|"`` -> ``[]``, ``""`` -> ``[""]``)."""
    import re
    s = _c(col)
    trimmed = F.regexp_replace(s, f"(?:{re.escape(sep)})+$", "")
    return (F.when(s == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, re.escape(sep))))


def template_replace(col, placeholder: str, value) -> Column:
    """F5 plain form: every ``placeholder`` (e.g. ``{USER_NAME}``) replaced."""
    v = value if isinstance(value, Column) else F.lit(str(value))
    return F.replace(_c(col), F.lit(placeholder), v)


def template_replace_regex(col, pattern: str, value) -> Column:
    """F5 regex form: every match of ``pattern`` (e.g. ``\\{...\\}``) replaced."""
    v = value if isinstance(value, Column) else F.lit(str(value))
    return F.regexp_replace(_c(col), pattern, v)


def zero_pad(n, width: int) -> Column:
    """``%0<width>d``."""
    return F.format_string(f"%0{int(width)}d", _c(n))


def take_right(col, n: int, pad: str = "") -> Column:
    """last ``n`` characters of ``pad + text`` (``("000" + t).takeRight(3)``)."""
    return F.right(F.concat(F.lit(pad), _c(col)), F.lit(int(n)))


def keep_chars(col, drop_pattern: str = SLUG_DROP_PATTERN) -> Column:
    """remove every character matched by ``drop_pattern``."""
    return F.regexp_replace(_c(col), drop_pattern, "")


def prefix(col, n: int) -> Column:
    """F8: first ``n`` characters (``substring(0, n)``)."""
    return F.substring(_c(col), 1, int(n))


def char_at(col, index0: int) -> Column:
    """F8: the character at a 0-based index (``substring(i, i + 1)``)."""
    return F.substring(_c(col), int(index0) + 1, 1)


def strip_extension(col) -> Column:
    """F8: path without the text from its last ``.`` on."""
    return F.regexp_replace(_c(col), r"\.[^./]*$", "")


def extension(col) -> Column:
    """Text from the last ``.`` of the path (with the dot); NULL if none."""
    return F.nullif(F.regexp_extract(_c(col), r"(\.[^.]*)$", 1), F.lit(""))


def contains_ci(col, needle: str) -> Column:
    """case-blind ``contains``."""
    return F.lower(_c(col)).contains(needle.lower())


def first_present(*cols) -> Column:
    """first non-NULL value of an option chain."""
    return F.coalesce(*[_c(c) for c in cols])


def zip_shorter(a, b, names: tuple[str, str] = ("a", "b")) -> Column:
    """pairs of two lists, cut to the shorter list."""
    a, b = _c(a), _c(b)
    n = F.least(F.size(a), F.size(b))
    z = F.arrays_zip(a.alias(names[0]), b.alias(names[1]))
    return F.when(n <= 0, F.slice(z, 1, 0)).otherwise(F.slice(z, 1, n))


def list_minus(a, b) -> Column:
    """items of ``a`` not in ``b`` (order kept, duplicates removed)."""
    return F.array_except(_c(a), _c(b))
