"""Column expressions (all JVM-side, codegen-friendly; no Python UDFs)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def canonical_text(c: Column | str) -> Column:
    """Upper case and fold ``Ё`` into ``Е``."""
    return F.translate(F.upper(_c(c)), "Ё", "Е")


def join_name_and_type(name: Column | str, type_: Column | str,
                       prepend_types: Sequence[str] = ()) -> Column:
    """P10: ``"<type> <name>"`` when the type is in ``prepend_types``,
    else ``"<name> <type>"``; null when either part is null."""
    n, t = _c(name), _c(type_)
    joined = F.concat(n, F.lit(" "), t)
    if prepend_types:
        joined = F.when(t.isin(list(prepend_types)),
                        F.concat(t, F.lit(" "), n)).otherwise(joined)
    return F.when(n.isNotNull() & t.isNotNull(), joined)


def join_area_and_type(area: Column | str, type_: Column | str,
                       rules: Sequence[tuple[str, str, str]]) -> Column:
    """Render an area with its type by ``(type, prefix, suffix)`` rules;
    other types leave the area as is; null when either part is null."""
    a, t = _c(area), _c(type_)
    expr = a
    for code, prefix, suffix in reversed(list(rules)):
        expr = F.when(t == code, F.concat(F.lit(prefix), a, F.lit(suffix))).otherwise(expr)
    return F.when(a.isNotNull() & t.isNotNull(), expr)


def raw_address(parts: Sequence[Column | str], sep: str = " / ") -> Column:
    """P20: render address parts, nulls as empty strings."""
    return F.concat_ws(sep, *[F.coalesce(_c(p), F.lit("")) for p in parts])


def fixed_width_key(c: Column | str, width: int, pad: str = "0") -> Column:
    """Left-pad to ``width``; longer input is cut to ``width`` (lpad)."""
    return F.lpad(_c(c), width, pad)


def contains_any_ci(c: Column | str, patterns: Sequence[str]) -> Column:
    """P4 helper: case-insensitive "contains any of" (null input -> null)."""
    col = _c(c)
    return reduce(lambda a, b: a | b,
                  [col.ilike(f"%{p}%") for p in patterns])


def last_path_component(c: Column | str) -> Column:
    """text after the last ``/``."""
    return F.substring_index(_c(c), "/", -1)


def similarity(a: Column | str, b: Column | str) -> Column:
    """edit similarity on 0..100: ``100 * (1 - lev(a,b) / max(len))``.

    Two empty strings are identical (100).
    """
    x, y = _c(a), _c(b)
    longest = F.greatest(F.length(x), F.length(y))
    return F.when(longest == 0, F.lit(100.0)).otherwise(
        100.0 * (1.0 - F.levenshtein(x, y) / longest))


def strip_words(c: Column | str, words: Sequence[str]) -> Column:
    """Remove each word in list order (literal, not regex), then trim."""
    col = _c(c)
    for w in words:
        col = F.replace(col, F.lit(w), F.lit(""))
    return F.trim(col)


def flatten_multi(arr: Column | str, sep: str = ",") -> Column:
    """0 values -> null, 1 -> the value, n -> joined with ``sep``."""
    a = _c(arr)
    return F.when(F.size(a) > 0, F.concat_ws(sep, a))


def is_digits(c: Column | str) -> Column:
    """F9 ``isdigit``: non-empty and only decimal digits."""
    return _c(c).rlike("^[0-9]+$")
