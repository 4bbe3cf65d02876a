"""Projection / predicate operators (P-series): key normalisation, value
filters and activity-code expansion. Pure column expressions; every filter
is a Catalyst predicate, so it reaches the scan when the input is a file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_any_ci, fixed_width_key


def exclude_substrings(df: DataFrame, column: str, patterns: Sequence[str],
                       keep_null: bool = False) -> DataFrame:
    """Drop rows whose ``column`` contains any pattern (case-insensitive).

    Under SQL three-valued logic a null ``column`` also drops the row; pass
    ``keep_null=True`` to keep those rows instead.
    """
    if not patterns:
        return df
    cond = ~contains_any_ci(column, patterns)
    if keep_null:
        cond = cond | F.col(column).isNull()
    return df.filter(cond)


def upper_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """P5: upper-case a list of columns."""
    return df.withColumns({c: F.upper(F.col(c)) for c in columns})


def entity_key(df: DataFrame, person_id: str, org_id: str, out: str = "tin",
               person_width: int = 12, org_width: int = 10,
               person_reg: str | None = None, org_reg: str | None = None,
               reg_out: str = "reg_number") -> DataFrame:
    """P6 + P7: fixed-width ids (left-padded with ``0``, longer ones cut by
    ``lpad``) and one entity key: the person id when present, else the
    organisation id; the same for registration numbers when given."""
    df = df.withColumns({
        person_id: fixed_width_key(person_id, person_width),
        org_id: fixed_width_key(org_id, org_width),
    })
    cols = {out: F.coalesce(F.col(person_id), F.col(org_id))}
    if person_reg and org_reg:
        cols[reg_out] = F.coalesce(F.col(person_reg), F.col(org_reg))
    return df.withColumns(cols)


def fill_when_null_and_in(df: DataFrame, target: str, source: str,
                          values: Sequence[str]) -> DataFrame:
    """``target := source`` where ``source`` is one of ``values`` and
    ``target`` is null (federal cities: the region is the settlement)."""
    cond = F.col(source).isin(list(values)) & F.col(target).isNull()
    return df.withColumn(target, F.when(cond, F.col(source)).otherwise(F.col(target)))


def override_values(df: DataFrame, match_col: str, target: str,
                    fixes: Mapping[str, str]) -> DataFrame:
    """Exact-match manual overrides ``target := fixes[match_col]``."""
    if not fixes:
        return df
    expr = F.col(target)
    for search, replace in reversed(list(fixes.items())):
        expr = F.when(F.col(match_col) == search, F.lit(replace)).otherwise(expr)
    return df.withColumn(target, expr)


def normalized_difference(a: str, b: str):
    """``(a - b) / (a + b)``; a zero denominator gives null."""
    return F.try_divide(F.col(a) - F.col(b), F.col(a) + F.col(b))


# ------------------------------------------------------------------ P3
def expand_codes(classifier: DataFrame, codes: Sequence[str],
                 group_col: str = "group", code_col: str = "code") -> DataFrame:
    """P3 expansion: requested codes -> set of classifier codes.

    A single capital letter selects every code of that group; anything else
    selects the codes starting with it; a request that selects nothing is
    kept as is. Blank/null classifier codes never qualify. Returns one
    column ``code_col`` (distinct). ``codes`` is the user's request list.
    """
    requested = [c.strip() for c in codes if c is not None and c.strip()]
    valid = classifier.filter(F.col(code_col).isNotNull()
                              & (F.trim(F.col(code_col)) != ""))

    def pred(c: str):
        if len(c) == 1 and "A" <= c <= "Z":
            return F.col(group_col) == c
        return F.col(code_col).startswith(c)

    if not requested:
        return valid.select(code_col).limit(0)
    preds = [pred(c) for c in requested]
    hits = valid.filter(_any(preds)).select(code_col)
    # Requests that matched nothing, as a one-row aggregate -> rows.
    flags = valid.agg(*[F.coalesce(F.max(p.cast("int")), F.lit(0)).alias(f"_m{i}")
                        for i, p in enumerate(preds)])
    missing = flags.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias(code_col), F.col(f"_m{i}").alias("_m"))
        for i, c in enumerate(requested)])).alias("_r")).filter("_r._m = 0").select(
            F.col(f"_r.{code_col}").alias(code_col))
    return hits.unionByName(missing).distinct()


def filter_by_codes(df: DataFrame, column: str, classifier: DataFrame,
                    codes: Sequence[str] | None, code_col: str = "code",
                    group_col: str = "group") -> DataFrame:
    """P3 filter: keep rows whose ``column`` is in the expanded code set
    (exact membership). No codes -> no filter. The code set is bounded by
    the classifier, a dimension: broadcast after a bounded check."""
    if not codes:
        return df
    from .dedupe import broadcast_if_bounded
    wanted = expand_codes(classifier, codes, group_col, code_col)
    return df.join(broadcast_if_bounded(wanted.withColumnRenamed(code_col, column)),
                   on=column, how="left_semi")


def _any(preds):
    out = preds[0]
    for p in preds[1:]:
        out = out | p
    return out
