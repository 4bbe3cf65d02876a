"""Dictionary lookups and the ordered waterfall match."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedupe import DEFAULT_BROADCAST_ROWS, drop_ambiguous, first_wins, is_bounded


# ------------------------------------------------------------------ A2+U1
def abbreviation_dictionary(abbr: DataFrame, short_col: str = "name",
                            full_col: str = "name_full",
                            order_col: str = "_row") -> DataFrame:
    """Build ``(name, name_full)`` from an abbreviation table.

    Three variants in priority order: short -> full, full -> full, and
    short + ``.`` -> full for shorts not already ending with a dot; all
    upper-cased; the first variant / earliest row wins a duplicate name.
    ``order_col`` is the table's row order (its file order).
    """
    base = abbr.select(F.col(short_col).alias("s"), F.col(full_col).alias("f"),
                       F.col(order_col).alias("_o"))
    variants = [
        base.select(F.col("s").alias("name"), "f", F.lit(0).alias("_p"), "_o"),
        base.select(F.col("f").alias("name"), "f", F.lit(1).alias("_p"), "_o"),
        base.filter(~F.col("s").endswith("."))
            .select(F.concat(F.col("s"), F.lit(".")).alias("name"), "f",
                    F.lit(2).alias("_p"), "_o"),
    ]
    allv = reduce(DataFrame.unionByName, variants)
    allv = allv.select(F.upper("name").alias("name"),
                       F.upper("f").alias("name_full"), "_p", "_o")
    return first_wins(allv, ["name"], ["_p", "_o"], ["name_full"])


# ------------------------------------------------------------------ J3
def dictionary_lookup(df: DataFrame, column: str, dictionary: DataFrame,
                      key_col: str = "name", value_col: str = "name_full",
                      broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Replace ``column`` by its dictionary expansion (upper-cased key);
    null when there is no entry. The dictionary must be unique on its key
    (``abbreviation_dictionary`` guarantees it), so the row count holds."""
    d = dictionary.select(F.col(key_col).alias("_dk"), F.col(value_col).alias("_dv"))
    # Bound checked on the dictionary itself (a projection keeps its row
    # count), so repeated lookups against one dictionary check it once.
    d = F.broadcast(d) if is_bounded(dictionary, broadcast_rows) else d
    out = df.join(d, F.upper(F.col(column)) == F.col("_dk"), "left")
    return out.withColumn(column, F.col("_dv")).drop("_dk", "_dv")


# ------------------------------------------------------------------ J4
@dataclass
class MatchPass:
    """One waterfall pass: address columns vs standard columns."""
    name: str
    left: Sequence[str]
    right: Sequence[str]
    standard: str                    # key into the ``standards`` mapping
    drop_null_keys: bool | None = None   # default: only for 2-column keys
    tag: str | None = None           # geo type written on a hit

    def drops_nulls(self) -> bool:
        if self.drop_null_keys is None:
            return len(self.right) == 2
        return self.drop_null_keys


def waterfall_match(addresses: DataFrame, standards: dict[str, DataFrame],
                    passes: Sequence[MatchPass], id_col: str = "id",
                    out_id: str = "geo_id", out_type: str = "geo_type",
                    out_pass: str = "match_pass",
                    broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """J4 + J5: ordered, null-safe key cascade; the first pass that hits wins.

    For each pass the standard loses every row whose key is ambiguous
    (A3, nulls equal), and -- for 2-column keys by default -- rows with a null
    key part. Then the addresses are left-joined on the null-safe key. As a
    pass never consumes its standard, all passes are independent and run as
    one chain of joins (no loop of anti joins); hits are coalesced in pass
    order. Standards of bounded size are broadcast, so the chain needs no
    shuffle of the address side at all.
    """
    bounded = {k: is_bounded(v, broadcast_rows) for k, v in standards.items()}
    out = addresses
    ids, tags = [], []
    for i, p in enumerate(passes):
        std = standards[p.standard].select(*p.right, F.col(id_col).alias("_gid"))
        std = drop_ambiguous(std, list(p.right))
        if p.drops_nulls():
            std = std.na.drop(subset=list(p.right))
        rk = [f"_k{i}_{j}" for j in range(len(p.right))]
        std = std.select(*[F.col(r).alias(k) for r, k in zip(p.right, rk)],
                         F.col("_gid").alias(f"_g{i}"))
        if bounded[p.standard]:
            std = F.broadcast(std)
        cond = reduce(lambda a, b: a & b,
                      [F.col(lc).eqNullSafe(F.col(k)) for lc, k in zip(p.left, rk)])
        out = out.join(std, cond, "left").drop(*rk)
        ids.append(F.col(f"_g{i}"))
        tags.append(p.tag or p.standard)
    hit_pass = F.coalesce(*[F.when(g.isNotNull(), F.lit(i + 1)) for i, g in enumerate(ids)])
    hit_type = F.coalesce(*[F.when(g.isNotNull(), F.lit(t)) for g, t in zip(ids, tags)])
    return (out.withColumns({out_id: F.coalesce(*ids), out_type: hit_type,
                             out_pass: hit_pass})
               .drop(*[f"_g{i}" for i in range(len(passes))]))


# ------------------------------------------------------------------ A9
def match_stats(matched: DataFrame, pass_col: str = "match_pass") -> DataFrame:
    """Hits per pass (null pass = unmatched) and what is left after it."""
    return matched.groupBy(pass_col).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ J6/A13
def unique_build_side(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A13 as a lazy check: fail the job if ``keys`` is not unique in ``df``.

    The check runs inside the same job (``assert_true`` on a per-key count),
    so a left join against the result cannot change the left row count.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                F.any_value(F.struct(*[F.col(c) for c in rest])).alias("_v"))
    msg = "join key not unique on the build side: " + ",".join(keys)
    return (agg.withColumn("_ok", F.assert_true(F.col("_n") == 1, F.lit(msg)))
               .filter(F.col("_ok").isNull())
               .select(*keys, "_v.*"))


def uniqueness_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A13 report: keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1))


def attach_checked(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Left join by key with the build side checked unique."""
    return left.join(unique_build_side(right, keys), on=list(keys), how=how)
