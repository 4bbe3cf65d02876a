"""Variable-capacity best-fit packing of documents into training sequences.

Several sequence lengths are permitted and planned jointly. Pieces (documents; a
longer one than the largest length is cut into pieces of that length and a rest) are
placed longest first. A piece goes into the open bin that it leaves the least room in; if
none has room, a bin is opened in the permitted length whose cost per token,
once it is filled with the largest pieces that still fit, is the least. Of bins with equal
room the one of least capacity is taken. At last
every bin is cut down to the smallest permitted length that holds its contents.

Two plans are made, and the one of least total cost is used (the first, if they are equal): the
first decides once per piece length; the second at every opened bin, with the pieces that no
bin opened before counts on as its filling.

Only lengths matter, and there are at most as many as the largest capacity. So the plan
is made on the *histogram* of piece lengths: bins of equal contents are one entry with a
multiplicity, and a whole run of equal pieces is placed in one step; a decision holds for as
many bins as it can be repeated for before any length's filling would change. The plan is
exactly that of placing piece by piece, for any number of documents, and the driver
holds at most ``capacity`` counts and a few entries for each.

Assignment. A piece's number among those of its length follows from counts per
(length, slice of the key's hash), a small table of offsets, and its number inside the slice;
so a length that a third of all pieces have is numbered by many tasks. The plan (runs of
numbers per length, bounded by the capacity) is joined back to the pieces.

Defined results: a null text counts as empty; a document without tokens is packed
nowhere and keeps one row with null bin; equal lengths are ordered by the key, then
by a hash of the text; repeated rows are packed each; an empty table gives an empty result.
Other columns are not read, so names cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import salt_count, written

#: Permitted sequence lengths, in tokens, and the fixed cost of a sequence in tokens.
CAPACITIES = (512, 1024, 2048, 4096)
OVERHEAD = 16
#: A token of the default measure: a word or a sign.
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def cost(capacity: int) -> int:
    return capacity + OVERHEAD


@dataclass
class Bins:
    """Bins of equal contents. ``runs``: (length, pieces of it in each bin, number of the first piece)."""
    capacity: int
    room: int
    count: int
    runs: list[tuple[int, int, int]] = field(default_factory=list)


def fillings(length: int, left: dict[int, int], lengths: list[int], capacities: Sequence[int]) -> list[tuple[float, int, dict[int, int]]]:
    """(cost per token, capacity, pieces by length) of a bin filled, largest first, with pieces still to place."""
    out = []
    for capacity in sorted(c for c in capacities if c >= length):
        room, at = capacity - length, bisect_left(lengths, length) + 1
        used = {length: 1}
        while room > 0 and at > 0:
            at = bisect_left(lengths, room + 1, 0, at)
            if not at:
                break
            at -= 1
            size = lengths[at]
            take = min(left[size] - used.get(size, 0), room // size)
            if take > 0:
                used[size] = used.get(size, 0) + take
                room -= take * size
        # The smallest permitted length that holds the filling is what the bin will cost.
        filled = capacity - room
        out.append((cost(min(c for c in capacities if c >= filled)) / filled, capacity, used))
    return out


def cheapest_capacity(length: int, left: dict[int, int], lengths: list[int], capacities: Sequence[int]) -> int:
    """The capacity of least cost per token if filled, largest first, with pieces still to place."""
    return min(fillings(length, left, lengths, capacities), key=lambda f: f[0])[1]


def cheapest_bins(length: int, spare: dict[int, int], lengths: list[int], capacities: Sequence[int]) -> tuple[int, int]:
    """The capacity of least cost per token, and for how many bins one after the other; takes their filling from ``spare``."""
    found = fillings(length, spare, lengths, capacities)
    _, capacity, used = min(found, key=lambda f: f[0])
    # Nothing changes for the next bin while every capacity can still be filled as now.
    count = min((spare[size] - n) // used[size] + 1 for _, _, filling in found for size, n in filling.items() if size in used)
    for size, n in used.items():
        spare[size] -= n * count
    return capacity, count


def plan_bins(histogram: dict[int, int], capacities: Sequence[int] = CAPACITIES, anew: bool = False) -> list[Bins]:
    """Places ``histogram`` (length: pieces), longest first; bins in the order they were opened.
    ``anew``: capacities are decided at every opened bin, not once per length."""
    left = {n: k for n, k in histogram.items() if k > 0 and n > 0}
    if left and max(left) > max(capacities):
        raise ValueError("a piece is longer than the largest capacity")
    lengths = sorted(left)
    spare = dict(left)  # pieces that no opened bin counts on
    opened: list[Bins] = []
    rooms: list[tuple[int, int, int]] = []  # (room, capacity, number of the entry), of entries with room
    for length in sorted(left, reverse=True):
        number, capacity = 0, None
        while left[length]:
            at = bisect_left(rooms, (length,))
            if at == len(rooms) and anew:
                # No open bin has room, so all that are left of this length are to place.
                spare[length] = left[length]
                size, count = cheapest_bins(length, spare, lengths, capacities)
                opened.append(Bins(size, size, count))
                insort(rooms, (size, size, len(opened) - 1))
                continue
            if at == len(rooms):
                capacity = capacity or cheapest_capacity(length, left, lengths, capacities)
                # As many bins of this kind as a run of equal pieces opens one after the other.
                per = capacity // length
                count = max(1, left[length] // per)
                opened.append(Bins(capacity, capacity, count))
                insort(rooms, (capacity, capacity, len(opened) - 1))
                continue
            room, _, i = rooms.pop(at)
            bins = opened[i]
            per, todo = room // length, left[length]
            full, part = divmod(todo, per)
            if full >= bins.count:
                bins.runs.append((length, per, number))
                number += per * bins.count
                left[length] -= per * bins.count
                bins.room -= per * length
                if bins.room:
                    insort(rooms, (bins.room, bins.capacity, i))
                continue
            # The run ends inside this entry: full bins, one that is begun, untouched ones.
            pieces = [(full, per), (1, part), (bins.count - full - 1, 0)]
            if not part:
                pieces = [(full, per), (bins.count - full, 0)]
            before = list(bins.runs)
            skipped = 0
            for j, (count, each) in enumerate((c, e) for c, e in pieces if c):
                # Pieces placed earlier are shared out among the parts of the entry.
                runs = [(n, e, first + skipped * e) for n, e, first in before]
                if each:
                    runs.append((length, each, number))
                    number += each * count
                    left[length] -= each * count
                entry = Bins(bins.capacity, room - each * length, count, runs)
                if j:
                    opened.append(entry)
                    k = len(opened) - 1
                else:
                    opened[i] = entry
                    k = i
                if entry.room:
                    insort(rooms, (entry.room, entry.capacity, k))
                skipped += count
    # Untouched bins of a run that another entry finished are not used.
    return [b for b in opened if b.runs]


def downsized(bins: Bins, capacities: Sequence[int]) -> int:
    used = bins.capacity - bins.room
    return min(c for c in capacities if c >= used)


def total_cost(plan: list[Bins], capacities: Sequence[int]) -> int:
    return sum(b.count * cost(downsized(b, capacities)) for b in plan)


def least_cost_plan(histogram: dict[int, int], capacities: Sequence[int] = CAPACITIES) -> list[Bins]:
    plans = [plan_bins(histogram, capacities, anew) for anew in (False, True)]
    return min(plans, key=lambda p: total_cost(p, capacities))


def pieces_of(docs: DataFrame, largest: int, key: str, text: str) -> DataFrame:
    """One row per piece: doc_id, piece, first_token, n_tokens; documents without tokens have one of 0."""
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("doc_id"), F.regexp_count(whole, F.lit(TOKEN)).cast("long").alias("_n"), F.xxhash64(whole).alias("_h"))
    rows = rows.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.floor((F.col("_n") - 1) / largest)))))
    return rows.select("doc_id", "piece", (F.col("piece") * largest).alias("first_token"),
                       F.least(F.lit(largest).cast("long"), F.col("_n") - F.col("piece") * largest).alias("n_tokens"), "_h")


def pack(docs: DataFrame, capacities: Sequence[int] = CAPACITIES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, piece, first_token, n_tokens, bin_id, bin_length (after
    cutting down), bin_offset (the piece's first token in the bin)."""
    spark = docs.sparkSession
    parts = salt_count(spark) * 4
    pieces = pieces_of(docs, max(capacities), key, text)
    pieces = written(pieces.withColumn("_part", F.pmod(F.xxhash64("doc_id", "_h", "piece"), F.lit(parts)).cast("int")), "pieces")
    packed = pieces.where("n_tokens > 0")
    counts = written(packed.groupBy("n_tokens", "_part").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["n_tokens"]: r["n"] for r in counts.groupBy("n_tokens").agg(F.sum("n").alias("n")).collect()}
    planned = least_cost_plan(histogram, capacities)

    # Runs of piece numbers per length: number -> bin and place in it by division.
    runs, bin_id = [], 0
    for bins in planned:
        offset, size = 0, downsized(bins, capacities)
        for length, per, first in bins.runs:
            runs.append((length, first, first + per * bins.count, per, bin_id, offset, size))
            offset += per * length
        bin_id += bins.count
    fields = ("n_tokens", "_first", "_end", "_per", "_bin", "_offset", "bin_length")
    table = spark.createDataFrame(runs, StructType([StructField(f, LongType()) for f in fields]))

    offsets = counts.select("n_tokens", "_part", F.expr(
        "coalesce(sum(n) over (partition by n_tokens order by _part rows between unbounded preceding and 1 preceding), 0)").alias("_before"))
    numbered = (packed.withColumn("_k", F.expr("row_number() over (partition by n_tokens, _part order by doc_id, _h, piece)"))
                .join(offsets, ["n_tokens", "_part"]).withColumn("_number", F.col("_before") + F.col("_k") - 1))
    # The plan is bounded by the capacities (see above), whatever the table's size.
    placed = numbered.join(F.broadcast(table), "n_tokens").where("_number >= _first and _number < _end")
    within = F.col("_number") - F.col("_first")
    columns = ("doc_id", "piece", "first_token", "n_tokens")
    placed = placed.select(*columns, (F.col("_bin") + F.floor(within / F.col("_per"))).alias("bin_id"), "bin_length",
                           (F.col("_offset") + F.pmod(within, F.col("_per")) * F.col("n_tokens")).alias("bin_offset"))
    none = F.lit(None).cast("long")
    nowhere = pieces.where("n_tokens = 0").select(*columns, none.alias("bin_id"), none.alias("bin_length"), none.alias("bin_offset"))
    return placed.unionByName(nowhere)
