"""Per-key ordering work that survives a key holding a large part of the rows.

A window over ``partitionBy(key)`` sends all rows of one key to one task.  Here a
key with more than ``hot_rows`` rows is cut by rank into consecutive *slices* of at
most as many rows, and windows are partitioned by ``(key, _slice)``.  What a row needs
from beyond its slice is one row per border, found with a partial aggregation and added
to the slice as a *border row* before the shuffle.  Keys that are not hot keep slice
0 and need no border rows.

Hot keys are found first, by a count over all rows that is summed map-side, and
kept as a small table: one row for each key above ``hot_rows``, so at most rows /
hot_rows.  Without any, the plan is the ordinary one.  The table is broadcast up to
BROADCAST_KEYS keys; beyond that the join is left to adaptive execution.

Slices come in two levels.  The rows of all hot keys are sorted into ranges of about
RANGE_SLICES slices in the whole order of the operator, sequence included, and a row's
slice is its place within its range divided by ``hot_rows``.  So rows of one instant, or
repeated rows, are cut like any others, and no slice is larger than ``hot_rows``, however
many rows a key has.  There are at most MAX_RANGES ranges (of the range borders the driver
holds a sample); a key beyond MAX_RANGES * RANGE_SLICES slices has more slices in a range,
whose sort spills.  Sliced rows are written once, so that all readers see the same slices.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.workspace import new_dir

HOT_ROWS = 1_000_000
BROADCAST_KEYS = 10_000
RANGE_SLICES, MAX_RANGES = 8, 4_096
#: ``monotonically_increasing_id`` holds the place within a partition in so many bits (fixed value).
_PLACE_BITS = 33


@dataclass(frozen=True)
class HotKeys:
    """The keys above a threshold (``_hot_key``, ``_hot_n``), stored, their number and that of their rows."""

    frame: DataFrame
    n: int
    rows: int

    def hinted(self, frame: DataFrame) -> DataFrame:
        """A frame of one row for each hot key, broadcast if there are few."""
        return F.broadcast(frame) if self.n <= BROADCAST_KEYS else frame


def kept(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written below the shared folder and read back."""
    path = new_dir(rows.sparkSession, purpose)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def hot_keys(rows: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> HotKeys:
    """All keys with more than ``hot_rows`` rows, NULL included."""
    counts = rows.groupBy(F.col(key).alias("_hot_key")).agg(F.count(F.lit(1)).alias("_hot_n")).filter(f"_hot_n > {hot_rows}")
    found = kept(counts, "hot-keys")
    size = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_hot_n"), F.lit(0)).alias("rows")).first()
    return HotKeys(found, size["n"], size["rows"])


def mark_slices(
    rows: DataFrame,
    key: str,
    order: list[str] | str,
    hot_rows: int = HOT_ROWS,
    counted: DataFrame | None = None,
    hot: HotKeys | None = None,
) -> DataFrame:
    """Add ``_slice`` (0 unless the key is hot) and ``_hot_n`` (NULL unless hot).

    Slices of a hot key never decrease in the ``order`` of its rows.  ``counted``
    restricts which rows decide what is hot.
    """
    counted, order = rows if counted is None else counted, [order] if isinstance(order, str) else order
    hot = hot_keys(counted, key, hot_rows) if hot is None else hot
    if hot.n == 0:
        return rows.selectExpr("*", "cast(null as bigint) as _hot_n", "0L as _slice")
    told = rows.join(hot.hinted(hot.frame), F.expr(f"{key} <=> _hot_key"), "left").select(*rows.columns, "_hot_n")
    ranges = max(1, min(MAX_RANGES, -(-hot.rows // (hot_rows * RANGE_SLICES))))
    in_order = (
        told.filter("_hot_n is not null").repartitionByRange(ranges, key, *order).sortWithinPartitions(key, *order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    place = f"(_row & {(1 << _PLACE_BITS) - 1}L)"
    sliced = kept(in_order.selectExpr(*rows.columns, "_hot_n", f"_row - {place} % {hot_rows} + 1 as _slice"), "hot-slices")
    return told.filter("_hot_n is null").withColumn("_slice", F.lit(0).cast("bigint")).unionByName(sliced)


def border_rows(marked: DataFrame, key: str, order: list[str], carry: list[str], step: str) -> DataFrame:
    """For each slice of a hot key, the nearest row beyond its border.

    ``step='next'`` gives the first row of the following slice, ``'previous'`` the
    last row of the preceding one.  One row per slice, built map-side first.
    """
    edge_of, shift = ("min", "lead") if step == "next" else ("max", "lag")
    fields = [f for f in dict.fromkeys(order + carry) if f != key]
    edges = marked.filter("_hot_n is not null").groupBy(key, "_slice").agg(
        F.expr(f"{edge_of}(struct({', '.join(fields)})) as _edge")
    )
    shifted = edges.selectExpr(key, "_slice", f"{shift}(_edge) over (partition by {key} order by _slice) as _edge")
    return shifted.filter("_edge is not null").select(key, "_slice", "_edge.*")


def with_neighbour(
    rows: DataFrame,
    key: str,
    order: list[str],
    carry: list[str],
    step: str = "next",
    prefix: str = "next_",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add, under ``prefix``, the ``carry`` columns of the next or previous row of the key."""
    marked = mark_slices(rows, key, order, hot_rows)
    borders = border_rows(marked, key, order, carry, step).selectExpr("*", "true as _border")
    both = marked.drop("_hot_n").selectExpr("*", "false as _border").unionByName(borders, allowMissingColumns=True)
    in_order = f"over (partition by {key}, _slice order by {', '.join(order)})"
    shift = "lead" if step == "next" else "lag"
    shifted = both.selectExpr(*rows.columns, "_border", *[f"{shift}({c}) {in_order} as {prefix}{c}" for c in carry])
    return shifted.filter("not _border").drop("_border")


def spread_lookup(
    left: DataFrame, right: DataFrame, key: str, how: str, spread_by: str, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Equi-join to a side that is unique on ``key``, with hot left keys salted.

    Hot keys are spread over ``rows / hot_rows`` buckets by a hash of
    ``spread_by``; only their right rows are repeated, once per bucket.  NULL keys
    are spread as well; they match nothing.
    """
    found = hot_keys(left, key, hot_rows)
    if found.n == 0:
        return left.join(right, key, how)
    hot = found.hinted(found.frame.selectExpr("_hot_key", f"cast(ceil(_hot_n / {hot_rows}) as int) as _buckets"))
    salted = left.join(hot, F.expr(f"{key} <=> _hot_key"), "left").selectExpr(
        *left.columns, f"if(_buckets is null, 0, cast(pmod(xxhash64({spread_by}), _buckets) as int)) as _salt"
    )
    repeated = right.join(hot, F.expr(f"{key} = _hot_key"), "left").selectExpr(
        *right.columns, "explode(sequence(0, coalesce(_buckets, 1) - 1)) as _salt"
    )
    return salted.join(repeated, [key, "_salt"], how).drop("_salt")
