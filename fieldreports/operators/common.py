"""Generic building blocks used by several operators.

* :func:`first_per_group` - "first row per group"; Spark keeps one candidate per
  group and map task before the shuffle, so a hot group never reaches one task
  whole.
* :func:`rank_in_slices` - exact 1-based row numbers per group, counted slice by
  slice, so that a group that holds a large share of the rows is spread out.
* :func:`nearest_day` - for every (key, day) the row with the nearest day.
* :func:`assert_unique` - key check that raises instead of fanning rows out.
* :func:`possible_members` - rows whose key may be among other keys, found without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTER_BITS = 24


def _cols(names: Sequence[str | Column]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def first_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    drop_null_keys: bool = False,
    replace: Mapping[str, Column] | None = None,
) -> DataFrame:
    """One row per ``keys``: the row that sorts first by ``order`` (a total order).

    Planned as ``row_number() = 1``, for which Spark limits every group to one
    row per map task before the shuffle (WindowGroupLimit) and still prunes
    columns nobody reads. ``replace`` maps a column to an aggregate over the
    whole group that takes the first row's place; the group is then reduced by
    one aggregation with a single ordering per row.
    """
    keys = list(keys)
    if drop_null_keys:
        df = df.where(_all_not_null(keys))
    values = [c for c in df.columns if c not in keys]
    if not replace:
        w = Window.partitionBy(*keys).orderBy(*_cols(order))
        return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(*keys, *values)
    kept = [c for c in values if c not in replace]
    first = F.min_by(F.struct(*kept), F.struct(*_cols(order))).alias("_first")
    grouped = df.groupBy(*keys).agg(first, *[agg.alias(c) for c, agg in replace.items()])
    return grouped.select(*keys, *[F.col(c) if c in replace else F.col(f"_first.{c}").alias(c) for c in values])


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def rank_in_slices(
    df: DataFrame,
    keys: Sequence[str],
    slices: Mapping[str, Column],
    order: Sequence[str | Column],
    totals: Mapping[str, Column],
    rank_col: str = "_rank",
) -> DataFrame:
    """Add ``rank_col`` = 1-based position of each row inside its ``keys`` group, and ``totals``.

    ``slices`` names expressions that do not decrease along ``order`` (a day of
    the time, the leading digits of a hash): rows are numbered inside (keys,
    slices) and shifted by the row count of the group's earlier slices. Those
    counts are one partially aggregated row per slice, so no task holds a whole
    group, and the method is the same at every size. ``totals`` maps a name to a
    column to sum over the group. NULL keys form one group; NULLs of a slice
    sort first. ``order`` must be a total order for a deterministic numbering.
    """
    keys, parts = list(keys), list(slices)
    sliced = df.withColumns(dict(slices))
    per_slice = sliced.groupBy(*keys, *parts).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(c).alias(f"_sum_{n}") for n, c in totals.items()])
    group = Window.partitionBy(*keys)
    earlier = group.orderBy(*parts).rowsBetween(Window.unboundedPreceding, -1)
    shift = per_slice.select(
        *[F.col(c).alias(f"_of_{c}") for c in keys + parts],
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"),
        *[F.sum(f"_sum_{n}").over(group).alias(n) for n in totals],
    )
    local = F.row_number().over(Window.partitionBy(*keys, *parts).orderBy(*_cols(order)))
    same = F.lit(True)
    for c in keys + parts:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    ranked = sliced.withColumn("_local", local).join(shift, same, "inner")
    return ranked.select(*df.columns, (F.col("_local") + F.col("_offset")).cast("bigint").alias(rank_col), *totals)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "table") -> None:
    """Raise ``ValueError`` when a key value occurs more than once."""
    dup = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .limit(1)
        .collect()
    )
    if dup:
        raise ValueError(f"{what}: duplicate key {dict((k, dup[0][k]) for k in keys)}")


def nearest_day(left: DataFrame, wanted: DataFrame, key: str, day: str, match_col: str = "_match") -> DataFrame:
    """For each (key, day) of ``wanted`` the row of ``left`` with the same key and the
    nearest day; equal distance prefers the earlier day. NULL when there is none.

    Both sides hold at most one row per (key, day), so a group is bounded by the
    number of days. Each side of a day is one running ``last`` (the later one
    over the reversed order), so the work is linear.
    """
    row = F.struct(*left.columns)
    kind = left.select(row).schema[0].dataType
    both = left.select(F.col(key).alias("_key"), F.col(day).alias("_day"), row.alias("_l"), F.lit(0).alias("_side")).unionByName(
        wanted.select(F.col(key).alias("_key"), F.col(day).alias("_day"), F.lit(None).cast(kind).alias("_l"), F.lit(1).alias("_side")))
    past = Window.partitionBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = both.select(
        "_key", "_day", "_side",
        F.last("_l", ignorenulls=True).over(past.orderBy("_day", "_side")).alias("_before"),
        F.last("_l", ignorenulls=True).over(past.orderBy(F.col("_day").desc(), "_side")).alias("_after"),
    ).where(F.col("_side") == 1)
    back = F.datediff("_day", F.col(f"_before.{day}"))
    ahead = F.datediff(F.col(f"_after.{day}"), F.col("_day"))
    chosen = F.when(F.col("_after").isNull() | (back <= ahead), F.col("_before")).otherwise(F.col("_after"))
    return seen.select(F.col("_key").alias(key), F.col("_day").alias(day), chosen.alias(match_col))


def possible_members(rows: DataFrame, rows_key: Sequence[str], members: DataFrame, members_key: Sequence[str],
                     bits: int | None = None) -> DataFrame:
    """The ``rows`` whose key may be one of the keys of ``members``: all that are, and few that are not.

    The keys of ``members`` are hashed into a table of 2 ** ``bits`` bits (``FILTER_BITS`` where
    none is given), kept as words of 64 bits. At most 2 ** (``bits`` - 6) words (16 bytes each,
    4 MB in all with 24 bits) can be set, however many members there are, so the table is broadcast and ``rows`` are not
    shuffled. With many more members than bits it lets more rows through, never fewer than
    it must. Equal keys need equal types on both sides; NULLs match NULLs.
    """
    bits = FILTER_BITS if bits is None else bits
    wanted = [members.select(F.col(k).alias("k")).schema["k"].dataType.simpleString() for k in members_key]
    given = [rows.select(F.col(k).alias("k")).schema["k"].dataType.simpleString() for k in rows_key]
    if wanted != given:
        raise ValueError(f"key types differ: {given} and {wanted}")

    def place(keys: Sequence[str]) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(1 << bits))

    table = members.select(place(members_key).alias("_bit")).groupBy(F.shiftright("_bit", 6).alias("_word")).agg(
        F.bit_or(F.expr("shiftleft(1L, CAST(_bit & 63 AS INT))")).alias("_set"))
    return rows.withColumn("_bit", place(rows_key)).join(
        F.broadcast(table), F.shiftright("_bit", 6) == F.col("_word")
    ).where("shiftrightunsigned(_set, CAST(_bit & 63 AS INT)) & 1 = 1").select(*rows.columns)
