"""Order-dependent work on tables too long for one task.

A window without a partition key runs in a single task. The operators here cut
the order into buckets of bounded length, work inside the buckets in parallel,
and carry what crosses a border: neighbouring rows are copied over it (halo), or
one summary row per bucket is scanned and joined back (carry).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from linewatch.config import DEFAULTS
from linewatch.schema import ROW_ID, quoted
from linewatch.session import materialise

BUCKET = "_bucket"
POSITION = "_pos"
# Buckets summarised together at the second level of a carry, so that the top
# level sees one row per BUCKETS_PER_GROUP * bucket_rows input rows.
BUCKETS_PER_GROUP = 10_000


def bucket_of(order: Column, bucket_rows: int) -> Column:
    """Number of the bucket a position falls in. It is never null, so that joins
    on it add no null filter and the summaries on both sides stay one exchange."""
    return F.coalesce(F.call_function("div", order, F.lit(bucket_rows)), F.lit(-1))


def _keyed(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``by`` packed into one struct column. Structs with equal null fields are
    equal, so rows with a null key meet in a plain equi-join, which can then use
    the partitioning the window before it has made."""
    if not by:
        return df, []
    return df.withColumn("_by", F.struct(*[F.col(quoted(c)) for c in by])), ["_by"]


def _offsets(counts: DataFrame, key: Sequence[str]) -> DataFrame:
    """Exclusive running sum of ``_n`` over the buckets, in two levels."""
    grouped = counts.withColumn("_group", bucket_of(F.col(BUCKET), BUCKETS_PER_GROUP))
    before = (
        Window.partitionBy(*key).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    )
    tops = (
        grouped.groupBy(*key, "_group")
        .agg(F.sum("_n").alias("_n"))
        .select(*key, "_group", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    inside = (
        Window.partitionBy(*key, "_group").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = grouped.withColumn("_local", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    return local.join(tops, [*key, "_group"]).select(
        *key, BUCKET, (F.col("_base") + F.col("_local")).alias("_offset")
    )


def dense_index(
    df: DataFrame,
    order: str = ROW_ID,
    by: Sequence[str] = (),
    out: str = "dense_id",
    bucket_rows: int = DEFAULTS.bucket_rows,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Gap-free position 0, 1, ... in ``order``, optionally per ``by``.

    ``order`` is a whole number that is unique, or spread evenly with ``ties``
    to settle the rest; a bucket is ``bucket_rows`` of its values.
    """
    columns = [F.col(quoted(c)) for c in df.columns]
    keyed, key = _keyed(df, by)
    bucketed = keyed.withColumn(BUCKET, bucket_of(F.col(quoted(order)), bucket_rows))
    counts = bucketed.groupBy(*key, BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    inside = Window.partitionBy(*key, BUCKET).orderBy(quoted(order), *ties)
    ranked = bucketed.withColumn("_rank", F.row_number().over(inside))
    index = (F.col("_offset") + F.col("_rank") - 1).cast("bigint")
    joined = ranked.join(_offsets(counts, key), [*key, BUCKET])
    return joined.select(*columns, index.alias(out))


def ordered_index(df: DataFrame, columns: Sequence[str], out: str, rows_per_part: int = 1_000_000, rows: int | None = None) -> DataFrame:
    """Gap-free position by several columns of any type, over a stored table: parts of the sorted rows are numbered each,
    and what comes before a part is summed over one row per part. Equal rows go in any order. Where the caller knows the number of ``rows`` and they are one part, a window
    numbers them, and nothing is stored."""
    spark = df.sparkSession
    if rows is not None and rows < rows_per_part:
        whole = Window.orderBy(*[F.col(quoted(c)) for c in columns])
        return df.select(*[F.col(quoted(c)) for c in df.columns], (F.row_number().over(whole) - 1).cast("bigint").alias(out))
    parts = (df.count() if rows is None else rows) // rows_per_part + 1
    cut = df.repartitionByRange(parts, *[F.col(quoted(c)) for c in columns])
    cut = cut.sortWithinPartitions(*[F.col(quoted(c)) for c in columns])
    # The number of a row holds its partition in the upper bits and its place in the lower 33.
    stored = materialise(spark, cut.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    place, part = F.col("_at").bitwiseAND((1 << 33) - 1), F.shiftright("_at", 33)
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    joined = stored.withColumn("_part", part).join(sizes, "_part")
    return joined.select(*[F.col(quoted(c)) for c in df.columns], (F.col("_before") + place).cast("bigint").alias(out))


def dense_from(df: DataFrame, order: str = ROW_ID) -> int | None:
    """The first value of ``order`` if its values are whole numbers without gap, repeat or null, else None.

    As many values as their range is long, and the same combined hash as the range."""
    value = F.col(quoted(order)).cast("bigint")
    n, low, high, seen = df.agg(
        F.count(F.lit(1)), F.min(value), F.max(value), F.bit_xor(F.xxhash64(value))
    ).first()
    if not n or low is None or high - low + 1 != n:
        return None
    want = df.sparkSession.range(low, high + 1).agg(F.bit_xor(F.xxhash64("id"))).first()[0]
    return low if want == seen else None


def _claimed(df: DataFrame, order: str, by: Sequence[str]) -> Column:
    """Positions of an order said to be dense, in each group, after a look at the claim."""
    position = F.col(quoted(order))
    if not by:
        low = dense_from(df, order)
        if low is None and not df.isEmpty():
            raise ValueError(f"{order} is said to be dense and is not")
        return position - F.lit(low or 0)
    ends = [F.count(F.lit(1)).alias("n"), F.min(position).alias("low"), F.max(position).alias("high")]
    groups = df.groupBy(*[F.col(quoted(c)) for c in by]).agg(*ends)
    if not groups.where("low is null or low <> 0 or high - low + 1 <> n").isEmpty():
        raise ValueError(f"{order} is said to be dense in {list(by)}, from 0 on, and is not")
    return position


def with_position(
    df: DataFrame,
    order: str = ROW_ID,
    by: Sequence[str] = (),
    dense: bool | None = None,
    bucket_rows: int = DEFAULTS.bucket_rows,
) -> DataFrame:
    """``df`` with ``_pos``: 0, 1, ... in ``order``, per ``by``.

    ``dense`` says that ``order`` is such a position already, which is checked; by default a look decides
    (without ``by``), and the order is ranked where it has gaps."""
    if POSITION in df.columns:
        df = df.drop(POSITION)
    if dense:
        return df.withColumn(POSITION, _claimed(df, order, by).cast("bigint"))
    if dense is None and not by:
        low = dense_from(df, order)
        if low is not None:
            return df.withColumn(POSITION, (F.col(quoted(order)) - F.lit(low)).cast("bigint"))
    return dense_index(df, order, by, POSITION, bucket_rows)


def halo_at(
    df: DataFrame,
    columns: Callable[[WindowSpec], list[Column]],
    before: int = 0,
    after: int = 0,
    by: Sequence[str] = (),
    bucket_rows: int = DEFAULTS.bucket_rows,
    keep: bool = False,
) -> DataFrame:
    """:func:`halo_select` over a frame that has ``_pos``; ``keep`` leaves it and the bucket in."""
    if bucket_rows < max(before, after, 1):
        raise ValueError(f"bucket_rows={bucket_rows} is shorter than the frame ({before}, {after})")
    position = F.col(POSITION)
    own = bucket_of(position, bucket_rows)
    offset = position - own * bucket_rows
    targets = [own]
    if before:
        targets.append(F.when(offset >= bucket_rows - before, own + 1))
    if after:
        targets.append(F.when(offset < after, own - 1))
    if len(targets) == 1:
        spread = df.withColumn(BUCKET, own)
    else:
        spread = df.withColumn(BUCKET, F.explode(F.array_compact(F.array(*targets))))
    window = Window.partitionBy(*[quoted(c) for c in by], BUCKET).orderBy(POSITION)
    inner = [F.col(BUCKET), position] if keep else []
    result = spread.select(*columns(window), (F.col(BUCKET) == own).alias("_own"), *inner)
    return result.where("_own").drop("_own")


def halo_select(
    df: DataFrame,
    columns: Callable[[WindowSpec], list[Column]],
    before: int = 0,
    after: int = 0,
    order: str = ROW_ID,
    by: Sequence[str] = (),
    bucket_rows: int = DEFAULTS.bucket_rows,
    dense: bool | None = None,
) -> DataFrame:
    """Row-frame expressions over the whole order, bucket by bucket.

    ``columns`` gets the window and returns what to select; frames may reach ``before`` rows back and
    ``after`` rows ahead. Each bucket also receives that many rows of its
    neighbours, which are dropped again afterwards. ``order`` may have gaps; see :func:`with_position` for ``dense``.
    """
    if bucket_rows < max(before, after, 1):
        raise ValueError(f"bucket_rows={bucket_rows} is shorter than the frame ({before}, {after})")
    placed = with_position(df, order, by, dense, bucket_rows)
    # A star in ``columns`` takes the working columns too.
    return halo_at(placed, columns, before, after, by, bucket_rows).drop(POSITION, BUCKET)


def _carried(summaries: DataFrame, columns: Sequence[str], key: Sequence[str]) -> DataFrame:
    """What each bucket takes from outside: the last value of the buckets before
    it, else the first value of all. Two levels like :func:`_offsets`."""
    grouped = summaries.withColumn("_group", bucket_of(F.col(BUCKET), BUCKETS_PER_GROUP))
    order = Window.partitionBy(*key).orderBy("_group")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def where_set(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), F.col(BUCKET))

    tops = (
        grouped.groupBy(*key, "_group")
        .agg(
            *[F.max_by(f"{c}_last", where_set(f"{c}_last")).alias(f"{c}_last") for c in columns],
            *[F.min_by(f"{c}_first", where_set(f"{c}_first")).alias(f"{c}_first") for c in columns],
        )
        .select(
            *key,
            "_group",
            *[F.last(f"{c}_last", ignorenulls=True).over(before).alias(f"{c}_top") for c in columns],
            *[F.first(f"{c}_first", ignorenulls=True).over(whole).alias(f"{c}_all") for c in columns],
        )
    )
    inside = (
        Window.partitionBy(*key, "_group").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    )
    local = grouped.select(
        *key,
        "_group",
        BUCKET,
        *[F.last(f"{c}_last", ignorenulls=True).over(inside).alias(f"{c}_in") for c in columns],
    )
    return local.join(tops, [*key, "_group"]).select(
        *key, BUCKET, *[F.coalesce(f"{c}_in", f"{c}_top", f"{c}_all").alias(c) for c in columns]
    )


def carry_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    order: str = ROW_ID,
    bucket_rows: int = DEFAULTS.bucket_rows,
    source: DataFrame | None = None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Forward fill, then backward fill, then 0, over the whole order, or within each group of ``by``.

    What a forward fill leaves open is the stretch before a column's first value,
    so the backward fill is that one value. Text columns end in ``'0'``. ``order`` may have gaps. A frame
    already bucketed by :func:`halo_at` keeps its partitioning; ``source``
    is then a stored frame with the same values to take the summaries from.
    """
    hidden = (BUCKET, POSITION)
    kept = [c for c in df.columns if c not in hidden]
    columns = [c for c in kept if c != order and c not in by] if columns is None else list(columns)
    if not columns:
        return df.select(*[F.col(quoted(c)) for c in kept])
    source = df if source is None else source
    position = F.col(quoted(order))
    own = bucket_of(position, bucket_rows)
    bucketed, key = _keyed(df if BUCKET in df.columns else df.withColumn(BUCKET, own), by)
    short = {c: f"_c{i}" for i, c in enumerate(columns)}

    def at(c: str) -> Column:
        return F.when(F.col(quoted(c)).isNotNull(), position)

    per_bucket = _keyed(source, by)[0].groupBy(*key, own.alias(BUCKET)).agg(
        *[F.max_by(F.col(quoted(c)), at(c)).alias(f"{s}_last") for c, s in short.items()],
        *[F.min_by(F.col(quoted(c)), at(c)).alias(f"{s}_first") for c, s in short.items()],
    )
    inside = (
        Window.partitionBy(*key, BUCKET).orderBy(quoted(order)).rowsBetween(Window.unboundedPreceding, 0)
    )
    filled = bucketed.select(
        *[F.col(quoted(c)) for c in kept if c not in short],
        *[F.last(F.col(quoted(c)), ignorenulls=True).over(inside).alias(c) for c in columns],
        *key,
        BUCKET,
    )
    joined = filled.join(_carried(per_bucket, list(short.values()), key), [*key, BUCKET])
    types = {f.name: f.dataType for f in df.schema.fields}

    def final(c: str) -> Column:
        if c not in short:
            return F.col(quoted(c))
        return F.coalesce(
            F.col(quoted(c)),
            F.col(short[c]),
            F.lit(0).cast(types[c]),
        ).alias(c)

    return joined.select(*[final(c) for c in kept])


def rising_edge(
    df: DataFrame,
    flag: str,
    out: str,
    order: str = ROW_ID,
    by: Sequence[str] = (),
    bucket_rows: int = DEFAULTS.bucket_rows,
    dense: bool | None = None,
) -> DataFrame:
    """True where ``flag`` is set and was not set one row before."""

    def columns(w: WindowSpec) -> list[Column]:
        held = F.coalesce(F.col(quoted(flag)), F.lit(False))
        earlier = F.coalesce(F.lag(F.col(quoted(flag))).over(w), F.lit(False))
        return [*[F.col(quoted(c)) for c in df.columns], (held & ~earlier).alias(out)]

    return halo_select(df, columns, 1, 0, order, by, bucket_rows, dense)


def every_nth(df: DataFrame, n: int = DEFAULTS.ewma_every, order: str = ROW_ID) -> DataFrame:
    """Rows n, 2n, 3n, ... of a dense order, counted from one."""
    return df.where(F.col(order) % n == n - 1)


def drop_repeats(
    df: DataFrame,
    value: str,
    order: str = ROW_ID,
    bucket_rows: int = DEFAULTS.bucket_rows,
    dense: bool | None = None,
) -> DataFrame:
    """Rows whose ``value`` differs from the row before."""

    def columns(w: WindowSpec) -> list[Column]:
        first = F.col(POSITION) == 0
        changed = ~F.col(quoted(value)).eqNullSafe(F.lag(F.col(quoted(value))).over(w))
        return [*[F.col(quoted(c)) for c in df.columns], (first | changed).alias("_new")]

    return halo_select(df, columns, 1, 0, order, (), bucket_rows, dense).where("_new").drop("_new")
