"""Prefix computations over ordered logs that stay parallel on one long log.

A window partitioned by the log alone puts a whole log into one task. Here the order column is cut
into buckets of ``width`` positions. Windows run inside a bucket, one summary row per bucket is
carried forward, and the carry is joined back. A task then sorts at most ``width`` distinct positions
of one log, however large the share of that log is.

``tiers`` is the number of bucket levels. With one level the carry is a window over the summary rows
of a log: at the default width that is 131,072 rows for a log of 17 billion positions. A second level
treats the summary rows the same way and covers every 63-bit position.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from blocklog.session import Staging

DEFAULT_WIDTH = 131_072

# Only frames that grow from the start of the window: a frame that shrinks towards its end is
# evaluated anew for every row, which is quadratic. Looking ahead uses the reversed order instead.
_BEFORE = (Window.unboundedPreceding, -1)
_UP_TO = (Window.unboundedPreceding, 0)


@dataclass(frozen=True)
class _Spec:
    """One output column: its value inside a bucket, a bucket's summary, and how both combine."""

    value: Column
    out: str

    reverse = False

    def local(self, w: WindowSpec) -> Column:
        raise NotImplementedError

    def summary(self, position: Column) -> Column:
        raise NotImplementedError

    def carry(self, value: Column, out: str) -> "_Spec":
        """The spec that turns summary rows into the carry of the buckets before (or after)."""
        raise NotImplementedError

    def merge(self, local: Column, carry: Column) -> Column:
        return F.coalesce(local, carry)

    def finish(self, merged: Column) -> Column:
        return merged


@dataclass(frozen=True)
class Lag(_Spec):
    """Value of the previous row, null on the first."""

    def local(self, w):
        return F.lag(F.struct(self.value.alias("v"))).over(w)

    def summary(self, position):
        return F.max_by(self.value, position)

    def carry(self, value, out):
        return Lag(value, out)

    def merge(self, local, carry):
        return F.coalesce(local["v"], F.when(local.isNull(), carry))


@dataclass(frozen=True)
class Lead(_Spec):
    """Value of the next row, null on the last."""

    def local(self, w):
        return F.lead(F.struct(self.value.alias("v"))).over(w)

    def summary(self, position):
        return F.min_by(self.value, position)

    def carry(self, value, out):
        return Lead(value, out)

    def merge(self, local, carry):
        return F.coalesce(local["v"], F.when(local.isNull(), carry))


@dataclass(frozen=True)
class RunMax(_Spec):
    """Largest value so far; without ``inclusive`` the current row is left out."""

    inclusive: bool = False

    def local(self, w):
        return F.max(self.value).over(w.rowsBetween(*(_UP_TO if self.inclusive else _BEFORE)))

    def summary(self, position):
        return F.max(self.value)

    def carry(self, value, out):
        return RunMax(value, out)

    def merge(self, local, carry):
        return F.greatest(local, carry)


@dataclass(frozen=True)
class RunSum(_Spec):
    """Sum so far, 0 before any value. Counts and row numbers are sums of ones."""

    inclusive: bool = True

    def local(self, w):
        return F.sum(self.value).over(w.rowsBetween(*(_UP_TO if self.inclusive else _BEFORE)))

    def summary(self, position):
        return F.sum(self.value)

    def carry(self, value, out):
        return RunSum(value, out, inclusive=False)

    def merge(self, local, carry):
        return F.coalesce(local, F.lit(0)) + F.coalesce(carry, F.lit(0))

    def finish(self, merged):
        return F.coalesce(merged, F.lit(0))


@dataclass(frozen=True)
class LastValid(_Spec):
    """Last non-null value so far."""

    inclusive: bool = True

    def local(self, w):
        return F.last(self.value, ignorenulls=True).over(
            w.rowsBetween(*(_UP_TO if self.inclusive else _BEFORE))
        )

    def summary(self, position):
        return F.max_by(self.value, F.when(self.value.isNotNull(), position))

    def carry(self, value, out):
        return LastValid(value, out, inclusive=False)


@dataclass(frozen=True)
class NextValid(_Spec):
    """Next non-null value from here on."""

    inclusive: bool = False

    reverse = True

    def local(self, w):
        return F.last(self.value, ignorenulls=True).over(
            w.rowsBetween(*(_UP_TO if self.inclusive else _BEFORE))
        )

    def summary(self, position):
        return F.min_by(self.value, F.when(self.value.isNotNull(), position))

    def carry(self, value, out):
        return NextValid(value, out, inclusive=False)


def bucket_name(tiers: int = 1) -> str:
    return f"__bucket{tiers}"


def bucket_of(order: str, width: int) -> Column:
    return F.expr(f"`{order}` div {int(width)}")


def with_prefix(
    df: DataFrame,
    specs: Sequence[_Spec],
    *,
    keys: Sequence[str],
    order: str,
    tie: Sequence[str] = (),
    width: int | None = DEFAULT_WIDTH,
    tiers: int = 1,
    spread: bool = True,
    keep_bucket: bool = False,
) -> DataFrame:
    """Add one column per spec, computed within ``keys`` in the order of ``order`` and ``tie``.

    ``width=None`` uses one window per key, for logs known to be short. ``spread=False`` leaves the
    distribution of the rows to the planner, for input that already comes out of a prefix pass with
    the same keys, order and width. If such input still has the column :func:`bucket_name`, which then goes, it is
    not dealt out again; ``keep_bucket`` leaves it there for the next pass.
    """
    keys = list(keys)
    bucket = bucket_name(tiers)
    dealt = not spread and bucket in df.columns
    columns = [F.col(f"`{c}`") for c in df.columns if not (dealt and c == bucket)]
    forward = [F.asc(c) for c in (order, *tie)]
    backward = [F.desc(c) for c in (order, *tie)]

    def local_value(spec: _Spec, group: list[str]) -> Column:
        return spec.local(
            Window.partitionBy(*group).orderBy(*(backward if spec.reverse else forward))
        )

    if width is None or tiers < 1:
        local = df.select(
            *columns, *[local_value(s, keys).alias(f"__local{i}") for i, s in enumerate(specs)]
        )
        return local.select(
            *columns,
            *[
                s.finish(s.merge(F.col(f"__local{i}"), F.lit(None))).alias(s.out)
                for i, s in enumerate(specs)
            ],
        )

    rows = df if dealt else df.withColumn(bucket, bucket_of(order, width))
    group = [*keys, bucket]
    summary_rows = rows
    if spread:
        rows = rows.repartition(*group)
    local = rows.select(
        *columns, bucket, *[local_value(s, group).alias(f"__local{i}") for i, s in enumerate(specs)]
    )

    position = F.struct(order, *tie) if tie else F.col(order)
    summary = summary_rows.groupBy(*group).agg(
        *[s.summary(position).alias(f"__sum{i}") for i, s in enumerate(specs)]
    )
    carried = with_prefix(
        summary,
        [s.carry(F.col(f"__sum{i}"), f"__carry{i}") for i, s in enumerate(specs)],
        keys=keys,
        order=bucket,
        width=width,
        tiers=tiers - 1,
    ).select(*group, *[f"__carry{i}" for i in range(len(specs))])

    return local.join(carried, group, "left").select(
        *columns,
        *([bucket] if keep_bucket else []),
        *[
            s.finish(s.merge(F.col(f"__local{i}"), F.col(f"__carry{i}"))).alias(s.out)
            for i, s in enumerate(specs)
        ],
    )


def with_prefix_in_groups(
    df: DataFrame,
    specs: Sequence[_Spec],
    *,
    keys: Sequence[str],
    order: str,
    staging: Staging,
    tie: Sequence[str] = (),
    width: int = DEFAULT_WIDTH,
) -> DataFrame:
    """The same for keys that are mostly rare: one window per key, buckets only for keys of more than
    ``width`` rows. ``df`` is read several times, so it should be a stored table."""
    options = {"keys": keys, "order": order, "tie": tie}
    # A share of all keys holds no fewer rows than any key in it, so few counts tell that no key is frequent.
    shares = 64 + 16 * df.count() // width
    share = F.pmod(F.xxhash64(*keys), F.lit(shares))
    if (df.groupBy(share.alias("share")).count().agg(F.max("count")).first()[0] or 0) <= width:
        return with_prefix(df, specs, width=None, **options)
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= width:
        return with_prefix(df, specs, width=None, **options)
    hot = staging.table(sizes.where(F.col("n") > width).select(*keys), "hot")
    rare = df.join(hot, list(keys), "left_anti").select(*df.columns)
    frequent = df.join(hot, list(keys), "left_semi").select(*df.columns)
    return with_prefix(rare, specs, width=None, **options).unionByName(
        with_prefix(frequent, specs, width=width, **options)
    )
