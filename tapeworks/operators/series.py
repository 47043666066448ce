"""Time-series operators over keyed series (one series per value of ``keys``).

* ``trailing_mean``  W1: mean over a trailing time range, current row included.
* ``last_known``     J2, W2, W3: backward, inclusive as-of lookup of the last
  non-NULL value from an event table, for every probe row.
* ``period_close``   A3, W4, W5: value of the last event of each period.
* ``prior_period``   W6: the value of the previous period present in the data.

Every function takes and returns a DataFrame, with column names as arguments.

Scale notes. A window partitioned by the series key alone puts a whole series
in one task; a hot symbol can hold a third of the rows. ``trailing_mean`` and
``last_known`` therefore take ``bucket=``: the series is cut into fixed time
buckets that are windowed in parallel, and what crosses a bucket edge travels
explicitly (copied *ghost* rows for the trailing mean, one carried row per bucket
for the as-of, from a parallel prefix scan over buckets). Results are identical to the unbucketed form.

NULL keys: a NULL is a key value like any other, in every form. Series are
compared as one struct of the key columns, whose equality takes NULLs as equal;
plain equality of the columns would lose them in joins, and null-safe equality
of each would lose the partitioning.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, GroupedData, Window, functions as F
from pyspark.sql import types as T

from ..functions.time import epoch_micros, interval_micros, time_bucket

_T = "__t_us"      # epoch micros of the order column
_B = "__bucket"    # bucket start (epoch micros)
_SIDE = "__side"   # 0 = event row, 1 = probe row
_K = "__series"    # struct of the key columns


def _mean_type(dtype: T.DataType) -> tuple[T.DataType, T.DataType] | None:
    """(sum type, avg type) Spark uses for ``avg`` of a decimal column."""
    if not isinstance(dtype, T.DecimalType):
        return None
    p, s = dtype.precision, dtype.scale
    return (T.DecimalType(min(38, p + 10), s), T.DecimalType(min(38, p + 4), min(38, s + 4)))


def _range_mean(df: DataFrame, value: str, part: list[str], width: int, out: str,
                method: str) -> Column:
    """Mean of ``value`` over ``[t - width, t]`` (peers included), per ``part``.

    ``prefix`` (decimals): difference of two growing frames, each evaluated in
    one pass (Spark's growing frames are incremental), so the cost is linear in
    the rows whatever the window density. It is exact for decimals and gives the
    same value as ``avg``. ``sliding``: Spark's bounded RANGE frame, which
    re-aggregates the frame on every row (cost rows x frame size); used for
    floating-point values, where a prefix difference would lose precision.
    """
    w = Window.partitionBy(*part).orderBy(_T)
    v = F.col(value)
    types = _mean_type(df.schema[value].dataType)
    if method == "sliding" or types is None:
        return F.avg(v).over(w.rangeBetween(-width, 0)).alias(out)
    sum_t, avg_t = types
    upto = w.rangeBetween(Window.unboundedPreceding, 0)
    before = w.rangeBetween(Window.unboundedPreceding, -width - 1)
    s = F.sum(v).over(upto) - F.coalesce(F.sum(v).over(before), F.lit(0))
    n = F.count(v).over(upto) - F.count(v).over(before)
    mean = (s.cast(sum_t) / n.cast(T.DecimalType(20, 0))).cast(avg_t)
    return F.when(n > 0, mean).alias(out)


def trailing_mean(df: DataFrame, value: str, time: str, keys: Sequence[str],
                  width="30 minutes", out: str = "mov_avg", bucket=None,
                  method: str = "prefix") -> DataFrame:
    """Add ``out`` = mean of ``value`` over rows of the same ``keys`` whose
    ``time`` lies in ``[time - width, time]`` (RANGE frame: rows at the same
    time all count). NULL values are skipped; no value -> NULL.

    ``bucket`` >= ``width``: split each series into buckets of that width;
    rows in the last ``width`` of a bucket are copied into the next bucket as
    ghosts so every frame is complete inside one bucket. Costs at most one copy
    per row (width/bucket of them on average); the largest task holds two
    buckets of one series instead of the whole series.

    ``bucket`` < ``width`` (decimals): prefix sums with a carry table, see
    ``_prefix_mean``; more shuffles, but no task holds more than one bucket of
    one series, whatever the window width.

    Floating-point values with a ``bucket``: sums of panes of that width (of ``width``
    at most), see ``_pane_mean``. Nothing is subtracted, so no digits are lost and an
    infinite or NaN value touches only the frames that hold it; the cost is linear.
    Without a bucket Spark's sliding frame is used, which re-aggregates it on every row.
    """
    width_us = interval_micros(width)
    keys = list(keys)
    with_t = df.withColumn(_T, epoch_micros(df, time))
    if bucket is None:
        return with_t.select("*", _range_mean(with_t, value, keys, width_us, out, method)).drop(_T)
    bucket_us = interval_micros(bucket)
    floating = isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))
    if method == "prefix" and floating:
        return _pane_mean(with_t, value, keys, width_us, min(bucket_us, width_us), out)
    if bucket_us < width_us:
        if method != "prefix" or _mean_type(df.schema[value].dataType) is None:
            raise ValueError("a bucket narrower than the window needs method='prefix' on a decimal or floating value")
        return _prefix_mean(with_t, value, keys, width_us, bucket_us, out)
    b = time_bucket(F.col(_T), bucket_us)
    # One pass: each row is emitted in its own bucket, and again (as a ghost)
    # in the next bucket when it lies within ``width`` of that bucket's start.
    near_end = F.col(_T) >= b + F.lit(bucket_us - width_us)
    ghost = F.explode(F.when(near_end, F.array(F.lit(False), F.lit(True)))
                      .otherwise(F.array(F.lit(False)))).alias("__ghost")
    spread = with_t.select("*", ghost).withColumn(
        _B, b + F.when(F.col("__ghost"), F.lit(bucket_us)).otherwise(F.lit(0)))
    res = spread.select("*", _range_mean(spread, value, keys + [_B], width_us, out, method))
    return res.where(~F.col("__ghost")).drop(_T, _B, "__ghost")


def _prefix_mean(df: DataFrame, value: str, keys: list[str], width_us: int, bucket_us: int,
                 out: str) -> DataFrame:
    """Trailing mean with buckets of any width (narrower than the window too).

    mean(t) = (P(t) - P(t - width - 1us)) / (N(t) - N(t - width - 1us)), where
    P(x) and N(x) are the sum and count of values at times <= x in the series.
    A prefix splits into the sum inside x's bucket (a growing window frame
    evaluated at a probe row placed at x) plus the totals of all earlier
    buckets (a carry table, one row per series and bucket). Probes are made
    two per row and recombined per (series, time) by a grouped aggregate, then
    joined back to the rows. Every task holds one bucket of one series, or one
    (series, time) tie group, however hot the series is.
    """
    sum_t, avg_t = _mean_type(df.schema[value].dataType)
    df = df.withColumn(_K, F.struct(*keys))
    keys, kcols = [_K], [F.col(_K)]
    vals = df.select(*kcols, F.col(_T), F.col(value).alias("__v")).where(F.col("__v").isNotNull())
    # Two probes per row; rows with the same (series, time) give identical
    # probes, so they are recombined with max below instead of de-duplicated
    # here (that would cost a shuffle).
    points = df.select(*kcols, F.col(_T).alias("__t0"))
    probes = points.select(*kcols, "__t0", F.explode(F.array(
        F.struct(F.lit(1).alias("sign"), F.col("__t0").alias("x")),
        F.struct(F.lit(-1).alias("sign"), (F.col("__t0") - F.lit(width_us + 1)).alias("x")))).alias("__p"))
    probes = probes.select(*kcols, "__t0", F.col("__p.sign").alias("__sign"), F.col("__p.x").alias(_T))
    u = (vals.withColumn(_SIDE, F.lit(0))
         .unionByName(probes.withColumn(_SIDE, F.lit(1)), allowMissingColumns=True)
         .withColumn(_B, time_bucket(F.col(_T), bucket_us)))
    w = Window.partitionBy(*keys, _B).orderBy(_T).rangeBetween(Window.unboundedPreceding, 0)
    inner = (u.select(*kcols, _B, _SIDE, "__t0", "__sign",
                      F.sum("__v").over(w).alias("__s"), F.count("__v").over(w).alias("__n"))
              .where(F.col(_SIDE) == 1))
    # Carry: totals of all earlier buckets, from one partial aggregate over
    # value rows (side 1) and probe rows (side 0, contributing nothing). A
    # probe bucket sorts before the value bucket with the same start, so its
    # running total holds earlier buckets only.
    per_bucket = (u.withColumn(_SIDE, 1 - F.col(_SIDE))
                  .groupBy(*keys, _B, _SIDE).agg(F.sum("__v").alias("__s"), F.count("__v").alias("__n")))
    cw = (Window.partitionBy(*keys).orderBy(_B, _SIDE)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    carry = (per_bucket.select(*kcols, _B, _SIDE, F.sum("__s").over(cw).alias("__cs"),
                               F.sum("__n").over(cw).alias("__cn"))
             .where(F.col(_SIDE) == 0).drop(_SIDE))
    prefix = inner.join(carry, on=keys + [_B], how="left").select(
        *kcols, "__t0", "__sign",
        (F.coalesce("__s", F.lit(0)) + F.coalesce("__cs", F.lit(0))).alias("__P"),
        (F.coalesce("__n", F.lit(0)) + F.coalesce("__cn", F.lit(0))).alias("__N"))
    hi, lo = F.col("__sign") == 1, F.col("__sign") == -1
    per_time = prefix.groupBy(*keys, "__t0").agg(
        (F.max(F.when(hi, F.col("__P"))) - F.max(F.when(lo, F.col("__P")))).alias("__ws"),
        (F.max(F.when(hi, F.col("__N"))) - F.max(F.when(lo, F.col("__N")))).alias("__wn"))
    mean = (F.col("__ws").cast(sum_t) / F.col("__wn").cast(T.DecimalType(20, 0))).cast(avg_t)
    per_time = per_time.select(_K, "__t0", F.when(F.col("__wn") > 0, mean).alias(out))
    joined = df.withColumnRenamed(_T, "__t0").join(per_time, [_K, "__t0"], "left")
    return joined.select(*[c for c in df.columns if c not in (_T, _K)], out)


#: Bits of the leading part of a value that sums keep without rounding: its sums of up to
#: 2 ** (53 - LEAD_BITS) values are exact.
LEAD_BITS = 26


def _two_parts(df: DataFrame, value: str) -> tuple[Column, Column]:
    """A double as the sum of two: a multiple of a quantum fitted to the column's largest
    value (sums of such multiples are exact) and the small rest (whose sums round at
    2 ** -53 of the quantum's size). Not finite values are the first part."""
    x = F.col(value).cast("double")
    huge = F.lit(2.0 ** 900)
    size = F.when(F.abs(x) <= huge, F.abs(x))
    top = df.agg(F.max(size).alias("top")).scalar()
    # Adding and taking away 1.5 * 2 ** 52 quanta rounds to whole quanta.
    quantum = F.pow(F.lit(2.0), F.ceil(F.log2(F.greatest(top, F.lit(2.0 ** -900)))) - F.lit(LEAD_BITS))
    lift = F.coalesce(quantum, F.lit(0.0)) * F.lit(1.5 * 2.0 ** 52)
    lead = F.when(F.abs(x) <= huge, (x + lift) - lift).otherwise(x)
    return lead, F.when(F.abs(x) <= huge, x - lead).otherwise(F.when(x.isNotNull(), F.lit(0.0)))


def _dyadic(first: Column, stop: Column, levels: int) -> Column:
    """[first, stop) as an array of (level, node): node i of level j covers panes
    [i * 2^j, (i + 1) * 2^j). At most two nodes of a level."""
    start = F.struct(first.alias("l"), stop.alias("r"), F.array().cast("array<struct<level:int,node:long>>").alias("nodes"))

    def step(s: Column, level: Column) -> Column:
        l, r = s["l"], s["r"]
        take_l, take_r = (l < r) & (l % 2 != 0), (l < r) & (r % 2 != 0)
        none = F.array().cast("array<struct<level:int,node:long>>")
        node = lambda i: F.array(F.struct(level.cast("int").alias("level"), i.cast("long").alias("node")))
        left = F.when(take_l, node(l)).otherwise(none)
        right = F.when(take_r & ((l + 1 < r) | ~take_l), node(r - 1)).otherwise(none)
        up_l = F.shiftright(l + F.when(take_l, 1).otherwise(0), 1)
        up_r = F.shiftright(r - F.when(take_r, 1).otherwise(0), 1)
        return F.struct(up_l.alias("l"), up_r.alias("r"), F.concat(s["nodes"], left, right).alias("nodes"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step, lambda s: s["nodes"])


def _pane_mean(df: DataFrame, value: str, keys: list[str], width_us: int, pane_us: int, out: str) -> DataFrame:
    """Trailing mean of a floating value from sums of panes, nothing subtracted.

    The frame [t - width, t] is the end of one pane, whole panes, and the beginning of
    t's own pane (panes are no wider than the frame). Two probe rows per row bring in the
    ends: growing frames within (series, pane), one in order of time and one against it. Whole
    panes come from a dyadic tree: sums of 1, 2, 4, ... neighbouring panes, one grouped
    aggregate over panes; a range of panes is a few nodes, found by an equi-join. Values are summed in two
    parts (:func:`_two_parts`). A task holds one pane of one series, one tie
    group or one node's rows, however hot the series is.
    """
    df = df.withColumn(_K, F.struct(*keys))
    lead, rest = _two_parts(df, value)
    pane = F.floor(F.col(_T) / F.lit(pane_us)).cast("long")  # doubles of micros are whole numbers
    vals = (df.where(F.col(value).isNotNull() & F.col(_T).isNotNull())
            .select(_K, _T, lead.alias("__hi"), rest.alias("__lo"), F.lit(1).cast("long").alias("__n")))
    points = df.where(F.col(_T).isNotNull()).select(_K, F.col(_T).alias("__t0"))
    probes = points.select(_K, "__t0", F.explode(F.array(
        F.struct(F.lit(1).alias("end"), F.col("__t0").alias("x")),
        F.struct(F.lit(-1).alias("end"), (F.col("__t0") - F.lit(width_us)).alias("x")))).alias("__p"))
    probes = probes.select(_K, "__t0", F.col("__p.end").alias("__end"), F.col("__p.x").alias(_T))
    u = vals.unionByName(probes, allowMissingColumns=True).withColumn(_B, pane)
    upto = (Window.partitionBy(_K, _B).orderBy(_T).rangeBetween(Window.unboundedPreceding, 0))
    since = (Window.partitionBy(_K, _B).orderBy(F.col(_T).desc()).rangeBetween(Window.unboundedPreceding, 0))
    sums = ["__hi", "__lo", "__n"]
    ends = u.select(_K, _B, "__t0", "__end", *[
        F.when(F.col("__end") == 1, F.sum(c).over(upto)).otherwise(F.sum(c).over(since)).alias(c) for c in sums]
        ).where(F.col("__end").isNotNull())
    frames = ends.groupBy(_K, "__t0").agg(
        *[F.max(F.when(F.col("__end") == e, F.col(_B))).alias(f"__pane{i}") for i, e in enumerate((-1, 1))],
        *[F.max(F.when(F.col("__end") == e, F.col(c))).alias(f"{c}{i}") for c in sums for i, e in enumerate((-1, 1))])

    levels = max(0, (width_us // pane_us + 1).bit_length())
    panes = vals.withColumn(_B, pane).groupBy(_K, _B).agg(*[F.sum(c).alias(c) for c in sums])
    tree = (panes.withColumn("__level", F.explode(F.sequence(F.lit(0), F.lit(levels))))
            .groupBy(_K, "__level", F.expr(f"shiftright({_B}, __level)").alias("__node"))
            .agg(*[F.sum(c).alias(c) for c in sums]))
    spans = frames.select(_K, "__pane0", "__pane1").distinct()
    nodes = spans.withColumn("__x", F.explode(_dyadic(F.col("__pane0") + 1, F.col("__pane1"), levels)))
    nodes = nodes.select(_K, "__pane0", "__pane1", F.col("__x.level").alias("__level"), F.col("__x.node").alias("__node"))
    whole = (nodes.join(tree, [_K, "__level", "__node"]).groupBy(_K, "__pane0", "__pane1")
             .agg(*[F.sum(c).alias(f"{c}2") for c in sums]))
    frames = frames.join(whole, [_K, "__pane0", "__pane1"], "left")

    def total(c: str) -> Column:
        return F.coalesce(f"{c}0", F.lit(0)) + F.coalesce(f"{c}1", F.lit(0)) + F.coalesce(f"{c}2", F.lit(0))

    mean = F.when(total("__n") > 0, (total("__hi") + total("__lo")) / total("__n"))
    means = frames.select(_K, F.col("__t0").alias(_T), mean.alias(out))
    rows = df.join(means, [_K, _T], "left")
    return rows.select(*[c for c in df.columns if c not in (_T, _K)], out)


def _order_struct(cols: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in cols])


@dataclass(frozen=True)
class Slots:
    """Tables bucketed by (keys, slot): the slot column (epoch micros of its start), its width,
    the number of buckets, and the kind (column, value) of stored ghosts."""

    column: str
    width: int
    buckets: int
    kind: str
    ghost: str


#: Buckets of a block of the carry's prefix scan.
BLOCK = 1024


def last_known(probes: DataFrame, events: DataFrame, keys: Sequence[str], time: str,
               values: Mapping[str, str], tie: Sequence[str] = (), bucket=None,
               probe_time: str | None = None, distinct_probes: bool = False,
               means: Mapping[str, tuple[str, object]] | None = None,
               block: int = BLOCK, slots: Slots | None = None) -> DataFrame:
    """As-of lookup: add, to each probe row, the last non-NULL value of each
    event column in ``values`` (``{out_name: event_col}``) among events of the
    same ``keys`` with ``time <= probe time`` (inclusive).

    Order among events is total: ``time``, then ``tie`` columns, then the value
    itself, so equal times give a deterministic answer. Each output column skips
    NULLs on its own (``last(..., ignorenulls)``).

    Unbucketed: probes and events are unioned and one window per series does
    the work. ``bucket=``: the window runs per (series, time bucket), and one
    more row at the start of a bucket carries in the last values of earlier
    ones. These rows come from a parallel prefix scan (:func:`_prefix_last`) over
    the buckets' own last values, with ``block`` buckets a task. Events are
    scanned and shuffled once: the windows and the buckets' values read the same exchange,
    and probes, events and carried rows meet without a further one.

    ``distinct_probes``: identical probe rows come out once. The duplicates are
    dropped after the window, where rows are already hash-partitioned by the
    series (and bucket), so it costs no extra shuffle of the probe table.

    ``means``: ``{out_name: (event_col, width)}``, the last known *trailing mean*
    of an event column, i.e. ``trailing_mean`` evaluated at each event and then
    looked up as of each probe, on the same partitioning as the lookup. With
    buckets (no narrower than any width), events in the last ``width`` of a bucket
    are copied into the next one as ghosts that complete its frames and are looked
    up by nobody.

    ``slots``: events and probes come from tables that are bucketed by the keys and a
    slot column, with the ghosts stored (:class:`Slots`); then they are not exchanged at all.

    Events without a time are never the last known; probes without one get NULL.
    """
    if slots is not None:
        bucket = slots.width
    keys = list(keys)
    tie = list(tie)
    probe_time = probe_time or time
    means = dict(means or {})
    widest = max((interval_micros(w) for _, w in means.values()), default=0)
    if bucket is not None and interval_micros(bucket) < widest:
        raise ValueError("a bucket narrower than a mean's window; use trailing_mean(bucket=) first")
    names = list(values)
    priv = {o: f"__v{i}" for i, o in enumerate(names)}
    mean_src = {o: f"__m{i}" for i, o in enumerate(means)}
    part = [f"__k{i}" for i in range(len(keys))]
    own_keys = [F.col(k).alias(c) for k, c in zip(keys, part)]
    stored = [F.col(slots.column).alias(_B), (F.col(slots.kind) == slots.ghost).alias("__ghost")] if slots else []
    ev = events.select(*own_keys, F.col(time).alias(_T + "ts"), *tie, *stored,
                       *[F.col(values[o]).alias(priv[o]) for o in names],
                       *[F.col(means[o][0]).alias(mean_src[o]) for o in means])
    ev = ev.withColumn(_T, epoch_micros(ev, _T + "ts")).drop(_T + "ts").where(F.col(_T).isNotNull())
    # The keys (and a slot) travel under one name each: Spark then sees that all sides are
    # partitioned alike.
    renamed = {**dict(zip(keys, part)), **({slots.column: _B} if slots else {})}
    pr = probes.select(*[c for c in probes.columns if c not in renamed],
                       epoch_micros(probes, probe_time).alias(_T), *own_keys, *stored[:1])
    if slots is None:
        ev = ev.withColumn("__ghost", F.lit(False))
    if bucket is not None:
        bucket_us = interval_micros(bucket)
        part = [*part, _B]
    if bucket is not None and slots is None:
        ev = ev.withColumn(_B, time_bucket(F.col(_T), bucket_us))
        pr = pr.withColumn(_B, time_bucket(F.col(_T), bucket_us))
        if means:
            near_end = F.col(_T) >= F.col(_B) + F.lit(bucket_us - widest)
            copies = F.when(near_end, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
            ev = ev.withColumn("__ghost", F.explode(copies)).withColumn(
                _B, F.col(_B) + F.when(F.col("__ghost"), F.lit(bucket_us)).otherwise(F.lit(0)))

    # Probe columns ride along on probe rows only; the union is by name.
    probe_cols = [c for c in pr.columns if c not in part and c != _T]
    ties = [f"__tie{i}" for i in range(len(tie))]
    ev_side = ev.select(*part, _T, "__ghost", *[F.col(c).alias(t) for c, t in zip(tie, ties)],
                        *priv.values(), *mean_src.values())
    if bucket is not None and slots is None:
        ev_side = ev_side.repartition(*part)
    ev_side = ev_side.withColumn(_SIDE, F.lit(0))
    pr_side = pr.select(*part, _T, F.lit(1).alias(_SIDE),
                        *[F.col(c) for c in probe_cols])
    looked = {**{o: priv[o] for o in names}, **{o: f"__mean_{o}" for o in means}}

    def with_means(u: DataFrame) -> DataFrame:
        # Probe rows carry no value, so the frames sum event values only.
        for o, (_, width) in means.items():
            u = u.select("*", _range_mean(u, mean_src[o], part, interval_micros(width),
                                          f"__mean_{o}", "prefix"))
        return u.withColumns({f"__mean_{o}": F.when(F.col(_SIDE) == 0, F.col(f"__mean_{o}")) for o in means})

    # The order among events is the same whether a mean is looked up or a value.
    order = [_T, _SIDE, *ties] + [priv[o] for o in names]
    if bucket is None:
        u = with_means(ev_side.drop("__ghost").unionByName(pr_side, allowMissingColumns=True))
    else:
        own = with_means(ev_side).where(~F.col("__ghost")).drop("__ghost", *mean_src.values())
        series = F.struct(*part[:-1]).alias(_K)
        carried = _bucket_carry(own.groupBy(*part), pr.select(series, _B), series,
                                [_T, *ties] + [priv[o] for o in names], list(looked.values()), bucket_us, block)
        carried = carried.select(*[F.col(_K)[c].alias(c) for c in part[:-1]], _B, F.col(_B).alias(_T),
                                 F.lit(-1).alias(_SIDE), *looked.values())
        # All three are partitioned alike, and so is their union.
        if slots is None:
            pr_side, carried = pr_side.repartition(*part), carried.repartition(*part)
        else:
            carried = carried.repartition(slots.buckets, *part)
        u = own.unionByName(pr_side, allowMissingColumns=True).unionByName(carried, allowMissingColumns=True)
    w = (Window.partitionBy(*part).orderBy(*order)
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = u.select(*part, _T, _SIDE, *probe_cols,
                     *[F.last(c, ignorenulls=True).over(w).alias(o) for o, c in looked.items()]
                     ).where(F.col(_SIDE) == 1)
    if distinct_probes:
        found = found.dropDuplicates()
    return found.select(*[F.col(renamed[c]).alias(c) if c in renamed else F.col(c) for c in probes.columns], *looked)


def _bucket_carry(buckets: GroupedData, probes: DataFrame, series: Column, order: list[str], vals: list[str],
                  bucket_us: int, block: int) -> DataFrame:
    """Per (series, probe bucket): last non-NULL value of each ``vals`` column
    over all *earlier* buckets. Built from a per-bucket aggregate, so its size is
    (series x buckets), whatever the row count. Events are partitioned by (series, bucket)
    already, so theirs needs no shuffle; probe buckets are a hash distinct."""
    per_bucket = buckets.agg(*[
        F.max_by(F.col(v), F.when(F.col(v).isNotNull(), _order_struct([*order, v]))).alias(v)
        for v in vals]).withColumn(_K, series)
    asked = probes.where(F.col(_B).isNotNull()).distinct()
    at = (F.col(_B) / F.lit(bucket_us)).cast("long").alias("__at")  # starts are whole multiples
    rows = (per_bucket.select(_K, at, F.lit(False).alias("__asked"), *vals)
            .unionByName(asked.select(_K, at, F.lit(True).alias("__asked")), allowMissingColumns=True))
    return (_prefix_last(rows, vals, block)
            .select(_K, (F.col("__at") * F.lit(bucket_us)).alias(_B), *vals))


def _prefix_last(rows: DataFrame, vals: list[str], block: int, levels: int = 2) -> DataFrame:
    """For each (series, ``__at``) row that has ``__asked``: the last non-NULL value of
    each of ``vals`` at places strictly before it.

    A blocked prefix scan: ``block`` neighbouring places are one task's window, the
    last values of whole blocks are scanned in the same way one level up, and what
    comes from earlier blocks fills what the own block leaves NULL. A series of n places
    needs no task of more than ``block`` and ``n / block`` places (at two levels). Both
    uses of the rows read one exchange.
    """
    def last(part: list[str]) -> list[Column]:
        earlier = Window.partitionBy(*part).orderBy("__at").rangeBetween(Window.unboundedPreceding, -1)
        return [F.last(v, ignorenulls=True).over(earlier).alias(v) for v in vals]

    if levels <= 1:
        return rows.select(_K, "__at", "__asked", *last([_K])).where("__asked").drop("__asked")
    blk = f"__block{levels}"
    rows = rows.withColumn(blk, F.floor(F.col("__at") / F.lit(block))).repartition(_K, blk)
    inside = rows.select(_K, "__at", blk, "__asked", *last([_K, blk])).where("__asked")
    blocks = rows.groupBy(_K, F.col(blk).alias("__at")).agg(
        F.max("__asked").alias("__asked"),
        *[F.max_by(v, F.when(F.col(v).isNotNull(), F.col("__at"))).alias(v) for v in vals])
    before = _prefix_last(blocks, vals, block, levels - 1).select(
        _K, F.col("__at").alias(blk), *[F.col(v).alias(f"{v}__before") for v in vals])
    return (inside.join(before, [_K, blk], "left")
            .select(_K, "__at", *[F.coalesce(v, f"{v}__before").alias(v) for v in vals]))


def period_close(events: DataFrame, keys: Sequence[str], period: str, time: str, value: str,
                 tie: Sequence[str] = (), out: str = "close") -> DataFrame:
    """One row per (keys, period): ``value`` of the period's last event by
    (``time``, ``tie``..., ``value``). A NULL value on that last event gives a
    NULL close (it is not skipped).

    A grouped ``max_by`` instead of a sorted window: partial aggregation on the
    map side, a shuffle of one row per (task, group), no sort of the events.
    """
    ordering = _order_struct([time, *tie, value])
    return events.groupBy(*keys, period).agg(F.max_by(F.col(value), ordering).alias(out))


def prior_period(periods: DataFrame, keys: Sequence[str], period: str, value: str,
                 out: str | None = None) -> DataFrame:
    """Replace ``value`` by its value on the previous ``period`` row of the same
    ``keys`` (``lag`` by one row: previous period *present in the data*)."""
    out = out or f"prior_{value}"
    w = Window.partitionBy(*keys).orderBy(period)
    return periods.select(*keys, period, F.lag(value, 1).over(w).alias(out))
