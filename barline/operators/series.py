"""Positions, blocks and carries for ordered series of any length.

A series is all rows of one key in time order. No operator here sorts a whole
series in one task. Rows get a 0-based position from per-bucket counts, then
work runs on blocks of ``BLOCK`` consecutive positions. What a block needs from
its past reaches it in one of two ways:

* a halo: the last rows of the previous block are copied into it, enough for
  every fixed-length frame;
* a carry: one summary row per block is scanned in block order, and the result
  is joined back on ``(key, block)``. Blocks are scanned by chapters of ``CHAPTER`` blocks:
  a state that fades reads a halo of block summaries from the chapter before, one that does
  not takes the scan of whole chapters as its start. So no task gets all blocks of a series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows per block, as a power of two so that block numbers are shifts.
BLOCK_BITS = 9
BLOCK = 1 << BLOCK_BITS

# Blocks per chapter, as a power of two.
CHAPTER_BITS = 9
# Rows of a bucket that one task sorts; a larger one is cut into so many pieces by its counts.
BUCKET_ROWS, PIECES = 1 << 14, 64

KEY, POS, LENGTH, BLK = "symbol", "pos", "n", "blk"


def index_series(
    df: DataFrame,
    key: str = KEY,
    order: str = "date",
    neighbours: Sequence[str] = (),
    bucket: Column | None = None,
) -> DataFrame:
    """Add ``pos`` (0-based), ``n`` (series length) and ``prev_c`` / ``next_c``
    for every column ``c`` in ``neighbours``.

    ``order`` must be unique within a key. Rows without a key or an order have
    no place in a series and are left out; ``keyless`` has them. ``bucket`` cuts a series into pieces
    that one task can sort; it must not decrease with ``order``. The default is the calendar
    year: at most 366 rows if ``order`` is a date. A time has no such bound, so years
    of more than ``BUCKET_ROWS`` rows are cut where their counts say; see ``measured_buckets``.
    Only one row per bucket is scanned across a whole key.
    """
    rows = df.where(F.col(key).isNotNull() & F.col(order).isNotNull())
    if bucket is None and dict(df.dtypes)[order] != "date":
        bucketed = measured_buckets(rows, key, order)
    else:
        bucketed = rows.withColumn("_bucket", F.year(order) if bucket is None else bucket)
    summary = [F.count(F.lit(1)).alias("_rows")]
    for c in neighbours:
        summary += [F.min_by(c, order).alias(f"_first_{c}"), F.max_by(c, order).alias(f"_last_{c}")]
    across = Window.partitionBy(key).orderBy("_bucket")
    before = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(key, "_bucket")
        .agg(*summary)
        .select(
            key,
            "_bucket",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
            F.sum("_rows").over(Window.partitionBy(key)).alias(LENGTH),
            *[F.lag(f"_last_{c}").over(across).alias(f"_last_{c}") for c in neighbours],
            *[F.lead(f"_first_{c}").over(across).alias(f"_first_{c}") for c in neighbours],
        )
    )
    within = Window.partitionBy(key, "_bucket").orderBy(order)
    whole = Window.partitionBy(key, "_bucket")
    placed = bucketed.join(offsets, [key, "_bucket"]).withColumns(
        {
            "_rank": F.row_number().over(within),
            "_size": F.count(F.lit(1)).over(whole),
            **{f"_lag_{c}": F.lag(c).over(within) for c in neighbours},
            **{f"_lead_{c}": F.lead(c).over(within) for c in neighbours},
        }
    )
    edges = []
    for c in neighbours:
        first, last = F.col("_rank") == 1, F.col("_rank") == F.col("_size")
        edges += [
            F.when(first, F.col(f"_last_{c}")).otherwise(F.col(f"_lag_{c}")).alias(f"prev_{c}"),
            F.when(last, F.col(f"_first_{c}")).otherwise(F.col(f"_lead_{c}")).alias(f"next_{c}"),
        ]
    return placed.select(
        *df.columns, (F.col("_before") + F.col("_rank") - 1).alias(POS), LENGTH, *edges
    )


def measured_buckets(rows: DataFrame, key: str = KEY, order: str = "timestamp") -> DataFrame:
    """Add ``_bucket``: the year, and within a year of more than ``BUCKET_ROWS`` rows the piece.

    Pieces end at quantiles of the year's own times, so they hold about as many rows each,
    however the rows crowd. Quantiles come from a sketch that is combined map-side; where they
    lie decides only who sorts a row, never its position.
    """
    time = F.unix_micros(F.col(order).cast("timestamp"))
    timed = rows.withColumns({"_year": F.year(order), "_time": time})
    shares = [k / PIECES for k in range(1, PIECES)]
    ends = timed.groupBy(key, "_year").agg(
        F.count(F.lit(1)).alias("_rows"), F.percentile_approx("_time", shares, 1000).alias("_ends")
    ).select(key, "_year", F.when(F.col("_rows") > BUCKET_ROWS, F.col("_ends")).alias("_ends"))
    passed = " + ".join(f"CAST(_time > _ends[{k}] AS INT)" for k in range(PIECES - 1))
    piece = f"_year * {2 * PIECES} + CASE WHEN _ends IS NULL THEN 0 ELSE {passed} END"
    return timed.join(ends, [key, "_year"]).selectExpr(*rows.columns, f"{piece} AS _bucket")


def keyless(df: DataFrame, key: str = KEY, order: str = "date") -> DataFrame:
    """The rows that ``index_series`` leaves out."""
    return df.where(F.col(key).isNull() | F.col(order).isNull())


# Place of a row: its block, and its offset there. The expressions of this
# module are SQL text, which reads like the formulas and builds quickly.
BLOCK_OF = f"shiftright({POS}, {BLOCK_BITS})"
OFFSET = f"({POS} & {BLOCK - 1})"


def with_halo(df: DataFrame, halo: int) -> DataFrame:
    """Add ``blk`` and repeat the last ``halo`` rows of each block in the next.

    Repeated rows have ``own = false``; drop them once the frames are read.
    """
    if not 0 < halo <= BLOCK:
        raise ValueError(f"halo must be in 1..{BLOCK}")
    feeds_next = f"{OFFSET} >= {BLOCK - halo} AND ({BLOCK_OF} + 1) * {BLOCK} < {LENGTH}"
    homes = f"CASE WHEN {feeds_next} THEN array({BLOCK_OF}, {BLOCK_OF} + 1) ELSE array({BLOCK_OF}) END"
    return df.selectExpr("*", f"explode({homes}) AS {BLK}").withColumn(
        "own", F.expr(f"{BLK} = {BLOCK_OF}")
    )


def with_block(df: DataFrame) -> DataFrame:
    return df.withColumn(BLK, F.expr(BLOCK_OF))


def over_block(frame: str = "", key: str = KEY) -> str:
    """``OVER`` clause within a block, with an optional row frame."""
    return f"OVER (PARTITION BY {key}, {BLK} ORDER BY {POS} {frame})"


def over_trailing(rows: int, key: str = KEY) -> str:
    """The current row and the ``rows - 1`` before it."""
    return over_block(f"ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW", key)


def earlier_blocks(totals: DataFrame, value: str, out: str, reach: int, key: str = KEY) -> DataFrame:
    """Add ``out``, the list of ``value`` of the ``reach`` blocks before each, in order.

    A chapter also gets the summaries that its first blocks reach back to.
    """
    homes = f"sequence(shiftright({BLK}, {CHAPTER_BITS}), shiftright({BLK} + {reach}, {CHAPTER_BITS}))"
    placed = totals.selectExpr("*", f"explode({homes}) AS _chapter")
    over = f"OVER (PARTITION BY {key}, _chapter ORDER BY {BLK} ROWS BETWEEN {reach} PRECEDING AND 1 PRECEDING)"
    listed = placed.selectExpr("*", f"collect_list({value}) {over} AS {out}")
    return listed.where(f"_chapter = shiftright({BLK}, {CHAPTER_BITS})").drop("_chapter")


def over_all_earlier(blocks: DataFrame, value: Column, out: str, kind: str, key: str = KEY) -> DataFrame:
    """Add ``out``, the product or max (``kind``) of ``value`` over all blocks before each.

    Two levels: within its chapter, and over whole chapters before it.
    """
    combine = {"product": F.product, "max": F.max}[kind]
    chapter = Window.partitionBy(key, "_chapter")
    before = chapter.orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("_chapter", F.shiftright(BLK, CHAPTER_BITS)).withColumn("_v", value)
    within = placed.withColumn("_within", combine("_v").over(before))
    across = Window.partitionBy(key).orderBy("_chapter").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.groupBy(key, "_chapter").agg(combine("_v").alias("_whole"))
    starts = whole.select(key, "_chapter", combine("_whole").over(across).alias("_start"))
    both = {"product": "coalesce(_start, 1D) * coalesce(_within, 1D)", "max": "greatest(_start, _within)"}[kind]
    return within.join(starts, [key, "_chapter"]).selectExpr(*blocks.columns, f"{both} AS {out}")


def warm(value: str, rows: int) -> str:
    """NULL until the series holds ``rows`` rows."""
    return f"CASE WHEN {POS} >= {rows - 1} THEN {value} END"


def tail(df: DataFrame, rows: int) -> DataFrame:
    """Last ``rows`` rows of each series, re-numbered from 0."""
    skip = f"greatest({LENGTH} - {rows}, 0)"
    changed = {POS: f"{POS} - {skip}", LENGTH: f"least({LENGTH}, {rows})"}
    for c in df.columns:
        if c.startswith("prev_"):
            changed[c] = f"CASE WHEN {POS} > {skip} THEN {c} END"
    kept = df.where(f"{POS} >= {skip}")
    return kept.selectExpr(*[f"{changed.get(c, c)} AS {c}" for c in df.columns])


# -- first-order recurrences ---------------------------------------------------


class Recurrence(NamedTuple):
    """``y_t = q * y_{t-1} + gain_t``, where the gain of a row enters at
    position ``enter``. Both are SQL expressions over the row."""

    q: float
    gain: str
    enter: str

    def local(self, key: str = KEY) -> str:
        """State from the gains of this block alone: one running sum. ``q`` to
        the power ``-BLOCK`` stays in double range for every ``q`` above 0.25."""
        scaled = f"({self.gain}) * pow({self.q}D, {POS} - {OFFSET} - {self.enter})"
        return f"pow({self.q}D, {OFFSET}) * sum({scaled}) {over_block('ROWS UNBOUNDED PRECEDING', key)}"

    def total(self) -> str:
        """This block's part of the state at its last row: a plain sum, so it
        combines map-side and needs no sort."""
        return f"sum(({self.gain}) * pow({self.q}D, {POS} - {OFFSET} + {BLOCK - 1} - {self.enter}))"

    def full(self, local: str, carry: str) -> str:
        return f"({local} + pow({self.q}D, {OFFSET} + 1) * {carry})"

    @property
    def block_decay(self) -> float:
        return self.q**BLOCK

    @property
    def reach(self) -> int:
        """Blocks after which any finite double times this decay is zero, so
        that a carry over that many blocks is the exact carry."""
        return math.ceil(1500 / (-math.log(self.q) * BLOCK)) + 1


def smoothing(value: str, alpha: float, start: int = 0) -> Recurrence:
    """Exponential mean that begins with the value at position ``start``."""
    if not 0 < alpha <= 0.75:
        raise ValueError("alpha must be in (0, 0.75]")
    gain = (
        f"CASE WHEN {POS} < {start} THEN 0D WHEN {POS} = {start} THEN {value} "
        f"ELSE {alpha}D * ({value}) END"
    )
    return Recurrence(1.0 - alpha, gain, POS)


def ewm(df: DataFrame, value: str, alpha: float, out: str, min_rows: int = 1, start: int = 0,
        key: str = KEY) -> DataFrame:
    """Exponential mean of ``value`` over an indexed series, as
    ``y_0 = x_0, y_t = (1 - alpha) * y_{t-1} + alpha * x_t``.

    ``value`` must not be NULL from position ``start`` on. The result is NULL
    before ``min_rows`` values have been seen.
    """
    r = smoothing(value, alpha, start)
    totals = df.groupBy(key, F.expr(BLOCK_OF).alias(BLK)).agg(F.expr(r.total()).alias("_total"))
    fold = f"aggregate(_earlier, 0D, (a, x) -> a * {r.block_decay}D + x)"
    carries = earlier_blocks(totals, "_total", "_earlier", r.reach, key).selectExpr(key, BLK, f"{fold} AS _carry")
    local = with_block(df).withColumn("_local", F.expr(r.local(key)))
    y = warm(r.full("_local", "_carry"), start + min_rows)
    return local.join(carries, [key, BLK]).selectExpr(*df.columns, f"{y} AS {out}")


def running_product(df: DataFrame, factor: str, out: str, key: str = KEY,
                    before: str | None = None, peak: str | None = None) -> DataFrame:
    """Product of ``factor`` up to and including each row of an indexed series.

    ``before`` names a column for the product of the rows before (1 at the
    start); ``peak`` names one for the highest product so far.
    """
    block = Window.partitionBy(key, BLK).orderBy(POS)
    up_to = block.rowsBetween(Window.unboundedPreceding, 0)
    ahead = block.rowsBetween(Window.unboundedPreceding, -1)
    one = F.lit(1.0)
    local = with_block(df).withColumn("_p", F.product(factor).over(up_to))
    made = [f"_c * _p AS {out}"]
    if before:
        local = local.withColumn("_b", F.coalesce(F.product(factor).over(ahead), one))
        made.append(f"_c * _b AS {before}")
    kept = ["_c"]
    if peak:
        # A carry may be negative, so the peak of a scaled block can come from
        # its lowest local product.
        local = local.withColumns({"_hi": F.max("_p").over(up_to), "_lo": F.min("_p").over(up_to)})
        made.append(f"greatest(_peak, _c * _hi, _c * _lo) AS {peak}")
        ends = local.groupBy(key, BLK).agg(
            F.max_by("_p", POS).alias("_end"), F.max("_p").alias("_top"), F.min("_p").alias("_bottom"))
        carries = over_all_earlier(ends, F.col("_end"), "_c", "product", key)
        top = F.greatest(F.col("_c") * F.col("_top"), F.col("_c") * F.col("_bottom"))
        carries = over_all_earlier(carries, top, "_peak", "max", key)
        kept.append("_peak")
    else:
        # A product per block needs no order, so it is combined map-side from the rows.
        ends = with_block(df).groupBy(key, BLK).agg(F.product(factor).alias("_end"))
        carries = over_all_earlier(ends, F.col("_end"), "_c", "product", key)
    return local.join(carries.select(key, BLK, *kept), [key, BLK]).selectExpr(*df.columns, *made)
