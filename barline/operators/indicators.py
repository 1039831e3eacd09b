"""Technical indicators and model features over indexed bars.

Every function takes bars numbered by ``index_series(bars,
neighbours=["close"])``. All fixed-length frames and all recurrences of one
call share a single shuffle on ``(symbol, block)`` and one sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.operators.series import (
    BLK, BLOCK, BLOCK_BITS, BLOCK_OF, KEY, LENGTH, OFFSET, POS, Recurrence, index_series, keyless, over_block,
    earlier_blocks, over_trailing, smoothing, warm, with_block, with_halo,
)
from barline.schemas import INDICATORS

# Window lengths and band width.
RSI_ROWS, ATR_ROWS = 14, 14
FAST, SLOW, SIGNAL = 12, 26, 9
BAND_ROWS, BAND_WIDTH, VOLUME_ROWS = 20, 2, 20

SIGNAL_START = SLOW - 1
SIGNAL_ALPHA = 2 / (SIGNAL + 1)
SIGNAL_Q = 1 - SIGNAL_ALPHA

TRUE_RANGE = "greatest(high - low, abs(high - prev_close), abs(low - prev_close))"

RECURRENCES = {
    "up": smoothing("CASE WHEN close > prev_close THEN close - prev_close ELSE 0D END", 1 / RSI_ROWS),
    "down": smoothing("CASE WHEN close < prev_close THEN prev_close - close ELSE 0D END", 1 / RSI_ROWS),
    "fast": smoothing("close", 2 / (FAST + 1)),
    "slow": smoothing("close", 2 / (SLOW + 1)),
    # The average true range starts with the plain mean of its first rows, so
    # those rows enter together at the last of them.
    "atr": Recurrence(
        1 - 1 / ATR_ROWS, f"{TRUE_RANGE} / {ATR_ROWS}", f"greatest({POS}, {ATR_ROWS - 1})"
    ),
}


# -- the signal mean, a recurrence over the difference of two others ------------


def _echo(r: Recurrence, steps: str) -> str:
    """What one unit of a price mean adds to the signal mean within ``steps``
    further rows."""
    k = SIGNAL_ALPHA * r.q / (r.q - SIGNAL_Q)
    return f"{k}D * (pow({r.q}D, {steps}) - pow({SIGNAL_Q}D, {steps}))"


def _signal_total(r: Recurrence) -> str:
    """The part of the signal mean at the block's end that comes through one of
    the two price means: again a plain weighted sum over the block's rows."""
    steady = f"{_echo(r, f'({BLOCK} - {OFFSET})')} / {r.q}D"
    # Rows up to the signal's start act through the price mean at that row.
    rest = BLOCK - 1 - SIGNAL_START
    opening = f"pow({r.q}D, {SIGNAL_START} - {POS}) * (pow({SIGNAL_Q}D, {rest}) + {_echo(r, str(rest))})"
    weight = f"CASE WHEN {POS} <= {SIGNAL_START} THEN {opening} ELSE {steady} END"
    return f"sum(({r.gain}) * ({weight}))"


def _carries(bars: DataFrame) -> DataFrame:
    """State of every recurrence at the end of the block before each block."""
    rec = RECURRENCES
    totals = bars.groupBy(KEY, F.expr(BLOCK_OF).alias(BLK)).agg(
        *[F.expr(f"{r.total()} AS {n}") for n, r in rec.items()],
        F.expr(f"{_signal_total(rec['fast'])} - {_signal_total(rec['slow'])} AS signal"),
    )
    names = [*rec, "signal"]
    step = {n: f"a.{n} * {r.block_decay}D + x.{n}" for n, r in rec.items()}
    step["signal"] = (
        f"a.signal * {SIGNAL_Q**BLOCK}D + a.fast * {_echo(rec['fast'], str(BLOCK))} "
        f"- a.slow * {_echo(rec['slow'], str(BLOCK))} + x.signal"
    )
    zero = ", ".join(f"'{n}', 0D" for n in names)
    moved = ", ".join(f"'{n}', {step[n]}" for n in names)
    reach = max(r.reach for r in rec.values())
    listed = earlier_blocks(totals, f"struct({', '.join(names)})", "_earlier", reach)
    fold = f"aggregate(_earlier, named_struct({zero}), (a, x) -> named_struct({moved}))"
    return listed.selectExpr(KEY, BLK, f"{fold} AS _carry")


def _locals(own: bool) -> list[str]:
    """Block-local states. With a halo, its rows belong to the block before and
    add nothing."""
    out = []
    for n, r in RECURRENCES.items():
        if own:
            r = r._replace(gain=f"CASE WHEN own THEN {r.gain} ELSE 0D END")
        out.append(f"{r.local()} AS _{n}")
    return out


def _finish(framed: DataFrame, bars: DataFrame) -> DataFrame:
    """Join the carries and form the recursive indicators."""
    rec = RECURRENCES
    gain = (
        f"CASE WHEN {POS} < {SIGNAL_START} THEN 0D WHEN {POS} = {SIGNAL_START} THEN _fast - _slow "
        f"ELSE {SIGNAL_ALPHA}D * (_fast - _slow) END"
    )
    signal = Recurrence(SIGNAL_Q, gain, POS)
    joined = framed.selectExpr("*", f"{signal.local()} AS _signal").join(_carries(bars), [KEY, BLK])
    steps = f"({OFFSET} + 1)"
    states = {n: r.full(f"_{n}", f"_carry.{n}") for n, r in rec.items()}
    states["signal"] = (
        f"{signal.full('_signal', '_carry.signal')} + {_echo(rec['fast'], steps)} * _carry.fast "
        f"- {_echo(rec['slow'], steps)} * _carry.slow"
    )
    kept = [c for c in framed.columns if c not in {f"_{n}" for n in rec}]
    return joined.selectExpr(*kept, *[f"{y} AS s_{n}" for n, y in states.items()])


SIGNAL_ROWS = SLOW + SIGNAL - 1
RECURSIVE = {
    "rsi_14": warm("CASE WHEN s_down = 0 THEN 100D ELSE 100 - 100 / (1 + s_up / s_down) END", RSI_ROWS),
    "macd": warm("s_fast - s_slow", SLOW),
    "macd_signal": warm("s_signal", SIGNAL_ROWS),
    "macd_hist": warm("s_fast - s_slow - s_signal", SIGNAL_ROWS),
    "atr_14": f"CASE WHEN {POS} >= {ATR_ROWS - 1} THEN s_atr ELSE 0D END",
    "ema_12": warm("s_fast", FAST),
}

# Each frame once; the columns below share them.
FRAMES = [
    f"avg(close) {over_trailing(10)} AS _mean_10",
    f"avg(close) {over_trailing(BAND_ROWS)} AS _mean_20",
    f"stddev_pop(close) {over_trailing(BAND_ROWS)} AS _std_20",
    f"avg(volume) {over_trailing(VOLUME_ROWS)} AS _volume",
    f"lag(close, 5) {over_block()} AS _close_5",
]
ROLLED = {
    "sma_10": warm("_mean_10", 10),
    "sma_20": warm("_mean_20", 20),
    "bb_upper": warm(f"_mean_20 + {BAND_WIDTH} * _std_20", BAND_ROWS),
    "bb_lower": warm(f"_mean_20 - {BAND_WIDTH} * _std_20", BAND_ROWS),
    "bb_width": warm(f"try_divide({2 * BAND_WIDTH} * _std_20, _mean_20) * 100", BAND_ROWS),
    "vol_ratio": warm(
        "CASE WHEN _volume = 0 THEN 1D ELSE try_divide(volume, _volume) END", VOLUME_ROWS
    ),
    "return_1d": "try_divide(close, prev_close) - 1",
    "return_5d": "try_divide(close, _close_5) - 1",
}


def _named(columns: dict[str, str], names) -> list[str]:
    return [f"{columns[n]} AS {n}" for n in names]


def rolling(bars: DataFrame, *names: str) -> DataFrame:
    """Add fixed-length indicators (all, or those named): Bollinger bands,
    moving averages, volume ratio, returns. One shuffle and no carry; frames
    that no chosen column needs are pruned."""
    framed = with_halo(bars, BAND_ROWS - 1).selectExpr("*", *FRAMES).where("own")
    return framed.selectExpr(*bars.columns, *_named(ROLLED, names or ROLLED))


def recursive(bars: DataFrame, *names: str) -> DataFrame:
    """Add RSI, MACD with signal and histogram, ATR and the 12-row mean (all, or
    those named)."""
    framed = with_block(bars).selectExpr("*", *_locals(own=False))
    return _finish(framed, bars).selectExpr(*bars.columns, *_named(RECURSIVE, names or RECURSIVE))


def features(bars: DataFrame, last: int | None = None) -> DataFrame:
    """Add every indicator and moving average in one pass over the blocks.

    With ``last``, only for the last so many rows of each series, which are returned alone: blocks
    before theirs only sum into the carries, and are neither dealt out, sorted nor framed.
    """
    rows = bars
    if last is not None:
        first = f"shiftright(greatest({LENGTH} - {last}, 0), {BLOCK_BITS})"
        rows = bars.where(f"{BLOCK_OF} >= {first} - 1")
    placed = with_halo(rows, BAND_ROWS - 1)
    if last is not None:
        placed = placed.where(f"{BLK} >= {first}")
    framed = placed.selectExpr("*", *FRAMES, *_locals(own=True))
    columns = {**ROLLED, **RECURSIVE}
    names = [*INDICATORS, "ema_12", "sma_10", "sma_20", "vol_ratio"]
    done = _finish(framed.where("own"), bars)
    if last is not None:  # only now: the states of a block sum over all its rows
        done = done.where(f"{POS} >= {LENGTH} - {last}")
    return done.selectExpr(*bars.columns, *_named(columns, names))


def add_indicators(bars: DataFrame) -> DataFrame:
    """The ten indicator columns for bars that are not numbered yet. Bars without
    a symbol or a date are kept, with no indicators."""
    done = features(index_series(bars, neighbours=["close"])).select(*bars.columns, *INDICATORS)
    return done.unionByName(keyless(bars), allowMissingColumns=True)
