"""Lexicon scores for headlines."""

from __future__ import annotations

import gc
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

# The short word lists.
POSITIVE_SHORT = ["rise", "gain", "beat", "profit", "growth", "up", "record", "strong"]
NEGATIVE_SHORT = ["fall", "drop", "miss", "loss", "decline", "down", "weak", "cut"]
# Words that the long lists add.
POSITIVE_LONG = POSITIVE_SHORT + ["bull", "surge", "soar", "rally", "high", "positive", "buy"]
NEGATIVE_LONG = NEGATIVE_SHORT + ["bear", "crash", "plunge", "slump", "low", "negative", "sell"]

# All Unicode white space, which a plain split removes.
BLANKS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"

SCORES = ("positive", "negative", "neutral", "compound")
# A scorer maps a text column to struct(positive, negative, neutral, compound).
Scorer = Callable[[Column], Column]

#: Bytes of texts that are Python strings at a time, or one longer text.
SCORED_BYTES = 1 << 23


def tokens(text: Column) -> Column:
    """Lower-case tokens of the whole text, with repeats."""
    return F.split(F.lower(text), BLANKS)


def hits(found: Column, words: Sequence[str]) -> Column:
    """How many distinct ``words`` are among the tokens; the intersection drops
    repeats itself."""
    return F.size(F.array_intersect(found, F.array(*[F.lit(w) for w in words])))


def lexicon(positive: Sequence[str] = POSITIVE_SHORT,
            negative: Sequence[str] = NEGATIVE_SHORT) -> Scorer:
    """Share of distinct hits on each side. A text without hits is neutral; a
    missing text scores like an empty one."""

    def score(text: Column) -> Column:
        # One pass over the text; both sides then look at the few words found.
        words = F.array(*[F.lit(w) for w in dict.fromkeys([*positive, *negative])])
        found = F.array_intersect(tokens(F.coalesce(text, F.lit(""))), words)
        pos, neg = hits(found, positive), hits(found, negative)
        total = F.greatest(pos + neg, F.lit(1))
        return F.struct(
            (pos / total).alias("positive"),
            (neg / total).alias("negative"),
            (1 - (pos + neg) / total).alias("neutral"),
            ((pos - neg) / total).alias("compound"),
        )

    return score


def batch_scorer(score: Callable[[pd.Series], pd.DataFrame]) -> Scorer:
    """A scorer from a function of texts to a frame of the four scores, row by row.

    Spark's batches grow with the input up to its limits of rows and bytes. They stay Arrow
    buffers here, and about ``SCORED_BYTES`` at a time become the strings that ``score`` gets.
    A series whose ``.str`` was used refers to itself, so its strings would outlive their batch
    until Python happens to look for such cycles; here they are freed before the next part.
    """

    @F.arrow_udf(", ".join(f"{c} double" for c in SCORES))
    def scored(texts: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes.astype(np.int64)) // SCORED_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
        done = []
        for a, b in zip(cuts, cuts[1:]):
            frame = score(texts.slice(a, b - a).to_pandas())
            columns = [pa.array(frame[c], pa.float64(), from_pandas=True) for c in SCORES]
            done.append(pa.StructArray.from_arrays(columns, SCORES))
            del frame
            gc.collect()
        return pa.concat_arrays(done)

    return scored


def compound(positive: Sequence[str] = POSITIVE_LONG,
             negative: Sequence[str] = NEGATIVE_LONG) -> Callable[[Column], Column]:
    scorer = lexicon(positive, negative)
    return lambda text: scorer(text)["compound"]


def label(score: Column, edge: float = 0.05, up: str = "Bullish", down: str = "Bearish") -> Column:
    return F.when(score > edge, up).when(score < -edge, down).otherwise("Neutral")


def wide_label(score: Column) -> Column:
    return label(score, 0.1, "Positive", "Negative")
