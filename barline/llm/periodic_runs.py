"""Periodic runs of words by online dyadic square catching.

A run is a maximal stretch in which words ``period`` apart are identical. Words are
appended in chunks to a ``SquareCatcher``. At level ``k`` every completed block of 2**k
words is a catcher for squares of periods 2**k to 2**(k+1) - 1. When ``t`` words are there,
exactly one live catcher of a level is as far before the last 2**k words as such a period,
``((t >> k) - 2) << k``, so an appended word advances one suffix comparison a level, and a
chunk does all of them at once. Equal block and suffix report a square, which
is extended both ways; squares of one start and period merge into one run, and runs that
touch the end stay open and grow as words come. A run of three periods holds a whole block
with its copy, so none is missed.

Comparisons take hashes; the words of every run are compared themselves at the end.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tokens import mix, slices, texts, words

#: A run has at least this many words and this many periods.
LEAST_WORDS = 24
LEAST_PERIODS = 3
#: Words appended at once: bounds what a step of all levels holds.
CHUNK = 1 << 16
_BASE = 0x9E3779B97F4A7C15


class SquareCatcher:
    """Runs of a sequence of integer codes that is appended piece by piece."""

    def __init__(self, longest: int | None = None):
        """``longest``: words of the longest text, if known; no longer period is looked for."""
        self.longest = longest
        self.n = 0
        self.codes = np.zeros(1024, np.int64)
        self.power = np.ones(1025, np.uint64)  # of the base, and of its inverse
        self.inverse = np.ones(1025, np.uint64)
        self.sums = np.zeros(1025, np.uint64)
        self._fill(1)
        self.open = np.zeros((0, 2), np.int64)  # start and period
        self.closed: list[np.ndarray] = []  # start, end and period

    def _fill(self, known: int) -> None:
        for values, base in ((self.power, _BASE), (self.inverse, pow(_BASE, -1, 1 << 64))):
            values[known:] = base
            values[known - 1:] = np.multiply.accumulate(values[known - 1:])

    def _reserve(self, n: int) -> None:
        size = len(self.codes)
        if n <= size:
            return
        more = max(n, 2 * size) - size
        self.codes = np.r_[self.codes, np.zeros(more, np.int64)]
        self.sums, self.power, self.inverse = (np.r_[x, np.zeros(more, np.uint64)] for x in (self.sums, self.power, self.inverse))
        self._fill(size + 1)

    def _same(self, a: np.ndarray, b: np.ndarray, length) -> np.ndarray:
        """Whether the words from ``a`` and those from the later ``b`` on are equal."""
        s = self.sums
        return (s[a + length] - s[a]) * self.power[b - a] == s[b + length] - s[b]

    def append(self, codes: np.ndarray) -> None:
        old, n = self.n, self.n + len(codes)
        self._reserve(n)
        self.codes[old:n] = codes
        with np.errstate(over="ignore"):
            steps = mix(codes.view(np.uint64)) * self.power[old:n]
            self.sums[old + 1:n + 1] = self.sums[old] + np.cumsum(steps, dtype=np.uint64)
        self.n = n
        found = [self.open]
        k = 0
        while (1 << k) * LEAST_PERIODS <= (n if self.longest is None else min(n, self.longest)):
            size = 1 << k
            first = max(old + 1, 2 * size)  # the first number of words with a catcher
            if first <= n:
                found.append(self._catch(k, first, n))
            k += 1
        self._grow(np.unique(np.concatenate(found), axis=0) if len(found) > 1 else self.open)

    def _catch(self, k: int, first: int, last: int) -> np.ndarray:
        """Block and period of the squares that level ``k`` reports at ``first`` to ``last`` words."""
        size = 1 << k
        t = np.arange(first, last + 1)
        block, suffix = ((t >> k) - 2) << k, t - size
        low = max(0, int(block[0]))
        with np.errstate(over="ignore"):
            value = (self.sums[low + size:last + 1] - self.sums[low:last + 1 - size]) * self.inverse[low:last + 1 - size]
        hit = value[block - low] == value[suffix - low]
        fresh = hit.copy()  # a square that goes on from the block before is the same run's
        fresh[size:] &= ~hit[:-size]
        at = np.flatnonzero(fresh)
        return np.stack([block[at], suffix[at] - block[at]], axis=1)

    def _grow(self, squares: np.ndarray) -> None:
        """Extend squares both ways, and put those that end before the last word aside."""
        start, period = squares[:, 0].copy(), squares[:, 1]
        after, n = start.copy(), self.n
        for j in range(n.bit_length(), -1, -1):
            step = 1 << j
            at = np.flatnonzero(after + period + step <= n)
            at = at[self._same(after[at], after[at] + period[at], step)]
            after[at] += step
            at = np.flatnonzero(start >= step)
            at = at[self._same(start[at] - step, start[at] - step + period[at], step)]
            start[at] -= step
        end = after + period
        runs = np.unique(np.stack([start, end, period], axis=1), axis=0)
        going = runs[:, 1] == n
        self.open = runs[going][:, [0, 2]]
        done = runs[~going]
        self.closed.append(done[done[:, 1] - done[:, 0] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * done[:, 2])])

    def runs(self) -> np.ndarray:
        """Start, end (exclusive) and smallest period of every run, in order."""
        still = np.stack([self.open[:, 0], np.full(len(self.open), self.n), self.open[:, 1]], axis=1)
        still = still[still[:, 1] - still[:, 0] >= np.maximum(LEAST_WORDS, LEAST_PERIODS * still[:, 2])]
        found = np.unique(np.concatenate([*self.closed, still]), axis=0)
        if len(found):  # multiples of a run's period give the same stretch
            found = found[np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)]]
        exact = [r for a, b, p in found.tolist() for r in self._checked(a, b, p)]
        return np.array(exact, np.int64).reshape(-1, 3)

    def _checked(self, a: int, b: int, p: int) -> list[tuple[int, int, int]]:
        same = self.codes[a:b - p] == self.codes[a + p:b]
        if same.all():
            return [(a, b, p)]
        edge = np.flatnonzero(np.diff(np.r_[False, same, False].astype(np.int8)))
        return [(a + x, a + y + p, p) for x, y in zip(edge[::2].tolist(), edge[1::2].tolist())
                if y + p - x >= max(LEAST_WORDS, LEAST_PERIODS * p)]


def text_runs(offsets: np.ndarray, codes: np.ndarray, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """The text of each run, and its first word in that text, words and period.

    Texts are appended one after another, a code of its own behind each.
    """
    sizes = np.diff(offsets)
    at = np.arange(len(codes)) + np.repeat(np.arange(len(sizes)), sizes)
    line = np.full(len(codes) + len(sizes), -1, np.int64)
    line[at] = codes
    marks = offsets[1:] + np.arange(len(sizes))
    line[marks] = -2 - np.arange(len(sizes))
    catcher = SquareCatcher(int(sizes.max(initial=0)))
    for k in range(0, len(line), chunk):
        catcher.append(line[k:k + chunk])
    runs = catcher.runs()
    doc = np.searchsorted(marks, runs[:, 0], side="right")
    return doc, np.stack([runs[:, 0] - offsets[doc] - doc, runs[:, 1] - runs[:, 0], runs[:, 2]], axis=1)


def planted(doc_id, n: int) -> tuple[int, int] | None:
    """First word and period of the repetition that the contract writes into a text, if any."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def _run_batches(plant: bool):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                yield _measure(part, plant)

    return run


def _measure(part: pa.RecordBatch, plant: bool) -> pa.RecordBatch:
    offsets, flat = words(texts(part.column("text")))
    ids, n = part.column("doc_id").to_pylist(), part.num_rows
    take = np.arange(len(flat))
    for k, doc_id in enumerate(ids):
        size = int(offsets[k + 1] - offsets[k])
        if plant and (made := planted(doc_id, size)):
            a, p = made
            take[offsets[k] + a:offsets[k + 1]] = offsets[k] + a + np.arange(size - a) % p
    codes = pc.dictionary_encode(flat).indices.to_numpy(zero_copy_only=False).astype(np.int64)[take]
    doc, runs = text_runs(offsets, codes)
    edges = np.zeros(len(flat) + 1, np.int64)
    np.add.at(edges, offsets[doc] + runs[:, 0] + runs[:, 2], 1)
    np.add.at(edges, offsets[doc] + runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(edges[:-1]) == 0
    kept = flat.take(pa.array(take[keep]))
    bounds = np.r_[0, np.cumsum(keep)][offsets]
    joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), kept.cast(pa.string())), " ")
    per: list[list] = [[] for _ in range(n)]
    for d, r in zip(doc.tolist(), runs.tolist()):
        per[d].append(tuple(r))
    best: list[list] = [[], [], [], []]
    lines = []
    for found in per:
        found.sort(key=lambda r: (r[0], r[2]))
        lines.append(hashlib.sha256("".join(f"{s},{w},{p}\n" for s, w, p in found).encode()).hexdigest())
        s, w, p = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if found else (None,) * 3
        for out, value in zip(best, (s, w, p, 1000 * w // p if found else None)):
            out.append(value)
    spans = pa.array([[{"start": s, "length": w, "period": p} for s, w, p in found] for found in per], _SPAN_TYPE)
    return pa.RecordBatch.from_arrays(
        [part.column("doc_id"), pa.array([len(f) for f in per], pa.int64()), *(pa.array(b, pa.int64()) for b in best),
         pa.array(lines, pa.string()), pa.array([hashlib.sha256(t.as_buffer()).hexdigest() for t in joined.cast(pa.binary())], pa.string()),
         spans, joined], _NAMES)


_NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "runs", "collapsed"]
_SPAN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_SCHEMA = ("n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string, "
           "runs array<struct<start:long,length:long,period:long>>, collapsed string")


def periodic_runs(docs: DataFrame, plant: bool = False) -> DataFrame:
    """All runs of each row's text, its greatest, the text without repetitions, and digests.

    ``plant`` writes the contract's repetitions into the texts first. A null or empty text
    has no words and no run: null start, length, period and exponent, digests of the empty
    text. Ties go to the smallest start, then period. Rows are independent, so that
    repeated rows come out alike; a null id plants nothing; a table without rows gives
    none; other columns are ignored. Whole texts are read, however long: n log n
    comparisons for n words.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_run_batches(plant), f"doc_id {id_type}, {_SCHEMA}")


def op12_periodic_runs(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return periodic_runs(docs, plant=True).drop("runs", "collapsed")
