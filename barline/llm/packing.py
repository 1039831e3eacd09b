"""Best-fit packing of token sequences into bins of several permitted lengths.

Only lengths are shuffled. Sequences are dealt at random into shards of bounded
size, and each shard is packed by itself, so a shard costs at most one partly
filled bin per capacity more than one global packing would.

Within a shard, longest first: a sequence goes to the open bin with the least
room that still holds it. If there is none, a bin is opened. Every permitted size that
holds the sequence is tried against the sequences that remain: filled with the longest
that fit, again and again, then shrunk to its content. The size with the least cost per
token so filled is opened. A size costs its fixed overhead, its tokens, and a part that grows
with its square, as attention does; so a large bin pays only if it is filled better.
At the end each bin shrinks to the smallest permitted size that holds its content.
"""

from __future__ import annotations

import bisect
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Permitted sequence lengths, in tokens.
CAPACITIES = (512, 1024, 2048, 4096)
#: What opening a bin costs besides its tokens, and the size at which the square costs as much as them.
OVERHEAD = 32
EVEN = 8192
#: Pieces that one shard holds on average; bounds a task's memory.
SHARD_PIECES = 8192

OUT = "shard long, bin int, capacity int, position int, start_in_bin int, doc_id long, piece int, start long, length int"


def cost(size: int, overhead: int = OVERHEAD, even: int = EVEN) -> float:
    """What a bin of one size costs."""
    return overhead + size + size * size / even


class _Rest:
    """The sequences still to be placed, as counts by length."""

    def __init__(self, lengths: list[int]):
        self.count = Counter(lengths)
        self.kinds = sorted(self.count)

    def take(self, n: int) -> None:
        self.count[n] -= 1
        if not self.count[n]:
            del self.kinds[bisect.bisect_left(self.kinds, n)]

    def fill(self, room: int) -> int:
        """Tokens that a room would get from the longest sequences that fit."""
        got, at = 0, len(self.kinds)
        while room and (at := bisect.bisect_right(self.kinds, room, 0, at)):
            n = self.kinds[at - 1]
            times = min(self.count[n], room // n)
            got += times * n
            room -= times * n
            at -= 1
        return got


def best_fit(lengths: list[int], capacities=CAPACITIES, overhead: int = OVERHEAD, even: int = EVEN) -> tuple[list[int], list[int]]:
    """Bin of each sequence and final size of each bin. Lengths come in falling order."""
    sizes, rest = sorted(capacities), _Rest(lengths)
    price = {s: cost(s, overhead, even) for s in sizes}
    rooms: list[tuple[int, int]] = []  # (free, bin), sorted
    used: list[int] = []
    where: list[int] = []

    def per_token(size: int, n: int) -> tuple[float, int]:
        filled = n + rest.fill(size - n)
        return price[sizes[bisect.bisect_left(sizes, filled)]] / filled, size

    for n in lengths:
        rest.take(n)
        at = bisect.bisect_left(rooms, (n, -1))
        if at < len(rooms):
            free, b = rooms.pop(at)
        else:
            b = len(used)
            used.append(0)
            free = min(sizes[bisect.bisect_left(sizes, n):], key=lambda s: per_token(s, n))
        used[b] += n
        where.append(b)
        if free > n:
            bisect.insort(rooms, (free - n, b))
    return where, [sizes[bisect.bisect_left(sizes, u)] for u in used]


def _packer(capacities, overhead, even):
    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        rows = shard.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True],
                                 kind="stable", na_position="last")
        where, sizes = best_fit(rows["length"].tolist(), capacities, overhead, even)
        rows = rows.assign(bin=where, capacity=[sizes[b] for b in where])
        by_bin = rows.groupby("bin")["length"]
        return rows.assign(position=rows.groupby("bin").cumcount(),
                           start_in_bin=by_bin.cumsum() - rows["length"])[
            ["shard", "bin", "capacity", "position", "start_in_bin", "doc_id", "piece", "start", "length"]]

    return pack


def pack_lengths(items: DataFrame, capacities=CAPACITIES, overhead: int = OVERHEAD, even: int = EVEN,
                 shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """One row per piece: shard, bin, the bin's size, place in it, doc_id, piece, start, length.

    ``items`` has doc_id and n_tokens. A sequence longer than the largest size is cut
    into pieces of that size and a rest. Null or zero lengths have no piece and no row.
    Repeated rows and null ids are packed like any others; ties go by doc_id and piece.
    The result depends on the rows alone, not on how they are partitioned. Other columns are
    ignored; a table without rows gives none.
    """
    if min(capacities) < 1 or overhead < 0 or even <= 0:
        raise ValueError("sizes must be positive and costs not negative")
    top = max(capacities)
    n = F.col("n_tokens").cast("long")
    pieces = (
        items.where(n > 0).select(F.col("doc_id").cast("long").alias("doc_id"), n.alias("n"))
        .withColumn("piece", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / top).cast("long"))))
        .select("doc_id", F.col("piece").cast("int").alias("piece"), (F.col("piece") * top).alias("start"),
                F.least(F.lit(top).cast("long"), F.col("n") - F.col("piece") * top).cast("int").alias("length"))
    )
    total = items.select(F.sum(F.when(n > 0, F.floor((n - 1) / top) + 1))).first()[0] or 0
    shards = max(1, -(-int(total) // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(_packer(tuple(capacities), overhead, even), OUT)


def word_tokens(docs: DataFrame) -> DataFrame:
    """doc_id and n_tokens: words of the whole text and one end mark; 0 without words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A word starts where a character that is not white space follows one that is, or the start.
    words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    return docs.select("doc_id", words.alias("n")).select(
        "doc_id", F.when(F.col("n") > 0, F.col("n") + 1).otherwise(0).cast("long").alias("n_tokens"))


def op10_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_lengths(word_tokens(docs))
