"""Nearest neighbours by a forest of sorted hash-prefix arrays.

Each tree hashes a vector to a string of ``LENGTH`` sign bits of random projections
and keeps its strings sorted, so every prefix is a range. A query descends to its
longest matching prefix, then all trees ascend together, one bit at a time, until
their ranges hold enough candidates; those are scored exactly.

Vectors that are equal share one entry. The index is dealt into shards of bounded
size that stay where they are: every query visits every shard of its vector length,
in a stream that a task reads after it has built the shard's trees, and the best of each
shard merge in one small aggregate. Candidates wanted are a share of the shard and some
more for every answer, as vectors without structure have no shorter way to high recall.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TREES = 128
LENGTH = 24
#: Entries of a shard, on average, and queries that are answered together.
SHARD_ROWS = 16_384
BLOCK_QUERIES = 1_024
#: Candidates wanted per query and shard: this share of it and so many for each answer.
SHARE = 0.25
PER_ANSWER = 12


def planes(dim: int, trees: int = TREES, length: int = LENGTH, seed: int = 11) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dim, trees * length))


def hash_strings(x: np.ndarray, trees: int = TREES, length: int = LENGTH) -> np.ndarray:
    """One ``length``-bit string per row and tree, as an integer whose first bit is the highest."""
    out = np.empty((len(x), trees), np.uint32)
    p, powers = planes(x.shape[1], trees, length), (1 << np.arange(length)[::-1]).astype(np.float64)
    for a in range(0, len(x), 2048):
        bits = (x[a:a + 2048] @ p > 0).reshape(-1, trees, length)
        out[a:a + 2048] = (bits @ powers).astype(np.uint32)
    return out


class Forest:
    """The sorted strings of a shard's entries, one array a tree."""

    def __init__(self, index: np.ndarray, ids: np.ndarray, trees: int = TREES, length: int = LENGTH):
        self.index, self.ids, self.trees, self.length = index, ids, trees, length
        strings = hash_strings(index, trees, length)
        self.order = np.argsort(strings, axis=0, kind="stable").astype(np.int32).T.copy()
        self.sorted = np.take_along_axis(strings.T, self.order, 1)

    def _ranges(self, strings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """By level, query and tree, the range of the entries whose first bits are the query's."""
        low = np.zeros((self.length + 1, len(strings), self.trees), np.int32)
        high = np.full((self.length + 1, len(strings), self.trees), len(self.ids), np.int32)
        for t in range(self.trees):
            for level in range(1, self.length + 1):
                rest = np.uint32((1 << (self.length - level)) - 1)
                low[level, :, t] = np.searchsorted(self.sorted[t], strings[:, t] & ~rest)
                high[level, :, t] = np.searchsorted(self.sorted[t], strings[:, t] | rest, side="right")
        return low, high

    def nearest(self, queries: np.ndarray, k: int, share: float = SHARE, per_answer: int = PER_ANSWER):
        """For each query the positions and scores of its ``k`` best candidates, ties by ``ids``."""
        n = len(self.ids)
        wanted = min(n, int(share * n) + per_answer * k)
        low, high = self._ranges(hash_strings(queries, self.trees, self.length))
        for q in range(len(queries)):
            seen = np.zeros(n, bool)
            for level in range(self.length, -1, -1):
                size = high[level, q] - low[level, q]
                # Different entries that ranges of these sizes hold, if they met at random.
                if level and n * (1 - np.prod(1 - size / n)) < wanted and size.sum() < self.trees * n:
                    continue
                if level == 0:
                    seen[:] = True
                    break
                for t in range(self.trees):
                    seen[self.order[t, low[level, q, t]:high[level, q, t]]] = True
                if seen.sum() >= wanted:
                    break
            at = np.flatnonzero(seen)
            scores = self.index[at] @ queries[q]
            if len(at) > k:
                worst = np.partition(scores, len(at) - k)[len(at) - k]
                keep = scores >= worst  # with all ties, so that ids can decide
                at, scores = at[keep], scores[keep]
            best = np.lexsort((self.ids[at], -scores))[:k]
            yield at[best], scores[best]


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


_FOUND = pa.schema([("query", pa.int64()), ("score", pa.float64()), ("ids", pa.list_(pa.int64()))])


def _search_batches(k):
    """Answers of the queries of a partition whose rows are sorted by shard, entries before queries."""

    def answers(forest, members, asked, queries):
        for a in range(0, len(asked), BLOCK_QUERIES):
            out = ([], [], [])
            for who, (at, scores) in zip(asked[a:a + BLOCK_QUERIES], forest.nearest(queries[a:a + BLOCK_QUERIES], k)):
                out[0].append(np.full(len(at), who))
                out[1].append(scores)
                out[2].extend(members[i] for i in at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(out[0])), pa.array(np.concatenate(out[1])), pa.array(out[2], _FOUND.field("ids").type)],
                schema=_FOUND)

    def run(batches):
        shard, forest, vectors, entries, members = None, None, [], [], []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("size", "shard", "asks")])
            starts = np.flatnonzero(np.r_[True, (keys[:, 1:] != keys[:, :-1]).any(axis=0)])
            for a, b in zip(starts, np.r_[starts[1:], batch.num_rows]):
                rows, here = batch.slice(int(a), int(b - a)), tuple(keys[:2, a])
                if here != shard:
                    shard, forest, vectors, entries, members = here, None, [], [], []
                entry, x = rows.column("entry").to_numpy(), _matrix(rows.column("vector"))
                if not keys[2, a]:
                    vectors.append(x)
                    entries.append(entry)
                    members.extend(rows.column("ids").to_pylist())
                elif members:
                    if forest is None:
                        forest, vectors = Forest(np.concatenate(vectors), np.concatenate(entries)), []
                    yield from answers(forest, members, entry, x)

    return run


def usable(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part.

    Left out: null ids, null, empty or zero vectors, and null or non-finite components.
    Vectors of any length stay. Exactly repeated rows count once; extra columns are ignored.
    """
    v = F.col(vector_col)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fine = rows.where(F.col(id_col).isNotNull() & v.isNotNull()).where(~bad & F.exists(v, lambda x: x != 0))
    kind = "float" if rows.schema[vector_col].dataType.elementType.simpleString() == "float" else "double"
    fine = fine.select(F.col(id_col).cast("long").alias("vec_id"), v.cast(f"array<{kind}>").alias("vector"))
    return fine.dropDuplicates(["vec_id", "vector"])


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best rows found for each query row.

    ``rows`` and ``queries`` are tables of :func:`usable`; queries are among the rows.
    Scores are inner products in double precision; ties go to the smaller id. A row never
    answers itself, and only vectors of its own length answer it. Equal vectors are one entry
    with its ``k + 1`` smallest ids: no answer can need more of them. Empty tables give no rows,
    and a query with fewer than ``k`` others gets them all.
    """
    by_vector = Window.partitionBy("vector").orderBy("vec_id")
    entries = (
        rows.withColumn("_n", F.row_number().over(by_vector)).where(F.col("_n") <= k + 1)
        .groupBy("vector").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .withColumn("size", F.size("vector"))
    )
    shards = entries.groupBy("size").agg(F.greatest(F.lit(1), F.round(F.count(F.lit(1)) / SHARD_ROWS)).cast("long").alias("shards"))
    asked = queries.join(entries.select("vector", "entry"), "vector").select("vec_id", "entry", "vector")
    index = entries.join(shards, "size").select(
        "size", F.pmod(F.xxhash64("entry"), "shards").alias("shard"), F.lit(0).alias("asks"), "entry", "vector", "ids")
    probes = asked.dropDuplicates(["entry"]).withColumn("size", F.size("vector")).join(shards, "size").select(
        "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), F.lit(1).alias("asks"),
        "entry", "vector", F.lit(None).cast("array<long>").alias("ids"))
    found = index.unionByName(probes).repartition("size", "shard").sortWithinPartitions("size", "shard", "asks").mapInArrow(
        _search_batches(k + 1), "query long, score double, ids array<long>")
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    pairs = found.select("query", "score", F.explode("ids").alias("vec_id"))
    pairs = pairs.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        asked.select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")).join(pairs.drop("_n"), "query")
        .where(F.col("query_id") != F.col("vec_id"))
        .withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op4_prefix_forest(spark, sf_dir: str) -> DataFrame:
    rows = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return nearest(rows, rows.where(F.col("vec_id") % 20 == 0))
