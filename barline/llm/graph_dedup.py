"""Repeated passages by de Bruijn compaction of word windows.

The edges of the graph are the windows of ``WINDOW`` words; edges that follow one another
share all but one word. An edge row per word would be more than the text, so paths are
compacted before anything moves: of every window, the least hash of its parts
of some words is its anchor, and consecutive windows of one anchor form a *piece*. Equal windows
have equal anchors, so

* a piece whose anchor no other document holds has no repeated window, and goes first;
* equal pieces are counted as one node (``paths``), with their first source, the pieces
  before and after them, and whether those differ (a branch);
* joined back to their documents, pieces follow their path as long as no branch comes
  between; the source's coordinates must advance in step with the document's, which
  verifies the long span that they make;
* only pieces that are the first of their kind, and whose anchor has other pieces too, can
  hold windows that a *part* of another piece equals: at the branches. These stay open and
  are cut again by longer anchors, the last of which are whole windows, single edges.

Pieces and windows are known by 128 bits of hash, anchors by 64 (an equal anchor only
keeps a piece in the search). All groups are combined map-side, and joins have one side
that is unique in its key, so that Spark can split the other where a key is hot.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tokens import mix, owner, slices, texts, words
from barline.session import stage

WINDOW = 50
#: Words of an anchor, round by round: fewer make longer and fewer pieces, more make rarer anchors.
ANCHORS = (16, 36, WINDOW)
_BASES = (0x9E3779B97F4A7C15 | 5, 0xD6E8FEB86659FD93 | 5)


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base modulo 2**64, and of its inverse."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Spans:
    """128-bit digests of any span of a flat array of words, in constant time each."""

    def __init__(self, flat: pa.Array):
        coded = pc.dictionary_encode(flat)
        each = [xxhash.xxh3_128_digest(w) for w in coded.dictionary.cast(pa.large_binary()).to_pylist()]
        halves = np.frombuffer(b"".join(each), np.uint64).reshape(-1, 2)
        at = coded.indices.to_numpy(zero_copy_only=False)
        n = len(at)
        self.sums, self.back = [], []
        for k, base in enumerate(_BASES):
            power, inverse = _powers(base, n + 1)
            total = np.zeros(n + 1, np.uint64)
            np.cumsum(halves[at, k] * power[:n], out=total[1:]) if n else None
            self.sums.append(total)
            self.back.append(inverse)

    def digest(self, start: np.ndarray, end: np.ndarray, half: int) -> np.ndarray:
        total = self.sums[half]
        return mix((total[end] - total[start]) * self.back[half][start] + (end - start).astype(np.uint64))


def least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of the ``width`` values from each position on."""
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


_PIECE = "doc_id long, start int, windows int, anchor long, before int, after int, d1 long, d2 long"
_FOUND = "array<struct<start:int,windows:int,d1:long,covered:boolean,enters:boolean,leaves:boolean,source:long,source_start:int>>"
_SPANS = "array<struct<start:int,words:int,source:long,source_start:int>>"
_OPENS = "array<struct<start:int,windows:int>>"
_SETTLED = f"doc_id long, n_words long, n_removed long, kept_sha256 string, text string, spans {_SPANS}, opens {_OPENS}"


def cut(offsets: np.ndarray, spans: Spans, anchor: int, wanted: np.ndarray | None = None, window: int = WINDOW) -> dict[str, np.ndarray]:
    """The pieces of each text: its number, first window, windows, anchor and neighbours.

    ``wanted`` marks the words at which a window that matters starts (all, if none is given).
    """
    n = int(offsets[-1])
    at = np.zeros(0, np.int64)
    if n >= window:
        doc = owner(offsets)
        inside = doc[: n - window + 1] == doc[window - 1:]
        at = np.flatnonzero(inside if wanted is None else inside & wanted[: n - window + 1])
    if not len(at):
        return {k: np.zeros(0, np.int64) for k in ("doc", "start", "windows", "anchor", "before", "after", "d1", "d2")}
    part = spans.digest(np.arange(n - anchor + 1), np.arange(anchor, n + 1), 0)
    lead = least(part, window - anchor + 1)  # of the window from each word on
    d, v = doc[at], lead[at]
    first = np.r_[True, (d[1:] != d[:-1]) | (v[1:] != v[:-1]) | (at[1:] != at[:-1] + 1)]
    first |= anchor == window  # single edges, also where equal ones follow one another
    a, d = at[first], d[first]
    count = np.diff(np.r_[np.flatnonzero(first), len(at)])
    d1, d2 = (spans.digest(a, a + count + window - 1, k) for k in (0, 1))
    joined = (d[1:] == d[:-1]) & (a[1:] == a[:-1] + count[:-1])
    short = (d2 >> np.uint64(33)).astype(np.int64)
    return {"doc": d, "start": a - offsets[d], "windows": count, "anchor": v[first].view(np.int64),
            "before": np.r_[-1, np.where(joined, short[:-1], -1)], "after": np.r_[np.where(joined, short[1:], -1), -1],
            "d1": d1.view(np.int64), "d2": d2.view(np.int64)}


def _ranges(start: np.ndarray, length: np.ndarray, size: int) -> np.ndarray:
    """Marks of the positions that any of the ranges covers."""
    edges = np.zeros(size + 1, np.int64)
    np.add.at(edges, start, 1)
    np.add.at(edges, start + length, -1)
    return np.cumsum(edges[:-1]) > 0


def _lists(column: pa.Array) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """The row of each item of a column of lists of structs, and the items' fields."""
    sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    items = column.flatten()
    fields = {items.type.field(i).name: items.field(i).to_numpy(zero_copy_only=False) for i in range(items.type.num_fields)}
    return np.repeat(np.arange(len(column)), sizes), fields


def _piece_batches(anchor: int, again: bool):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                offsets, flat = words(texts(part.column("text")))
                spans, wanted = Spans(flat), None
                if again:
                    row, opens = _lists(part.column("opens"))
                    wanted = _ranges(offsets[row] + opens["start"], opens["windows"].astype(np.int64), len(flat))
                got = cut(offsets, spans, anchor, wanted)
                ids = part.column("doc_id").take(pa.array(got.pop("doc")))
                small = ("start", "windows", "before", "after")
                yield pa.RecordBatch.from_arrays(
                    [ids, *(pa.array(v, pa.int32() if k in small else pa.int64()) for k, v in got.items())], ["doc_id", *got])

    return run


def search(rows: DataFrame, anchor: int, again: bool) -> DataFrame:
    """Pieces that an earlier document has (``covered``), and those that may hold such windows.

    ``rows`` have doc_id and text, and ``opens`` if only their windows are ``again`` to be
    cut. ``enters`` and ``leaves`` say that no branch lies before or behind the piece.
    """
    read = rows.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", *(["opens"] if again else []))
    pieces = read.mapInArrow(_piece_batches(anchor, again), _PIECE)
    shared = pieces.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi").select("anchor")
    shared = stage(shared, "anchors")  # dealt out anew by the join, which can then split a hot anchor's pieces
    pieces = stage(pieces.join(shared, "anchor", "left_semi"), "pieces")
    paths = pieces.groupBy("d1", "d2").agg(
        F.min("anchor").alias("anchor"), F.min(F.struct("doc_id", "start")).alias("source"),
        (F.min("before") == F.max("before")).alias("enters"),
        (F.min("after") == F.max("after")).alias("leaves"))
    paths = stage(paths, "paths")
    branches = paths.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1").select("anchor", F.lit(True).alias("branch"))
    paths = paths.join(stage(branches, "branches"), "anchor", "left").drop("anchor")
    covered = F.col("source.doc_id") < F.col("doc_id")
    return pieces.join(paths, ["d1", "d2"]).where(covered | F.col("branch")).select(
        "doc_id", "start", "windows", "d1", covered.alias("covered"), "enters", "leaves",
        F.col("source.doc_id").alias("source"), F.col("source.start").alias("source_start"))


def _passages(row, start, length, enters, leaves, source, source_start):
    """Spans put together where the path and the source's coordinates go on in step."""
    if not len(row):
        return row, start, length, source, source_start
    order = np.lexsort((start, start - source_start, source, row))
    row, start, length, enters, leaves, source, source_start = (
        x[order] for x in (row, start, length, enters, leaves, source, source_start))
    shift = start - source_start
    same = (row[1:] == row[:-1]) & (source[1:] == source[:-1]) & (shift[1:] == shift[:-1])
    lift = np.r_[0, np.cumsum(~same)] * int((start + length).max() + 1)
    end = np.maximum.accumulate(start + length + lift) - lift  # a span may lie within one before it
    goes = same & enters[1:] & leaves[:-1] & (start[1:] <= end[:-1])
    first = np.flatnonzero(np.r_[True, ~goes])
    end = np.maximum.reduceat(start + length, first)
    return row[first], start[first], end - start[first], source[first], source_start[first]


def _struct_lists(rows: int, row: np.ndarray, none: np.ndarray | None, fields: dict[str, pa.Array]) -> pa.Array:
    offsets = np.r_[0, np.cumsum(np.bincount(row, minlength=rows))].astype(np.int32)
    items = pa.StructArray.from_arrays(list(fields.values()), list(fields))
    return pa.ListArray.from_arrays(pa.array(offsets), items, mask=None if none is None else pa.array(none))


def _settle_batches(window: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                n = part.num_rows
                text = texts(part.column("text"))
                offsets, flat = words(text)
                row, found = _lists(part.column("found"))
                start, count = found["start"].astype(np.int64), found["windows"].astype(np.int64)
                if len(row):  # rows that share an id tell their own pieces by the digest
                    a, b = offsets[row] + start, offsets[row] + start + count + window - 1
                    fits = b <= offsets[row + 1]
                    fits[fits] = Spans(flat).digest(a[fits], b[fits], 0).view(np.int64) == found["d1"][fits]
                    row, start, count = row[fits], start[fits], count[fits]
                    found = {k: v[fits] for k, v in found.items()}
                has = found["covered"].astype(bool) if len(row) else np.zeros(0, bool)
                r, s, w, source, at = _passages(
                    row[has], start[has], count[has] + window - 1, found["enters"][has].astype(bool), found["leaves"][has].astype(bool),
                    found["source"][has], found["source_start"][has].astype(np.int64))
                before, old = _lists(part.column("spans"))
                r, s, w, source, at = (np.r_[x, y] for x, y in zip((before, old["start"], old["words"], old["source"], old["source_start"]), (r, s, w, source, at)))
                ever = np.ones(len(r), bool)  # the ends of a path's span come in later rounds
                r, s, w, source, at = _passages(*(x.astype(np.int64) for x in (r, s, w)), ever, ever, source, at)
                gone = _ranges(offsets[r] + s, w, len(flat))
                removed = np.diff(np.r_[0, np.cumsum(gone)][offsets])
                kept = np.r_[0, np.cumsum(~gone)][offsets]
                left = flat.filter(pa.array(~gone)) if len(flat) else flat
                joined = pc.binary_join(pa.ListArray.from_arrays(pa.array(kept, pa.int32()), left.cast(pa.string())), " ")
                digests = [hashlib.sha256(t.as_buffer()).hexdigest() for t in joined.cast(pa.binary())]
                still = np.bincount(row[~has], minlength=n) > 0
                text = pc.if_else(pa.array(still), text, pa.scalar(None, pa.large_string())).cast(pa.string())
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()),
                    pa.array(digests, pa.string()), text,
                    _struct_lists(n, r, None, {"start": pa.array(s, pa.int32()), "words": pa.array(w, pa.int32()),
                                               "source": pa.array(source, pa.int64()), "source_start": pa.array(at, pa.int32())}),
                    _struct_lists(n, row[~has], ~still, {"start": pa.array(start[~has], pa.int32()),
                                                         "windows": pa.array(count[~has], pa.int32())}),
                ], ["doc_id", "n_words", "n_removed", "kept_sha256", "text", "spans", "opens"])

    return run


def settle(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Take the covered words out of each row; a row with open pieces keeps its text."""
    fields = ("start", "windows", "d1", "covered", "enters", "leaves", "source", "source_start")
    per_doc = found.groupBy(F.col("doc_id").alias("id")).agg(F.collect_set(F.struct(*fields)).cast(_FOUND).alias("found"))
    joined = rows.join(per_doc, F.col("doc_id") == F.col("id"), "left").select("doc_id", "text", "spans", "found")
    return joined.mapInArrow(_settle_batches(WINDOW), _SETTLED)


def remove_repeats(docs: DataFrame, anchors: tuple[int, ...] = ANCHORS) -> DataFrame:
    """Words, removed words, digest of the kept words and removed passages of each row.

    A word goes if a window of ``WINDOW`` words that holds it also starts in a document of a
    smaller id. ``spans`` name the passages: first word, words, and where the source has
    them. A null or empty text has no words; rows without an id lose none and are no
    source; rows of one id are judged each by its own text and never against each other;
    a table without rows gives none. Whole texts are read, however long. Other columns
    are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.lit(None).cast(_SPANS).alias("spans"), F.lit(None).cast(_OPENS).alias("opens"))
    done = None
    for k, anchor in enumerate(anchors):
        found = search(rows, anchor, k > 0)
        settled = stage(settle(rows, found), "settled")
        ready = settled.where("opens IS NULL").select("doc_id", "n_words", "n_removed", "kept_sha256", "spans")
        done = ready if done is None else done.unionByName(ready)
        rows = settled.where("opens IS NOT NULL").select("doc_id", "text", "spans", "opens")
    return done


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i+49], ' ')) AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w)),
firsts AS (SELECT k, min(doc_id) AS f FROM win GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (
  SELECT DISTINCT doc_id, i + j AS i FROM (
    SELECT win.doc_id, win.i, unnest(range(0, 50)) AS j FROM win JOIN firsts USING (k) WHERE f < win.doc_id)),
one AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (
  SELECT one.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY one.i) AS t
  FROM one LEFT JOIN gone ON gone.doc_id = one.doc_id AND gone.i = one.i WHERE gone.i IS NULL GROUP BY one.doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


def op11_graph_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")
