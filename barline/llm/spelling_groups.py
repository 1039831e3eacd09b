"""Spelling variants by a dictionary of trie-node pairs.

Words of a vocabulary are paths in a forward trie and, read from the end, in a reversed one.
A node's number is a 64-bit polynomial hash of its path, so that numbering takes one pass
over a word and no join. A place in a word is then a pair of integers, the node before and
the node behind:

* a *skip* leaves one letter out: two words of equal skips differ by a replaced letter;
* a *split* leaves none out: a skip that equals a split is a deleted letter, or an inserted
  one seen from the other word. Within a run of one letter only the first is skipped, so a
  pair of words is found once.

A group of equal skips has at most one word for each letter, so no group grows with the
vocabulary. Found pairs are compared letter by letter at the end.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tokens import mix, slices
from barline.session import stage

#: Letters of a word: A-Z, a-z and U+00C0 to U+00FF.
_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Code points and occurrences that a word needs, and the ratio of counts that makes a form.
LEAST_LETTERS = 5
LEAST_COUNT = 3
RATIO = 2
#: One occurrence in so many loses a letter.
DELETE_ONE_IN = 97
#: Different words that a task counts before it passes the counts on.
HELD = 400_000
_BASES = (0x9E3779B97F4A7C15 | 5, 0xD6E8FEB86659FD93 | 5)


def altered(doc_id, run: str) -> str:
    """The run as the contract alters it in one document."""
    h = zlib.crc32(f"{doc_id}:{run}".encode())
    at = h % len(run)
    return run[:at] + run[at + 1:] if h % DELETE_ONE_IN == 0 else run


def _count_batches(alter: bool):
    def flush(counts):
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    if not text:
                        continue
                    found = Counter(_RUN.findall(text.encode().translate(_LOWER).decode()))
                    if alter and doc_id is not None:
                        seed = zlib.crc32(f"{doc_id}:".encode())
                        for word in [w for w in found if zlib.crc32(w.encode(), seed) % DELETE_ONE_IN == 0]:
                            n = found.pop(word)
                            counts[altered(doc_id, word)] += n
                    counts.update(found)
                    if len(counts) > HELD:
                        yield flush(counts)
                        counts = Counter()
        yield flush(counts)

    return run


def vocabulary(docs: DataFrame, alter: bool = False) -> DataFrame:
    """Words of enough letters and occurrences, with their count, numbered in code-point order."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(_count_batches(alter), "word string, n long").where(F.length("word") >= LEAST_LETTERS)
    counts = counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)
    return stage(counts.orderBy("word").withColumn("id", F.monotonically_increasing_id()), "vocabulary")


def node_numbers(found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Letters of all words, first letter of each word, and the trie nodes of every place.

    Place ``i`` of a word lies before its letter ``i``; the words' places follow one
    another, one more than letters each.
    """
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    letters = np.frombuffer("".join(found).encode("utf-32-le"), np.uint32).astype(np.uint64)
    first = np.r_[0, np.cumsum(sizes)]
    word = np.repeat(np.arange(len(sizes)), sizes + 1)
    place = np.arange(len(word)) - (first[:-1] + np.arange(len(sizes)))[word]
    begin, end = first[word], first[word + 1]
    at = begin + place
    out = []
    with np.errstate(over="ignore"):
        for base, a, b in ((_BASES[0], begin, at), (_BASES[1], at, end)):
            power, inverse = (np.full(len(letters) + 1, x, np.uint64) for x in (base, pow(base, -1, 1 << 64)))
            power[0] = inverse[0] = 1
            power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
            sums = np.r_[np.uint64(0), np.cumsum(mix(letters) * power[:-1], dtype=np.uint64)]
            out.append(mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64)).view(np.int64))
    return letters, first, out[0], out[1]


def _key_batches(batches):
    """A row for every place of a word, with its split and, unless it is the end, its skip."""
    for batch in batches:
        found = batch.column("word").to_pylist()
        if not found:
            continue
        letters, first, before, behind = node_numbers(found)
        sizes = np.diff(first)
        word = np.repeat(np.arange(len(sizes)), sizes + 1)
        place = np.arange(len(word)) - (first[:-1] + np.arange(len(sizes)))[word]
        ends = place == sizes[word]
        skip = np.where(ends, 0, np.r_[behind[1:], 0])
        at = np.minimum(first[word] + place, len(letters) - 1)
        lead = ~ends & ((place == 0) | (letters[at] != letters[at - 1]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id").take(pa.array(word)), pa.array(place, pa.int32()), pa.array(before), pa.array(behind),
             pa.array(skip, mask=ends), pa.array(lead)], ["id", "place", "prefix", "suffix", "skip", "lead"])


_KEYS = "id long, place int, prefix long, suffix long, skip long, lead boolean"


def near_pairs(words: DataFrame) -> DataFrame:
    """Both directions of every pair of words one letter apart: word, near word and their counts.

    ``words``: id, word (each once) and n.
    """
    keys = stage(words.select("id", "word").mapInArrow(_key_batches, _KEYS), "places")
    skips = keys.where("skip IS NOT NULL")
    a = skips.select("id", "place", "prefix", "skip")
    b = skips.select(F.col("id").alias("other"), "prefix", "skip")
    replaced = a.join(b, ["prefix", "skip"]).where("id <> other").select("id", "other", "place", F.lit(0).alias("deleted"))
    whole = keys.select(F.col("id").alias("other"), "prefix", F.col("suffix").alias("skip"))
    deleted = skips.where("lead").select("id", "place", "prefix", "skip").join(whole, ["prefix", "skip"]).select(
        "id", "other", "place", F.lit(1).alias("deleted"))
    pairs = replaced.unionByName(deleted)
    left, right = (words.select(F.col("id").alias(i), F.col("word").alias(w), F.col("n").alias(n)) for i, w, n in (("id", "word", "n"), ("other", "near", "near_n")))
    pairs = pairs.join(left, "id").join(right, "other")
    same = (F.expr("left(word, place) = left(near, place)")
            & F.expr("substring(word, place + 2) = substring(near, place + 2 - deleted)"))
    pairs = pairs.where(same)
    back = pairs.where("deleted = 1").select(
        F.col("other").alias("id"), F.col("id").alias("other"), F.col("near").alias("word"), F.col("word").alias("near"),
        F.col("near_n").alias("n"), F.col("n").alias("near_n"))
    return pairs.select("id", "other", "word", "near", "n", "near_n").unionByName(back)


def follow(forms: DataFrame) -> DataFrame:
    """id and root of every word that has a form: the last word that forms lead to.

    Counts at least double from form to form, so chains are short; each round joins
    every pointer to the pointer of its end and doubles what it spans.
    """
    ends = stage(forms.select("id", F.col("form_id").alias("root")), "ends")
    while True:
        on = ends.select(F.col("id").alias("root"), F.col("root").alias("further"))
        ends = stage(ends.join(on, "root", "left").select(
            "id", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "ends")
        if ends.where("moved").isEmpty():
            return ends.select("id", "root")
        ends = ends.drop("moved")


def spelling_groups(words: DataFrame) -> DataFrame:
    """Form, root and near words of each word of a vocabulary (id in code-point order, word, n).

    The form is the near word of the largest count, ties to the smallest word, if its count is
    at least ``RATIO`` times the word's. Without near words: null form, the word as root, 0
    near words. An empty vocabulary gives no rows. Words may be of any length.
    """
    pairs = near_pairs(words)
    best = pairs.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_near"), F.max(F.struct(F.col("near_n"), (-F.col("other")).alias("neg"), F.col("near"))).alias("best"))
    joined = words.join(best, "id", "left")
    has = F.col("best.near_n") >= RATIO * F.col("n")
    found = stage(joined.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(has, F.col("best.near")).alias("form"), F.when(has, F.col("best.near_n")).alias("form_n"),
        F.when(has, -F.col("best.neg")).alias("form_id")), "forms")
    roots = follow(found.where("form_id IS NOT NULL"))
    names = words.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    roots = roots.join(names, "root").select("id", F.col("root_word"))
    return found.join(roots, "id", "left").select(
        "word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


def document_words(docs: DataFrame, alter: bool = False) -> DataFrame:
    """``spelling_groups`` of the words of all texts.

    Words are runs of letters, A-Z lowered; ``alter`` deletes a letter where the contract
    says. A null or empty text has no words; a row without an id counts unaltered; repeated
    rows count each; other columns are ignored; whole texts are read, however long.
    """
    return spelling_groups(vocabulary(docs, alter))


def op13_spelling_groups(spark, sf_dir: str) -> DataFrame:
    return document_words(spark.read.parquet(f"{sf_dir}/documents.parquet"), alter=True)
