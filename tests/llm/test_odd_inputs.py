"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from barline.llm import (block_labeller, graph_dedup, host_rules, jaccard_join, ngram_lm, packing, periodic_runs, pieces,
                         prefix_forest, secret_scan, spelling_groups, toxicity, url_filter)

#: Names that operators use for their own columns, inside and in their results.
CLASH = ["key", "shard", "size", "token", "part", "n", "word", "sid", "root", "host", "kept", "score", "n_words", "ids", "chunk",
         "start", "end", "perplexity", "spelling", "threshold", "copies", "gram", "place", "bucket", "blocks", "slot", "weight",
         "length", "period", "spans", "component_id", "rank", "vector", "canonical", "verdict", "rule", "bin", "piece", "n_tokens", "_n"]
LONG = " ".join(f"word{i * i % 997}" for i in range(60_000))
PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from here"
TEXTS = [None, "", " \n\t ", "one", PLAIN, PLAIN, "x" * 300_000, LONG, "é ñ ß 漢字 \U0001f600 \x00 ▁", PLAIN + " twice", "tie tie tie"]
ROWS = [(i, t, None if i == 3 else "en", None if i == 4 else f"s{i % 2}") for i, t in enumerate(TEXTS)]
ROWS += [ROWS[5], ROWS[7], (None, PLAIN, None, None), (None, None, None, None), (5, "another text of the same id", "fr", "s1")]
DOCS = "doc_id long, text string, lang string, source string"
LABELS = [(4, 1, 0), (5, 1, 1), (5, 1, 1), (7, 1, 0), (8, None, None), (None, 1, 1), (99, 0, 1)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def clashing(frame):
    extra = [c for c in CLASH if c not in frame.columns]
    return frame.select("*", *[F.lit(k).cast(("string", "int", "double")[k % 3]).alias(c) for k, c in enumerate(extra)])


#: Operators with one result row for every document.
BY_DOCUMENT = {
    "op2": lambda spark, docs: host_rules.quality_rules(docs),
    "op3": lambda spark, docs: ngram_lm.classify(docs, labels(spark)),
    "op5": lambda spark, docs: secret_scan.scan_secrets(docs),
    "op6": lambda spark, docs: jaccard_join.near_duplicates(docs),
    "op7": lambda spark, docs: toxicity.score_toxicity(docs, labels(spark)),
    "op8": lambda spark, docs: pieces.encode(docs),
    "op11": lambda spark, docs: graph_dedup.remove_repeats(docs),
    "op12": lambda spark, docs: periodic_runs.periodic_runs(docs, plant=True),
}


def counted(frame):
    return Counter(map(str, frame.collect()))


@pytest.mark.parametrize("name", sorted(BY_DOCUMENT))
def test_a_row_for_every_document(spark, name):
    run = BY_DOCUMENT[name]
    docs = spark.createDataFrame(ROWS, DOCS)
    got = run(spark, docs)
    rows = counted(got)
    assert Counter(r.doc_id for r in got.select("doc_id").collect()) == Counter(r[0] for r in ROWS)
    assert counted(run(spark, clashing(docs))) == rows  # other columns change nothing
    whole = [row for row, n in rows.items() if n > 1]
    assert len(whole) >= 2  # repeated rows come out alike


@pytest.mark.parametrize("name", sorted(BY_DOCUMENT))
def test_no_documents_give_no_rows(spark, name):
    got = BY_DOCUMENT[name](spark, clashing(spark.createDataFrame([], DOCS)))
    assert got.count() == 0 and "doc_id" in got.columns


@pytest.mark.parametrize("name", ["op3", "op7"])
def test_without_labels(spark, name):
    docs = spark.createDataFrame(ROWS, DOCS)
    none = labels(spark, [])
    got = (ngram_lm.classify(docs, none) if name == "op3" else toxicity.score_toxicity(docs, none)).collect()
    assert len(got) == len(ROWS)
    if name == "op3":
        by_row = Counter((r.doc_id, r.kept) for r in got)
        assert by_row[0, False] == by_row[1, False] == 1 and by_row[7, True] == 2 and by_row[4, True] == 1


def test_pages(spark):
    article = "<html><body><nav>menu</nav><article><p>" + PLAIN + ".</p></article></body></html>"
    rows = [(1, "http://a.org/x", article), (1, "http://a.org/x", article), (2, None, None), (None, "u", ""), (3, "u", "<"),
            (4, "u", "<p>" + LONG + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = block_labeller.extract_text(pages)
    assert Counter((r.page_id, r.url) for r in got.collect()) == Counter(r[:2] for r in rows)
    assert all(r.n_chars == len(r.text) for r in got.collect())
    assert counted(block_labeller.extract_text(clashing(pages.withColumn("text", F.lit("no"))))) == counted(got)
    assert block_labeller.extract_text(pages.limit(0)).count() == 0

    listed = spark.createDataFrame([("http://a.org/x",), (None,)], "canonical string")
    urls = [(1, "http://a.org/x"), (1, "http://a.org/x"), (None, "http://A.org/x"), (2, None), (3, ""), (4, "http://b.org/" + "y" * 200_000)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    judged = url_filter.judge_urls(pages, listed)
    assert Counter(r.page_id for r in judged.collect()) == Counter(r[0] for r in urls)
    assert counted(url_filter.judge_urls(clashing(pages), listed)) == counted(judged)
    assert url_filter.judge_urls(pages.limit(0), listed).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, listed.limit(0)).where("page_id = 1").collect()} == {"allow"}


def test_lengths(spark):
    rows = [(1, 700), (1, 700), (2, None), (3, 0), (None, 40), (4, 10_000), (5, 512), (6, 512)]
    items = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    got = packing.pack_lengths(items)
    assert sum(r.length for r in got.collect()) == sum(n or 0 for _, n in rows)
    assert counted(packing.pack_lengths(clashing(items))) == counted(got)
    assert counted(packing.pack_lengths(items.repartition(3, "n_tokens"))) == counted(got)
    assert packing.pack_lengths(items.limit(0)).count() == 0


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [0.5, 0.5]), (None, [1.0, 1.0]), (60, None), (80, []),
            (100, [0.0, 0.0]), (2, [1.0, None]), (3, [float("inf"), 1.0]), (120, [2.0, 1.0, 0.0]), (4, [1.0, 1.0, 1.0])]

    def run(frame):
        table = prefix_forest.usable(frame)
        return prefix_forest.nearest(table, table.where("vec_id % 20 = 0"))

    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    want = {(20, 1, 1, 1.0), (20, 2, 40, 0.5), (40, 1, 1, 0.5), (40, 2, 20, 0.5), (120, 1, 4, 3.0)}
    assert {tuple(r) for r in run(frame).collect()} == {tuple(r) for r in run(clashing(frame)).collect()} == want
    assert run(frame.limit(0)).count() == 0


def test_words(spark):
    rows = [(i, "colour colour colours", "en", "s") for i in range(4)] + [(None, "colours", None, None), (5, None, "en", "s"), (6, "", "en", "s"),
            (7, "q" * 100_000 + " 12 !", "en", "s")]
    docs = spark.createDataFrame(rows, DOCS)
    got = spelling_groups.document_words(docs)
    assert {(r.word, r.form, r.n, r.n_near) for r in got.collect()} == {("colour", None, 8, 1), ("colours", None, 5, 1)}
    assert counted(spelling_groups.document_words(clashing(docs))) == counted(got)
    assert spelling_groups.document_words(docs.limit(0)).count() == 0
