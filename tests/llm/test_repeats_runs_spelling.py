"""Passage removal, periodic runs and spelling variants against plain restatements, and odd inputs."""

import hashlib
import random
import re
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest

from barline.llm import graph_dedup, periodic_runs, spelling_groups

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = "doc_id long, text string, start int, found int, spans string, opens int, n long, word string, id int, anchor int"


def table(spark, texts, first=0):
    """Documents whose other columns have the operators' own names."""
    rows = [(None if t == "no id" else first + i, t, 1, 2, "s", 3, 4, "w", 5, 6) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, CLASHING)


def prose(rng, n, words=300):
    return [f"w{rng.randrange(words)}" for _ in range(n)]


# --- passages


def plain_removal(texts, window=50):
    first, split = {}, [SPACE.findall(t or "") for t in texts]
    for i, w in enumerate(split):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = []
    for i, w in enumerate(split):
        gone = set()
        for k in range(len(w) - window + 1):
            if first[tuple(w[k:k + window])] < i:
                gone.update(range(k, k + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def passages(seed):
    rng = random.Random(seed)
    shared = [prose(rng, n) for n in (30, 49, 50, 51, 60, 120, 400)]
    texts = []
    for _ in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            parts += rng.choice([prose(rng, rng.randrange(0, 90)), rng.choice(shared), rng.choice(shared)[rng.randrange(9):]])
        texts.append(parts)
    for _ in range(30):  # edited copies
        copy = list(rng.choice(texts))
        for _ in range(len(copy) // 90):
            copy[rng.randrange(len(copy))] = f"v{rng.randrange(99)}"
        texts.append(copy)
    texts += [["a"] * 200, ["a"] * 120, ["a", "b"] * 90, ["b", "a"] * 60, texts[3], texts[3]]
    rng.shuffle(texts)
    return [" ".join(t) for t in texts] + [None, "", " \n\t ", "one", "é ñ 漢字 \U0001f600 " * 30, "\x0b".join(["é", "ñ", "漢字", "\U0001f600"] * 30)]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("anchors", [graph_dedup.ANCHORS, (50,), (3, 50)])
def test_passages_equal_a_plain_removal(spark, seed, anchors):
    texts = passages(seed)
    got = graph_dedup.remove_repeats(table(spark, texts), anchors).collect()
    assert sorted(tuple(r)[:4] for r in got) == plain_removal(texts)
    assert sum(r.n_removed for r in got) > 1000
    split = [SPACE.findall(t or "") for t in texts]
    for r in got:  # every named passage is at its source, and they cover what is removed
        covered = set()
        for s in r.spans:
            assert s.source < r.doc_id
            assert split[r.doc_id][s.start:s.start + s.words] == split[s.source][s.source_start:s.source_start + s.words]
            covered.update(range(s.start, s.start + s.words))
        assert len(covered) == r.n_removed


def test_a_long_copy_is_one_passage(spark):
    rng = random.Random(5)
    body = prose(rng, 900, 10 ** 6)
    texts = [" ".join(body), " ".join(["x"] + body + ["y"])]
    got = {r.doc_id: r.spans for r in graph_dedup.remove_repeats(table(spark, texts)).collect()}
    assert got[0] == [] and [tuple(s) for s in got[1]] == [(1, 900, 0, 0)]


def test_passages_of_odd_rows(spark):
    rng = random.Random(2)
    a, b = " ".join(prose(rng, 80)), " ".join(prose(rng, 80))
    rows = [(7, a), (7, a), (7, b), (None, a), (None, b), (9, a + " " + b), (3, "x " + b), (8, None)]
    got = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in graph_dedup.remove_repeats(
        spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(-1, 80, 0), (-1, 80, 0), (3, 81, 0), (7, 80, 0), (7, 80, 0), (7, 80, 80), (8, 0, 0), (9, 160, 160)]
    assert graph_dedup.remove_repeats(table(spark, [])).count() == 0


def test_passages_of_a_very_long_text(spark):
    rng = random.Random(3)
    body = prose(rng, 300_000, 10 ** 5)
    texts = [" ".join(body), " ".join(body[100_000:100_070]), " ".join(body[:-1])]
    got = sorted(tuple(r)[:3] for r in graph_dedup.remove_repeats(table(spark, texts)).collect())
    assert got == [(0, 300_000, 0), (1, 70, 70), (2, 299_999, 299_999)]


# --- runs


def plain_runs(w):
    n, found = len(w), {}
    for p in range(1, n // 3 + 1):
        k = 0
        while k < n - p:
            if w[k] != w[k + p]:
                k += 1
                continue
            a = k
            while k < n - p and w[k] == w[k + p]:
                k += 1
            if k + p - a >= max(24, 3 * p):
                found.setdefault((a, k + p), p)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def periodic(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(25):
        w = []
        for _ in range(rng.randrange(1, 6)):
            unit = rng.choices("abc", k=rng.choice([1, 2, 3, 5, 8, 13, 40]))
            w += (unit * 30)[:rng.randrange(1, 200)]
            w += rng.choices("abcdefgh", k=rng.choice([0, 0, 1, 7, 60]))
        out.append(w)
    out += [rng.choices("ab", k=400) for _ in range(5)]
    return out


@pytest.mark.parametrize("chunk", [1 << 16, 97, 1])
def test_runs_equal_a_plain_search(chunk):
    lists = periodic(4) if chunk > 1 else periodic(4)[:6]
    offsets = np.r_[0, np.cumsum([len(w) for w in lists])]
    codes = np.array([ord(c) for w in lists for c in w], np.int64)
    doc, runs = periodic_runs.text_runs(offsets, codes, chunk)
    got = [sorted(tuple(r) for r in runs[doc == k].tolist()) for k in range(len(lists))]
    assert got == [plain_runs(w) for w in lists] and sum(map(len, got)) > 10


def plain_row(doc_id, text):
    w = SPACE.findall(text or "")
    n = len(w)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    runs.sort(key=lambda r: (r[0], r[2]))
    gone = {i for s, m, p in runs for i in range(s + p, s + m)}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    s, m, p = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (doc_id, len(runs), s, m, p, 1000 * m // p if runs else None, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_run_rows_equal_a_plain_restatement(spark, sf):
    texts = [" ".join(w) for w in periodic(9)] + [None, "", " \n ", "one", "tie " * 24, "é ñ\t" * 40, "no id"]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    frame = table(spark, texts)
    got = periodic_runs.periodic_runs(frame, plant=True).drop("runs", "collapsed").collect()
    want = [plain_row(r.doc_id, r.text) for r in frame.collect()]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(zlib.crc32(str(r[0]).encode()) % 10 == 0 and r[1] for r in want)


def test_runs_of_odd_rows(spark):
    assert periodic_runs.periodic_runs(table(spark, [])).count() == 0
    twice = spark.createDataFrame([(1, "a b " * 30), (1, "a b " * 30)], "doc_id long, text string")
    a, b = periodic_runs.periodic_runs(twice).collect()
    assert a == b and (a.start, a.length, a.period, a.collapsed) == (0, 60, 2, "a b")


def test_runs_of_very_long_texts_take_no_square_of_time():
    began = time.time()
    for codes in (np.zeros(1_000_000, np.int64), np.random.default_rng(0).integers(0, 10 ** 5, 1_000_000), np.arange(1_000_000) % 333_333):
        doc, runs = periodic_runs.text_runs(np.array([0, len(codes)]), codes.astype(np.int64))
        assert len(runs) == (0 if codes.max() == 99_999 else 1)
    assert time.time() - began < 60


# --- spelling


def plain_groups(rows):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            if doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 97 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] = counts.get(run, 0) + 1
    v = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    form, n_near = {}, {}
    for w in v:
        around = [x for x in v if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(around, key=lambda x: (-v[x], x), default=None)
        n_near[w], form[w] = len(around), best if best is not None and v[best] >= 2 * v[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), v[w], n_near[w], v.get(form[w])) for w in v)


def words_text(seed):
    rng = random.Random(seed)
    stems = ["".join(rng.choices("abcé", k=rng.randrange(4, 9))) for _ in range(25)] + ["aaaaaa", "aaaaaaa", "ÀÿÀÿÀ×", "ababab"]
    out = []
    for _ in range(60):
        line = []
        for _ in range(80):
            w = list(stems[min(int(rng.expovariate(0.15)), len(stems) - 1)])
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w[k:k + 1] = rng.choice([[], ["a"], ["b", w[k]], [w[k], w[k]]])
            line.append("".join(w).upper() if rng.random() < 0.1 else "".join(w))
        out.append(rng.choice([" ", "1", "\n", "漢"]).join(line))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_spelling_equals_a_plain_search(spark, seed):
    rows = list(enumerate(words_text(seed)))
    rows += [(None, rows[0][1]), (2000, None), (2001, ""), (2002, "x" * 50_000), (2003, "x" * 50_000), (2004, "x" * 50_000),
             (2005, ("x" * 49_999 + " ") * 7), (0, rows[0][1])]
    got = spelling_groups.document_words(spark.createDataFrame(rows, "doc_id long, text string"), alter=True).collect()
    want = plain_groups(rows)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert any(w[1] and w[2] != w[1] for w in want) and any(w[0].startswith("xxx") and w[4] for w in want)


def test_spelling_of_nothing(spark):
    assert spelling_groups.document_words(table(spark, []), alter=True).count() == 0
    assert spelling_groups.document_words(table(spark, [None, "", "no words of use"]), alter=True).count() == 0


def test_spelling_chains_end_at_their_root(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb", "bbbbc"]
    rows = [(2 * i, w, 3 * 2 ** i) for i, w in enumerate(chain)]
    got = {r.word: (r.form, r.root) for r in spelling_groups.spelling_groups(spark.createDataFrame(rows, "id long, word string, n long")).collect()}
    assert got == {w: (chain[i + 1] if i + 1 < len(chain) else None, chain[-1]) for i, w in enumerate(chain)}


def test_same_nodes_only_for_same_paths():
    rng = random.Random(0)
    found = sorted({"".join(rng.choices("ab", k=rng.randrange(1, 9))) for _ in range(300)})
    _, first, before, behind = spelling_groups.node_numbers(found)
    for nodes, part in ((before, lambda w, i: w[:i]), (behind, lambda w, i: w[i:])):
        paths = {}
        for k, w in enumerate(found):
            for i in range(len(w) + 1):
                paths.setdefault(int(nodes[first[k] + k + i]), set()).add(part(w, i))
        assert all(len(p) == 1 for p in paths.values()) and len(paths) == len(set.union(*paths.values()))
