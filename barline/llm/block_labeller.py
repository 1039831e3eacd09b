"""Main text of web pages by a recurrent block labeller.

A page becomes the sequence of its leaf blocks. Each has a vector: hashed tags,
class and id words of its path, hashed words of its text, and a few measures. A
bidirectional LSTM reads the whole sequence and labels every block main text or
not, so that a block's neighbours near and far take part. Weights are fitted on a
bounded sample of pages: their own blocks where landmarks such as ``article`` tell
what is main text, and layouts drawn at random from their texts, which teach other
landmarks. Pages are labelled where they are read; nothing shuffles.
"""

from __future__ import annotations

import html
import pickle
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tokens import slices

#: Pages that the fit reads whole, first by a hash of the page, and the longest run of blocks it takes from one.
FIT_PAGES, FIT_BLOCKS = 240, 2_000
#: Random layouts per page of the sample.
LAYOUTS = 5
EPOCHS, BATCH, RATE = 8, 48, 0.01
PATH_DIM, WORD_DIM, MEASURES, HIDDEN = 96, 24, 6, 16
DIM = PATH_DIM + WORD_DIM + MEASURES

_OPEN = re.compile(r"<[a-zA-Z/!?]")
_NAME = re.compile(r"[^\s/>]*+")
_GAP = re.compile(r"[\s/]*+")
_ATTRIBUTE = re.compile(r"(=?[^\s/>=]*+)\s*+(=\s*+)?+")
_UNQUOTED = re.compile(r"[^\s>]*+")
#: Attributes whose words belong to a block's path.
_NAMED = ("class", "id", "role")
_DIGIT = re.compile(r"\d")
_HIDDEN = ("script", "style", "head", "template", "noscript", "svg", "iframe", "object", "title")
#: What may stand in a head; any other element, or text, ends an open one.
_IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "title", "textarea", "iframe", "noscript")}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub "
    "sup time tt u var".split())
#: A start tag that ends an open element of the same group.
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
           "th": {"td", "th"}, "option": {"option"}}
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())


class _Tags:
    """The tags of a page in order, by the rules of HTML for names, quotes and comments.

    Every character is passed once: what is not closed is never looked for twice. A tag, comment
    or declaration that the page's end cuts off drops the rest. A quote that is never closed
    ends at the tag's ``>``, so that one slip does not take the rest of the page.
    """

    def __init__(self, page: str):
        self.page, self.at, self.open_quotes = page, 0, set()

    def next(self) -> tuple[str, str, bool, list[tuple[str, str]], bool] | None:
        """Text up to the next tag, then its name (empty for a comment, or at the end), whether it
        closes, its attributes and whether it closes itself. None after the end."""
        page, n = self.page, len(self.page)
        if self.at >= n:
            return None
        m = _OPEN.search(page, self.at)
        if m is None:
            text, self.at = page[self.at:], n
            return text, "", False, [], False
        text, at = page[self.at:m.start()], m.end() - 1
        closing = page[at] == "/"
        if closing:
            at += 1
        if not page[at:at + 1].isascii() or not page[at:at + 1].isalpha():
            mark = "-->" if page.startswith("!--", at) else ">"
            stop = page.find(mark, at + (1 if mark == "-->" else 0))
            self.at = stop + len(mark) if stop >= 0 else n
            return text, "", False, [], False
        m = _NAME.match(page, at)
        name, at, found = m[0].lower(), m.end(), []
        while True:
            at = _GAP.match(page, at).end()
            if at >= n:
                self.at = n
                return text, "", False, [], False
            if page[at] == ">":
                self.at = at + 1
                return text, name, closing, found, page[at - 1] == "/"
            m = _ATTRIBUTE.match(page, at)
            at, value = m.end(), ""
            if m[2] and at < n and page[at] in "\"'":
                quote = page[at]
                stop = -1 if quote in self.open_quotes else page.find(quote, at + 1)
                if stop < 0:
                    self.open_quotes.add(quote)
                    stop = page.find(">", at)
                    self.at = stop + 1 if stop >= 0 else n
                    return (text, name, closing, found, False) if stop >= 0 else (text, "", False, [], False)
                value, at = page[at + 1:stop], stop + 1
            elif m[2]:
                u = _UNQUOTED.match(page, at)
                value, at = u[0], u.end()
            found.append((m[1].lower(), value))


def blocks(page: str) -> list[tuple[str, tuple[str, ...], float]]:
    """(text, words of the path, share of characters in links) of each leaf block that has text."""
    out: list[tuple[str, tuple[str, ...], float]] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    linked, hidden, in_link = 0, 0, 0

    def flush():
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                path = tuple(w for _, words in stack for w in words)
                out.append((text, path, min(1.0, linked / len(text))))
            parts.clear()
        linked = 0

    def close(to: int):
        nonlocal hidden, in_link
        while len(stack) > to:
            if stack[-1][0] not in _INLINE:
                flush()
            tag, _ = stack.pop()
            hidden -= tag in _HIDDEN
            in_link -= tag == "a"

    def say(text: str):
        nonlocal linked
        if text and not hidden:
            parts.append(html.unescape(text) if "&" in text else text)
            linked += len(text) if in_link else 0

    tags = _Tags(page)
    while (token := tags.next()) is not None:
        between, tag, closing, attributes, closed = token
        if stack and stack[-1][0] == "head":
            if between.strip():
                close(len(stack) - 1)
            say(between)
            if stack[-1:] and stack[-1][0] == "head" and tag and not closing and tag not in _IN_HEAD:
                close(len(stack) - 1)
        else:
            say(between)
        if not tag:
            continue
        if closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    close(i)
                    break
            else:
                if tag not in _INLINE:
                    flush()
            continue
        if tag in _VOID:
            if tag == "br" or tag not in _INLINE:
                say(" ") if tag in ("br", "img", "input", "wbr") else flush()
            continue
        if tag not in _INLINE:
            shut = _CLOSES.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in shut:
                    close(i)
                    break
                if stack[i][0] in ("ul", "ol", "table", "dl", "article", "main", "section", "div", "body", "aside", "nav") and stack[i][0] not in shut:
                    break
            flush()
        if tag == "svg" and closed:
            continue
        words = [tag]
        for name, value in attributes:
            if name in _NAMED:
                words += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
        stack.append((tag, tuple(words)))
        hidden += tag in _HIDDEN
        in_link += tag == "a"
        if tag in _RAW and not closed:
            stop = _RAW[tag].search(page, tags.at)
            tags.at = stop.start() if stop else len(page)
    close(0)
    flush()
    return out


def _slot(word: str, dim: int, seed: int) -> tuple[int, float]:
    h = zlib.crc32(word.encode(), seed)
    return h % dim, 1.0 if h & 0x10000 else -1.0


class _WordSlots(dict):
    """Slot of each word; those of negative sign come after all others."""

    def __missing__(self, w):
        if len(self) > 200_000:
            self.clear()
        i, sign = _slot(w, WORD_DIM, 3)
        self[w] = i if sign > 0 else WORD_DIM + i
        return self[w]


class Encoder:
    """Vectors of blocks; hashes of words seen before are remembered."""

    def __init__(self):
        self._path: dict = {}
        self._word = _WordSlots()

    def _path_vector(self, path):
        if path not in self._path:
            v = np.zeros(PATH_DIM, np.float32)
            for w in set(path):
                for seed in (1, 2):
                    i, sign = _slot(w, PATH_DIM, seed)
                    v[i] += sign
            if len(self._path) > 50_000:
                self._path.clear()
            self._path[path] = v
        return self._path[path]

    def __call__(self, page_blocks) -> np.ndarray:
        x = np.zeros((len(page_blocks), DIM), np.float32)
        for i, (text, path, links) in enumerate(page_blocks):
            x[i, :PATH_DIM] = self._path_vector(path)
            words = text.lower().split()
            n = np.bincount(np.fromiter(map(self._word.__getitem__, words), np.int64, len(words)), minlength=2 * WORD_DIM)
            # All words count; a long block weighs as much as one of 24 words.
            x[i, PATH_DIM:PATH_DIM + WORD_DIM] = (n[:WORD_DIM] - n[WORD_DIM:]) * (min(1.0, 24 / max(1, len(words))) / 8)
            x[i, PATH_DIM + WORD_DIM:] = (
                min(np.log1p(len(text)) / 6, 2), links, text[-1] in ".!?:;", min(len(words), 24) / 24,
                (i + 1) / len(page_blocks), _DIGIT.search(text) is not None)
        return x


def init(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {}
    for d in ("f", "b"):
        w[f"wx{d}"] = (rng.standard_normal((DIM, 4 * HIDDEN)) * 0.15).astype(np.float32)
        w[f"wh{d}"] = (rng.standard_normal((HIDDEN, 4 * HIDDEN)) * 0.2).astype(np.float32)
        bias = np.zeros(4 * HIDDEN, np.float32)
        bias[HIDDEN:2 * HIDDEN] = 1.0  # remember by default
        w[f"bias{d}"] = bias
    w["out"] = (rng.standard_normal(2 * HIDDEN) * 0.2).astype(np.float32)
    w["direct"] = np.zeros(DIM, np.float32)
    w["bias"] = np.zeros(1, np.float32)
    return w


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _run(x, mask, wx, wh, bias):
    """Hidden states (steps, pages, HIDDEN) of one direction, and what the way back needs."""
    steps, pages, _ = x.shape
    h = c = np.zeros((pages, HIDDEN), np.float32)
    into = (x.reshape(-1, DIM) @ wx + bias).reshape(steps, pages, -1)
    hs, kept = np.zeros((steps, pages, HIDDEN), np.float32), []
    for t in range(steps):
        z = into[t] + h @ wh
        i, f, o = (_sigmoid(z[:, k * HIDDEN:(k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        m = mask[t][:, None]
        c_new = f * c + i * g
        tc = np.tanh(c_new)
        kept.append((h, c, i, f, o, g, tc))
        h, c = np.where(m, o * tc, h), np.where(m, c_new, c)
        hs[t] = h
    return hs, kept


def _back(x, mask, wh, kept, dhs):
    """Gradients of one direction's weights from those of its states."""
    steps, pages, _ = x.shape
    dwh, dz_all = np.zeros_like(wh), np.zeros((steps, pages, 4 * HIDDEN), np.float32)
    dh = dc = np.zeros((pages, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        h, c, i, f, o, g, tc = kept[t]
        m = mask[t][:, None]
        dh = dh + dhs[t]
        now, dcn = dh * m, dc * m + dh * m * o * (1 - tc * tc)
        dz = np.concatenate([dcn * g * i * (1 - i), dcn * c * f * (1 - f), now * tc * o * (1 - o), dcn * i * (1 - g * g)], 1)
        dz_all[t] = dz
        dwh += h.T @ dz
        dh, dc = np.where(m, dz @ wh.T, dh), np.where(m, dcn * f, dc)
    flat = dz_all.reshape(-1, 4 * HIDDEN)
    return x.reshape(-1, DIM).T @ flat, dwh, flat.sum(0)


def _pad(seqs):
    steps = max(len(s) for s in seqs)
    x = np.zeros((steps, len(seqs), DIM), np.float32)
    mask = np.zeros((steps, len(seqs)), bool)
    for k, s in enumerate(seqs):
        x[:len(s), k], mask[:len(s), k] = s, True
    return x, mask


def scores(w, seqs: list[np.ndarray]) -> list[np.ndarray]:
    """Log odds of main text for the blocks of each sequence."""
    if not seqs:
        return []
    x, mask = _pad(seqs)
    hf, _ = _run(x, mask, w["wxf"], w["whf"], w["biasf"])
    hb, _ = _run(x[::-1], mask[::-1], w["wxb"], w["whb"], w["biasb"])
    z = np.concatenate([hf, hb[::-1]], 2) @ w["out"] + x @ w["direct"] + w["bias"]
    return [z[:len(s), k] for k, s in enumerate(seqs)]


def fit(seqs: list[np.ndarray], labels: list[np.ndarray], seed: int = 5) -> dict[str, np.ndarray]:
    """Adam on the cross entropy of all blocks, through time in both directions."""
    w, rng = init(seed), np.random.default_rng(seed)
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(seqs))
        order = order[np.argsort([len(seqs[i]) // 8 for i in order], kind="stable")]
        batches = [order[a:a + BATCH] for a in range(0, len(order), BATCH)]
        for b in rng.permutation(len(batches)):
            x, mask = _pad([seqs[i] for i in batches[b]])
            y = np.zeros(mask.shape, np.float32)
            for k, i in enumerate(batches[b]):
                y[:len(labels[i]), k] = labels[i]
            xr, mr = x[::-1], mask[::-1]
            hf, kf = _run(x, mask, w["wxf"], w["whf"], w["biasf"])
            hb, kb = _run(xr, mr, w["wxb"], w["whb"], w["biasb"])
            states = np.concatenate([hf, hb[::-1]], 2)
            dz = (_sigmoid(states @ w["out"] + x @ w["direct"] + w["bias"]) - y) * mask / mask.sum()
            ds = dz[:, :, None] * w["out"]
            g = {"out": np.einsum("tp,tph->h", dz, states), "direct": np.einsum("tp,tpd->d", dz, x), "bias": np.array([dz.sum()])}
            g["wxf"], g["whf"], g["biasf"] = _back(x, mask, w["whf"], kf, ds[:, :, :HIDDEN])
            g["wxb"], g["whb"], g["biasb"] = _back(xr, mr, w["whb"], kb, ds[::-1, :, HIDDEN:])
            step += 1
            for k in w:
                m1[k] = 0.9 * m1[k] + 0.1 * g[k]
                m2[k] = 0.99 * m2[k] + 0.01 * g[k] ** 2
                w[k] = (w[k] - RATE * (m1[k] / (1 - 0.9 ** step)) / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return w


#: Path words of what is no main text, and containers of main text: the layouts are drawn from them.
ASIDE = ("nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "fieldset")
ASIDE_WORDS = (
    "ad ads advert advertisement sponsor sponsored promo promotion banner menu navigation navbar breadcrumb breadcrumbs sidebar "
    "widget related recommended recommendations share social newsletter subscribe signup login search cookie cookies consent notice "
    "alert popup modal comment comments reply replies disqus discussion copyright footer header masthead topbar toolbar pagination "
    "pager tags taglist skip legal disclaimer trending teaser").split()
MAIN_WORDS = ("content", "post", "entry", "article", "story", "body", "text", "main", "page", "prose")


def weak_labels(found) -> np.ndarray | None:
    """1 for blocks in ``article`` or ``main`` outside all others' landmarks; None if the page has neither."""
    if not any("article" in p or "main" in p for _, p, _ in found):
        return None
    return np.array([("article" in p or "main" in p) and not (set(p) & {*ASIDE, *ASIDE_WORDS}) for _, p, _ in found], np.float32)


def random_layout(texts: list[str], rng: np.random.Generator) -> tuple[str, list[int]]:
    """A page of the given texts in a layout drawn at random, and the label of each block in order."""
    words = " ".join(texts).split() or ["text"]
    out, labels = ["<html><head><title>", html.escape(texts[0][:60]), "</title></head><body>"], []

    def pick(options):
        return options[int(rng.integers(len(options)))]

    def phrase(longest):
        a = int(rng.integers(len(words)))
        return html.escape(" ".join(words[a:a + 1 + int(rng.integers(longest))]))

    def noise():
        kind = int(rng.integers(6))
        word = pick(ASIDE_WORDS)
        attr = pick((f' class="{word}"', f' id="{word}"', f' class="{pick(("site", "page", "top", "box"))}-{word}"', f' class="{word} {pick(MAIN_WORDS)}"'))
        tag = pick(ASIDE) if rng.random() < 0.5 else ""
        open_, shut = (f"<{tag}>", f"</{tag}>") if tag else (f"<{pick(('div', 'section'))}{attr}>", "")
        shut = shut or f"</{open_[1:].split(' ')[0]}>"
        if kind == 0:
            n = 2 + int(rng.integers(5))
            inner = "<ul>" + "".join(f'<li><a href="/x">{phrase(3)}</a></li>' for _ in range(n)) + "</ul>"
        elif kind == 1:
            n, inner = 1, phrase(25) + pick((".", ""))
        elif kind == 2:
            n = 1 + int(rng.integers(3))
            inner = "".join(f"<div class=\"{pick(('item', 'box', 'comment', 'row'))}\"><p>{phrase(30)}.</p></div>" for _ in range(n))
        elif kind == 3:
            n, inner = 1, f"<p>{html.escape(pick(texts))}</p>"
        elif kind == 4:
            n, inner = 2, f"<h3>{phrase(4)}</h3><p>{phrase(20)}</p>"
        else:
            n, inner = 1, f"<p>&copy; {phrase(6)}</p>"
        labels.extend([0] * n)
        out.append(open_ + inner + shut)

    def main():
        style = int(rng.integers(5))
        if style == 0:
            open_, shut = "<article>", "</article>"
        elif style == 1:
            open_, shut = "<main>", "</main>"
        elif style == 2:
            open_, shut = pick(('<main><article class="post">', '<main id="content"><article>')), "</article></main>"
        else:
            word = pick(MAIN_WORDS)
            open_, shut = pick((f'<div class="{word}">', f'<div id="{word}">', f'<section class="{pick(MAIN_WORDS)}-{word}">')), ""
            shut = "</section>" if open_.startswith("<section") else "</div>"
        out.append(open_)
        if rng.random() < 0.7:
            out.append(f"<h1>{phrase(9)}</h1>")
            labels.append(1)
        for t in texts:
            tag = pick(("p", "p", "p", "p", "h2", "blockquote", "li", "pre", "div"))
            t = html.escape(t if tag != "h2" else t[:40])
            out.append(f"<ul><li>{t}</li></ul>" if tag == "li" else f"<{tag}>{t}</{tag}>")
            labels.append(1)
            if rng.random() < 0.08:
                noise()
        if rng.random() < 0.3:
            noise()
        out.append(shut)

    for _ in range(int(rng.integers(4))):
        noise()
    main()
    for _ in range(int(rng.integers(4))):
        noise()
    return "".join(out) + "</body></html>", labels


def training_data(pages: list[str], seed: int = 5):
    """Vectors and labels of the pages' own blocks and of layouts drawn from their texts."""
    rng, encode, seqs, labels = np.random.default_rng(seed), Encoder(), [], []
    for page in pages:
        found = blocks(page)
        if not found:
            continue
        own = weak_labels(found)
        if own is not None:
            a = int(rng.integers(max(1, len(found) - FIT_BLOCKS + 1)))
            seqs.append(encode(found)[a:a + FIT_BLOCKS])
            labels.append(own[a:a + FIT_BLOCKS])
        for _ in range(LAYOUTS):
            chosen = rng.choice(len(found), size=min(len(found), 1 + int(rng.integers(8))), replace=False)
            made, marks = random_layout([found[i][0] for i in np.sort(chosen)], rng)
            again = blocks(made)
            if len(again) == len(marks):
                seqs.append(encode(again))
                labels.append(np.array(marks, np.float32))
    return seqs, labels


def _fit_batches(batches):
    pages = sorted(p for b in batches for p in b.column("html").to_pylist())
    seqs, labels = training_data(pages)
    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(seqs, labels))], pa.binary())], ["weights"])


def train(pages: DataFrame) -> dict[str, np.ndarray]:
    """Weights from at most ``FIT_PAGES`` whole pages; without any page, those that a fit starts from."""
    sample = (
        pages.where(F.length("html") > 0).select("html")
        .orderBy(F.xxhash64("html"), "html").limit(FIT_PAGES)
    )
    got = sample.repartition(1).mapInArrow(_fit_batches, "weights binary").collect()
    return pickle.loads(got[0]["weights"]) if got else init()


def main_texts(pages: list[str | None], w, encode: Encoder) -> list[str]:
    found = [blocks(p) if p else [] for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if found[i]), key=lambda i: len(found[i]))
    a = 0
    while a < len(order):  # pages of like length together, so that padding is small
        b = a + max(1, min(256, 40_000 // len(found[order[min(a + 255, len(order) - 1)]])))
        part = order[a:b]
        for i, z in zip(part, scores(w, [encode(found[i]) for i in part])):
            out[i] = " ".join(t for (t, _, _), s in zip(found[i], z) if s > 0)
        a = b
    return out


def _extract_batches(weights):
    def run(batches):
        w, encode = weights.value, Encoder()
        for batch in batches:
            for part in slices(batch, "html", 2_000_000):
                got = main_texts(part.column("html").to_pylist(), w, encode)
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(got, pa.string()),
                     pa.array([len(t) for t in got], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of each row.

    A null or empty page, or one without a main block, has the empty text. Repeated rows,
    null ids and null urls stay; a table without rows gives none; extra columns are ignored.
    Pages are read whole, however long or malformed, in time linear in their length.
    """
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"))
    id_type = rows.schema["page_id"].dataType.simpleString()
    weights = pages.sparkSession.sparkContext.broadcast(train(rows))
    rows = rows.withColumn("url", F.col("url").cast("string"))
    return rows.mapInArrow(_extract_batches(weights), f"page_id {id_type}, url string, text string, n_chars long")


def op1_block_labeller(spark, sf_dir: str) -> DataFrame:
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
