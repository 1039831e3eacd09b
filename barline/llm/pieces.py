"""SentencePiece encoding by the model's merge order, and decoding.

The model merges the neighbours whose joined piece has the greatest score, the
leftmost of equal ones, until no two neighbours make a piece; characters without a
piece become bytes. No merge joins two characters that stand side by side in no
piece. Between such two a text can be cut without any effect on its ids: before
word marks always, and often within long runs without blanks.

Each different word is merged once per batch, many words in step, one merge of each
at a time. What stays long after cutting is merged with a heap.

Giant documents are cut every ``CHUNK`` characters, wherever that falls, and encoded by a
max-plus scan. Pieces in a row are the model's encoding of their text exactly if every two
neighbours encode, by themselves, to those two. So an encoding is a path through pieces whose
steps weigh 0 if the neighbours agree and -inf if not, and one path alone weighs 0. The state
at a cut is the piece that reaches or crosses it; a chunk gives the matrix of path weights from
the states of its first cut to those of its last. Matrices combine associatively to the one
state of every cut, and each chunk then walks its own stretch of the path by itself.
"""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tokens import mix, slices
from barline.session import stage

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters from which a document is cut, and of a chunk.
GIANT, CHUNK = 65_536, 16_384
#: Longer words are cut where that is safe, and else merged with a heap.
WORD = 40
#: Words that are merged in step.
STEP = 16_384
MARK = "▁"
NONE = -np.inf
_UNIT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_SLOT_BITS = 20


class Vocabulary:
    """Pieces with scores, byte pieces, and the pairs of symbols that merge into a piece."""

    def __init__(self, pieces: list[str], scores: list[float], kinds: list[str]):
        self.pieces, self.kinds = pieces, kinds
        self.ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "piece"}
        self.scores = np.array(scores, np.float64)
        self.bytes = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == "byte"}
        self.unknown = kinds.index("unknown") if "unknown" in kinds else -1
        self.longest = max(map(len, self.ids), default=1)
        if any(MARK in p.lstrip(MARK) for p in self.ids):
            raise ValueError("a piece crosses the start of a word")
        # Below any real score, so that bytes are used only where no piece covers.
        self.fallback = float(self.scores.min(initial=0.0)) - 10.0
        # Characters that only occur within pieces are symbols too, numbered after the pieces.
        inner = sorted({c for p in self.ids for c in p} - self.ids.keys())
        symbols = self.ids | {c: len(pieces) + i for i, c in enumerate(inner)}
        self.symbol = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.symbol[ord(s)] = i
        #: Order of the pieces' scores; the last entry is for -1, no piece.
        self.rank = np.append(np.unique(self.scores, return_inverse=True)[1], -1).astype(np.int32)
        self.pairs = {symbols[p[:k]] << 32 | symbols[p[k:]]: i for p, i in self.ids.items() for k in range(1, len(p))
                      if p[:k] in symbols and p[k:] in symbols}
        self.together = {p[k:k + 2] for p in self.ids for k in range(len(p) - 1)}
        self._slots = _SLOT_BITS + max(0, len(self.pairs).bit_length() - _SLOT_BITS + 1)
        self._keys, self._of = np.full(1 << self._slots, -1, np.int64), np.full(1 << self._slots, -1, np.int32)
        keys, of = np.array(list(self.pairs), np.int64), np.array(list(self.pairs.values()), np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self._keys[slot] < 0
            self._keys[slot[free]] = keys[free]
            put = self._keys[slot] == keys
            self._of[slot[put]] = of[put]
            keys, of, slot = keys[~put], of[~put], (slot[~put] + 1) & ((1 << self._slots) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - self._slots)).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each two symbols make, or -1."""
        out = np.full(len(left), -1, np.int32)
        at = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[at].astype(np.int64) << 32 | right[at]
        slot = self._slot(keys)
        while len(at):
            found = self._keys[slot]
            hit = found == keys
            out[at[hit]] = self._of[slot[hit]]
            on = ~hit & (found >= 0)
            at, keys, slot = at[on], keys[on], (slot[on] + 1) & ((1 << self._slots) - 1)
        return out

    def safe_cut(self, text: str, at: int) -> int:
        """The first position from ``at`` on, or the end, that no piece crosses."""
        while 0 < at < len(text) and text[at - 1:at + 1] in self.together:
            at += 1
        return at

    def byte_ids(self, char: str) -> list[int]:
        return [self.bytes.get(b, self.unknown) for b in char.encode("utf-8", "replace")]


def load(path: str = MODEL) -> Vocabulary:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    if any(model.is_unused(i) for i in range(n)):
        raise ValueError("merges through unused pieces are not supported")
    kinds = ["unknown" if model.is_unknown(i) else "byte" if model.is_byte(i) else
             "control" if model.is_control(i) else "piece" for i in range(n)]
    return Vocabulary([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], kinds)


def marked(text: str) -> str:
    """The text as pieces see it: blanks become word marks, and one goes before the text."""
    return MARK + text.replace(" ", MARK) if text else ""


class Neighbours:
    """Which pieces can stand side by side; answers are remembered, up to a bound."""

    def __init__(self, v: Vocabulary, remember: int = 400_000):
        self.v, self.remember, self.known = v, remember, {}

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text."""
        v, parts = self.v, list(text)
        while len(parts) > 1:
            ids = [v.ids.get(a + b, -1) for a, b in zip(parts, parts[1:])]
            at = int(v.rank[ids].argmax())  # the leftmost of equal ones
            if ids[at] < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, left: str, right: str) -> bool:
        """Whether the two encode to themselves; with an empty ``left``, whether ``right`` does."""
        got = self.known.get((left, right))
        if got is None:
            if len(self.known) >= self.remember:
                self.known = {}
            got = self.known[left, right] = self.merged(left + right) == ([left, right] if left else [right])
        return got

    def pieces(self, text: str, start: int):
        """Ends of the pieces, or the single character, that ``text`` has from ``start`` on."""
        for end in range(start + 1, min(start + self.v.longest, len(text)) + 1):
            if (end == start + 1 or text[start:end] in self.v.ids) and self.agree("", text[start:end]):
                yield end

    def states(self, text: str, cut: int) -> list[tuple[int, int]]:
        """Spans of the pieces that begin before ``cut`` and reach or cross it; at an end of the text, the cut itself."""
        if cut <= 0 or cut >= len(text):
            return [(cut, cut)]
        return [(s, e) for s in range(max(0, cut - self.v.longest), cut) for e in self.pieces(text, s) if e >= cut]

    def reach(self, text: str, states: list[tuple[int, int]], end: int) -> dict[tuple[int, int], int]:
        """Spans of the pieces that reach or cross ``end``, each with the set (bits) of ``states`` that paths to it begin with."""
        at: dict[int, dict[int, int]] = {}
        for k, (s, e) in enumerate(states):
            at.setdefault(e, {})[s] = at.get(e, {}).get(s, 0) | 1 << k
        for here in range(min((e for _, e in states), default=end), end):
            before = at.pop(here, None)
            for e in self.pieces(text, here) if before else ():
                origins = 0
                for s, bits in before.items():
                    if self.agree(text[s:here], text[here:e]):
                        origins |= bits
                if origins:
                    at.setdefault(e, {})[here] = origins
        return {(s, e): bits for e, spans in at.items() if e >= end for s, bits in spans.items()}

    def transfer(self, text: str, start: int, end: int) -> np.ndarray:
        """Path weights (0 or -inf) from the states of the cut at ``start`` to those of the cut at ``end``.

        ``text`` has at least ``longest`` characters before and after, unless it begins or ends there.
        Where no piece crosses a place in between, all paths meet, and the matrix is a sum of two vectors.
        """
        first, last = self.states(text, start), self.states(text, end)
        meet = self.v.safe_cut(text, start)
        if meet >= end:
            return self._weights(self.reach(text, first, end), len(first), last)
        again = end - 1
        while again > meet and text[again - 1:again + 1] in self.v.together:
            again -= 1
        left = self._weights(self.reach(text, first, meet), len(first), [(meet, meet)])
        return left + self._weights(self.reach(text, [(again, again)], end), 1, last)

    @staticmethod
    def _weights(found: dict[tuple[int, int], int], n: int, last: list[tuple[int, int]]) -> np.ndarray:
        out, column = np.full((n, len(last)), NONE), {span: j for j, span in enumerate(last)}
        for span, bits in found.items():
            j = column[span] if last[0][0] < last[0][1] else 0  # a place where all paths meet is one state
            out[[k for k in range(n) if bits >> k & 1], j] = 0.0
        return out


def merge_words(v: Vocabulary, words: list[str]) -> list[bytes]:
    """The int32 ids of short words; all words advance together, one merge of each at a time."""
    n, lengths = len(words), np.array([len(w) for w in words])
    wide = int(lengths.max(initial=0)) + 1  # the last column ends every row
    codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    alive = np.arange(wide) < lengths[:, None]
    symbol = np.full((n, wide), -1, np.int32)
    symbol[alive] = v.symbol[codes]
    code = np.zeros((n, wide), np.uint32)
    code[alive] = codes
    after = np.tile(np.minimum(np.arange(wide) + 1, wide - 1), (n, 1))
    before = np.tile(np.arange(wide) - 1, (n, 1))
    piece = np.full((n, wide), -1, np.int32)
    piece[:, :-1] = v.merged(symbol[:, :-1].ravel(), symbol[:, 1:].ravel()).reshape(n, -1)
    rank = v.rank[piece]
    rows = np.arange(n)
    while True:
        part = rank[rows]
        at = part.argmax(axis=1)  # the leftmost of equal ones
        on = part[np.arange(len(rows)), at] >= 0
        rows, at = rows[on], at[on]
        if not len(rows):
            break
        gone, made = after[rows, at], piece[rows, at]
        then = after[rows, gone]
        symbol[rows, at], alive[rows, gone], rank[rows, gone] = made, False, -1
        after[rows, at], before[rows, then] = then, at
        piece[rows, at] = v.merged(made, symbol[rows, then])
        rank[rows, at] = v.rank[piece[rows, at]]
        has = before[rows, at] >= 0
        r, a = rows[has], before[rows, at][has]
        piece[r, a] = v.merged(symbol[r, a], made[has])
        rank[r, a] = v.rank[piece[r, a]]
    flat, ends = symbol[alive], np.cumsum(alive.sum(axis=1))
    raw, starts = flat.tobytes(), ends - alive.sum(axis=1)
    out = [raw[4 * a:4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
    bare = alive & ((symbol < 0) | (symbol >= len(v.pieces)))
    for i in np.flatnonzero(bare.any(axis=1)).tolist():
        out[i] = _with_bytes(v, symbol[i][alive[i]].tolist(), [chr(c) for c in code[i][alive[i]].tolist()])
    return out


def _with_bytes(v: Vocabulary, symbols: list[int], chars: list[str]) -> bytes:
    """The ids of symbols; those that are no piece are single characters."""
    ids = [x for s, c in zip(symbols, chars) for x in ([s] if 0 <= s < len(v.pieces) else v.byte_ids(c))]
    return np.array(ids, np.int32).tobytes()


def merge_long(v: Vocabulary, text: str) -> bytes:
    """The int32 ids of a text of any length, by a heap of the pairs that can merge."""
    first = v.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    piece = v.merged(first[:-1], first[1:])
    at = np.flatnonzero(piece >= 0)
    symbol, rank, pairs = [*first.tolist(), -1], v.rank.tolist(), v.pairs
    heap = list(zip((-v.rank[piece[at]]).tolist(), at.tolist(), first[at].tolist(), first[at + 1].tolist(), piece[at].tolist()))
    heapq.heapify(heap)
    n = len(first)
    after, before, alive = list(range(1, n + 2)), list(range(-1, n)), [True] * n
    while heap:
        _, i, left, right, made = heapq.heappop(heap)
        j = after[i]
        if not alive[i] or symbol[i] != left or symbol[j] != right:
            continue  # one of the two has merged otherwise
        symbol[i], alive[j] = made, False
        k, h = after[j], before[i]
        after[i] = k
        if k < n:
            before[k] = i
            if symbol[k] >= 0 and (new := pairs.get(made << 32 | symbol[k])) is not None:
                heapq.heappush(heap, (-rank[new], i, made, symbol[k], new))
        if h >= 0 and symbol[h] >= 0 and (new := pairs.get(symbol[h] << 32 | made)) is not None:
            heapq.heappush(heap, (-rank[new], h, symbol[h], made, new))
    left = [i for i in range(n) if alive[i]]
    return _with_bytes(v, [symbol[i] for i in left], [text[i] for i in left])


def parts(v: Vocabulary, text: str, size: int) -> list[str]:
    """The text cut at the first safe place after every ``size`` characters."""
    out, start = [], 0
    while start < len(text):
        end = v.safe_cut(text, min(start + size, len(text)))
        out.append(text[start:end])
        start = end
    return out


def encode_units(v: Vocabulary, units: list[str]) -> list[bytes]:
    """The model's int32 ids of each unit."""
    cut = [[u] if len(u) <= WORD else parts(v, u, 1) for u in units]
    flat = list({p for ps in cut for p in ps})
    flat.sort(key=len)
    short = [p for p in flat if len(p) <= WORD]
    known = {p: merge_long(v, p) for p in flat[len(short):]}
    for a in range(0, len(short), STEP):
        known.update(zip(short[a:a + STEP], merge_words(v, short[a:a + STEP])))
    return [known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps]) for ps in cut]


class Encoder:
    """Encodes texts; words met before in the task are remembered, up to a bound."""

    def __init__(self, v: Vocabulary, remember: int = 400_000):
        self.v, self.remember, self.known = v, remember, {}

    def learn(self, units: set[str]) -> None:
        new = [u for u in units if u not in self.known]
        if len(self.known) + len(new) > self.remember:
            self.known = {u: self.known[u] for u in units if u in self.known}
        self.known.update(zip(new, encode_units(self.v, new)))

    def marked(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts whose blanks are marks."""
        split = [_UNIT.findall(t) for t in texts]
        self.learn({u for units in split for u in units})
        known = self.known
        return [np.frombuffer(b"".join([known[u] for u in units]), np.int32) for units in split]

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        return self.marked([marked(t or "") for t in texts])


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product of two transfer matrices; associative."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def boundary_states(matrices: list[np.ndarray]) -> list[int]:
    """The state at every cut, both ends included, on the one path of weight 0 through all chunks.

    Products of neighbours are combined up a tree; states are then chosen down it.
    """
    levels = [matrices]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([combine(*low[k:k + 2]) if k + 1 < len(low) else low[k] for k in range(0, len(low), 2)])
    if levels[-1][0][0, 0] != 0:
        raise ValueError("no path through the chunks")
    at = [0, 0]
    for low in levels[-2::-1]:
        states = [at[0]]
        for k in range(0, len(low), 2):
            i, j = at[k // 2], at[k // 2 + 1]
            if k + 1 < len(low):
                states.append(int((low[k][i] + low[k + 1][:, j]).argmax()))
            states.append(j)
        at = states
    return at


def _ids_column(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate([*rows, np.zeros(0, np.int32)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def _encode_batches(vocabulary):
    def run(batches):
        enc, table = Encoder(vocabulary.value), piece_bytes(vocabulary.value)
        for batch in batches:
            for part in slices(batch, "text", 8_000_000):
                ids = enc(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), _ids_column(ids), _digests(table, ids)],
                                                 ["doc_id", "ids", "text_sha256"])

    return run


def _cut_batches(around, chunk):
    """Chunks of marked texts, each with ``around`` characters of what comes before and after it."""

    def run(batches):
        for batch in batches:
            for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                text = marked(text)
                starts = range(0, len(text), chunk)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([key] * len(starts), pa.int64()), pa.array(range(len(starts)), pa.int32()),
                     pa.array([min(a, around) for a in starts], pa.int32()),
                     pa.array([min(a, around) + min(chunk, len(text) - a) for a in starts], pa.int32()),
                     pa.array([text[max(0, a - around):a + chunk + around] for a in starts], pa.string())],
                    ["key", "chunk", "start", "end", "text"])

    return run


def _spans(batch: pa.RecordBatch):
    return zip(*(batch.column(c).to_pylist() for c in ("text", "start", "end")))


def _transfer_batches(vocabulary):
    def run(batches):
        near = Neighbours(vocabulary.value)
        for batch in batches:
            for part in slices(batch, "text", 8_000_000):
                found = [near.transfer(*row) == 0 for row in _spans(part)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("chunk"), pa.array([m.shape[0] for m in found], pa.int32()),
                     pa.array([np.packbits(m).tobytes() for m in found], pa.binary()),
                     pa.array([m.shape[1] for m in found], pa.int32())], ["key", "chunk", "n", "bits", "m"])

    return run


def _scan_table(table: pa.Table) -> pa.Table:
    """The states at the cuts of one text, from the matrices of its chunks; these are smaller than the text."""
    table = table.sort_by("chunk")
    matrices = [np.where(np.unpackbits(np.frombuffer(bits, np.uint8), count=n * m).reshape(n, m), 0.0, NONE)
                for n, bits, m in zip(*(table.column(c).to_pylist() for c in ("n", "bits", "m")))]
    states = pa.array(boundary_states(matrices), pa.int32())
    return pa.table({"key": table.column("key"), "chunk": table.column("chunk"), "first": states[:-1], "last": states[1:]})


def _walk_batches(vocabulary):
    """The ids of each chunk's stretch of the path: from the end of its first state's piece to that of its last one's."""

    def run(batches):
        enc, near = Encoder(vocabulary.value), Neighbours(vocabulary.value)
        for batch in batches:
            for part in slices(batch, "text", 8_000_000):
                states = zip(part.column("first").to_pylist(), part.column("last").to_pylist())
                own = [text[near.states(text, start)[i][1]:near.states(text, end)[j][1]]
                       for (text, start, end), (i, j) in zip(_spans(part), states)]
                yield pa.RecordBatch.from_arrays([part.column("key"), part.column("chunk"), _ids_column(enc.marked(own))],
                                                 ["key", "chunk", "ids"])

    return run


def _digest_batches(vocabulary):
    def run(batches):
        table = piece_bytes(vocabulary.value)
        for batch in batches:
            for row in range(batch.num_rows):  # each is giant
                one = batch.slice(row, 1)
                ids = one.column("ids").flatten().to_numpy()
                yield pa.RecordBatch.from_arrays([*one.columns, _digests(table, [ids])], ["key", "ids", "text_sha256"])

    return run


def encode(docs: DataFrame, model: str = MODEL, giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """doc_id, ids, text_sha256 and n_tokens of each row's whole text.

    The ids are those of the model's own encoder. ``text_sha256`` is the digest of the text
    that they decode to. A null or empty text has no ids; an empty table gives no rows. Repeated
    rows and null ids stay; extra columns are ignored. Texts of more than ``giant`` characters are
    encoded in chunks of ``chunk``; both change how the work is cut, never the ids.
    """
    v = load(model)
    vocabulary = docs.sparkSession.sparkContext.broadcast(v)  # the model's own size
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    long = F.coalesce(F.length("text") > giant, F.lit(False))
    plain = rows.where(~long).mapInArrow(_encode_batches(vocabulary), f"doc_id {id_type}, ids array<int>, text_sha256 string")

    # Equal giant texts are encoded once.
    big = rows.where(long).withColumn("key", F.xxhash64("text", F.length("text")))
    cut = big.dropDuplicates(["key"]).select("key", "text").mapInArrow(
        _cut_batches(v.longest, max(chunk, v.longest + 1)), "key long, chunk int, start int, end int, text string")
    cut = stage(cut.repartition("key", "chunk"), "chunks")
    states = cut.mapInArrow(_transfer_batches(vocabulary), "key long, chunk int, n int, bits binary, m int").groupBy("key").applyInArrow(
        _scan_table, "key long, chunk int, first int, last int")
    walked = cut.join(states, ["key", "chunk"]).mapInArrow(_walk_batches(vocabulary), "key long, chunk int, ids array<int>")
    joined = walked.groupBy("key").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "ids"))), lambda r: r["ids"])).alias("ids"))
    joined = joined.mapInArrow(_digest_batches(vocabulary), "key long, ids array<int>, text_sha256 string")
    giants = big.select("doc_id", "key").join(joined, "key").select("doc_id", "ids", "text_sha256")
    return plain.unionByName(giants).select("doc_id", "ids", "text_sha256", F.size("ids").cast("long").alias("n_tokens"))


def piece_bytes(v: Vocabulary) -> list[bytes]:
    """What each id adds to a text: control pieces nothing, byte pieces their byte."""
    names = {i: bytes([b]) for b, i in v.bytes.items()}
    return [names.get(i, p.replace(MARK, " ").encode("utf-8", "replace") if k == "piece" else b"")
            for i, (p, k) in enumerate(zip(v.pieces, v.kinds))]


def raw_text(table: list[bytes], ids: list[int]) -> bytes:
    return b"".join([table[i] for i in ids]).removeprefix(b" ")


def _digests(table: list[bytes], rows: list[np.ndarray]) -> pa.Array:
    return pa.array([hashlib.sha256(raw_text(table, ids.tolist())).hexdigest() for ids in rows], pa.string())


def _decode_batches(vocabulary):
    def run(batches):
        table = piece_bytes(vocabulary.value)
        for batch in batches:
            out = []
            for ids in batch.column("ids").to_pylist():
                out.append(raw_text(table, ids or []).decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """doc_id and text of each row of ids; null ids give the empty text.

    It is the exact text that was encoded, save that a word mark in it comes back as a blank.
    """
    vocabulary = encoded.sparkSession.sparkContext.broadcast(load(model))
    rows = encoded.select("doc_id", F.col("ids").cast("array<int>").alias("ids"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_decode_batches(vocabulary), f"doc_id {id_type}, text string")


def op8_pieces(spark, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
