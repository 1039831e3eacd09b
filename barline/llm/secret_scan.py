"""Secrets: fixed patterns, and strings that a primed compressor cannot explain.

Patterns find assignments, access keys and long hex. Besides, every long token
in a sensitive context is a candidate: after a sensitive word, also within a name and
over a line end, or inside an armoured key. A compressor primed with code words and
with the text around the candidate compresses that surrounding with and without
it; the marginal bytes per character tell novelty. Identifiers, words and
repeats cost little, random strings their full entropy. Each text is scanned
whole and by itself, so nothing shuffles.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tokens import slices

KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_HEX_LONG = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")

#: Marginal bytes per character from which a string counts as incompressible.
NOVELTY = 0.55
#: Characters on both sides of a candidate that count as its surroundings.
AROUND = 160
_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Characters before a candidate in which a sensitive word is looked for.
BEFORE = 80
_PARTS = ("pass password passwd passphrase pwd secret token apikey accesskey secretkey privatekey accesstoken authtoken "
          "credential cred auth authorization bearer private key signature").split()
_LOWER, _TITLE = "|".join(_PARTS), "|".join(p.title() for p in _PARTS)
#: A sensitive word by itself or as a part of a snake or camel case name, also in the plural; then
#: the rest of its line, or that and the opening of the next line.
_SENSITIVE = re.compile(
    rf"(?:(?<![A-Za-z])(?i:{_LOWER})(?i:s)?(?![A-Za-z])|(?<![A-Za-z])(?:{_LOWER}|{_TITLE})s?(?=[A-Z])|(?<=[A-Za-z0-9])(?:{_TITLE})s?(?![a-z]))"
    r"[^\n]{0,24}(?:\n[ \t\"'`>|+-]*)?\Z")
#: A name and its sign of equality, which are no part of the value.
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_-]*=+(?=[A-Za-z0-9+/_-])")
#: An armoured key: everything from its first line to its last, or to the end of a text that lacks that.
_ARMOUR = re.compile(r"-----BEGIN [A-Z0-9 ]*KEY[A-Z0-9 ]*-----(.*?)(?:-----END |\Z)", re.S)
_BODY = re.compile(r"[A-Za-z0-9+/=_-]+")

#: Code and identifier words that prime the compressor.
DICTIONARY = (
    "import from return class def function public private static const let var string number boolean null true false "
    "password passwd secret token api_key apikey access_key client_secret private_key authorization bearer credential "
    "config settings environment production development localhost username user_id session_id request response header "
    "https:// http:// www. .com .org .net content-type application/json charset=utf-8 getElementById addEventListener "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 example sample placeholder changeme your_key_here "
    "test_token dummy_secret xxxxxxxxxxxxxxxxxxxxxxxx 0000000000000000000000 index value result default options handler "
).encode()


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, in order of start, then kind.

    Matching goes from left to right without overlap per kind; matches that are too
    short are dropped after matching.
    """
    found = []
    if "=" in text or ":" in text:
        found += [(m.start(), m.end(), 0) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), 2) for m in _HEX_LONG.finditer(text)]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda s: (s[0], s[2]))]


class Novelty:
    """Marginal compressed bytes of a string in its surroundings."""

    def __init__(self, dictionary: bytes = DICTIONARY, level: int = 3):
        self._dictionary, self._level = dictionary, level
        primed = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self._compress = zstandard.ZstdCompressor(
            level=level, dict_data=primed, write_content_size=False, write_checksum=False).compress

    def per_char(self, before: str, candidate: str, after: str) -> float:
        a, b = (before + after).encode(errors="replace"), candidate.encode()
        return (len(self._compress(a + b"\n" + b)) - len(self._compress(a))) / max(1, len(candidate))


class _Cover:
    """Whether one of some spans holds a given one; asked in order of start, it takes linear time."""

    def __init__(self, spans):
        self._spans, self._at, self._end = sorted(spans), 0, -1

    def __call__(self, a: int, b: int) -> bool:
        while self._at < len(self._spans) and self._spans[self._at][0] <= a:
            self._end = max(self._end, self._spans[self._at][1])
            self._at += 1
        return b <= self._end


def novel_spans(text: str, novelty: Novelty, known=(), threshold: float = NOVELTY,
                around: int = AROUND) -> list[tuple[int, int, str]]:
    """Spans of kind ``novel``: incompressible tokens that follow a sensitive word, or lie in an armoured key.

    The word stands on the same line or on the one before. Tokens that lie in one of the
    ``known`` spans are reported already and left out.
    """
    armour = [m.span(1) for m in _ARMOUR.finditer(text)] if "-----BEGIN " in text else []
    found = []
    in_known, in_armour = _Cover((s, e) for s, e, _ in known), _Cover(armour)
    for m in _CANDIDATE.finditer(text):
        a, b = m.span()
        name = _NAME.match(text, a, b)
        if name:
            a = name.end()
        if b - a < 16 or in_known(a, b):
            continue
        token = text[a:b]
        if token.isalpha() and (token.islower() or token.istitle() or token.isupper()):
            continue  # one plain word, however long
        if not in_armour(a, b) and _SENSITIVE.search(text, max(0, a - BEFORE), a) is None:
            continue
        if novelty.per_char(text[max(0, a - around):a], token, text[b:b + around]) >= threshold:
            found.append((a, b, "novel"))
    # The last line of an armoured key can be too short for a candidate.
    starts = [a for a, _, _ in found]
    for s, e in armour:
        lines = {m.start(): m.end() for m in _BODY.finditer(text, s, e)}
        for a, b, _ in found[bisect_left(starts, s):bisect_left(starts, e)]:
            after = re.compile(r"[ \t\r]*\n[ \t]*").match(text, b, e)
            if after and after.end() in lines and lines[after.end()] - after.end() < 16:
                found.append((after.end(), lines[after.end()], "novel"))
    return found


def all_spans(text: str, novelty: Novelty, threshold: float = NOVELTY) -> list[tuple[int, int, str]]:
    order = {k: i for i, k in enumerate((*KINDS, "novel"))}
    base = base_spans(text)
    return sorted(base + novel_spans(text, novelty, base, threshold), key=lambda s: (s[0], order[s[2]]))


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def _scan_batches(threshold):
    def scan(batches):
        novelty = Novelty()
        for batch in batches:
            for part in slices(batch, "text"):
                out = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
                for text in part.column("text").to_pylist():
                    text = text or ""
                    spans = all_spans(text, novelty, threshold)
                    base = [s for s in spans if s[2] in KINDS]
                    for k in KINDS:
                        out[f"n_{k}"].append(sum(s[2] == k for s in base))
                    out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                    out["spans"].append(_joined(spans))
                ints = [pa.array(out[f"n_{k}"], pa.int64()) for k in KINDS]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *ints, pa.array(out["base_sha256"], pa.string()), pa.array(out["spans"], pa.string())],
                    ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return scan


def scan_secrets(docs: DataFrame, threshold: float = NOVELTY) -> DataFrame:
    """Counts, digest and spans of each row's text; offsets are code points, ends exclusive.

    A null or empty text has no spans: zeros, the digest of the empty text, an empty
    string. Repeated rows and null ids come out as they are; other columns are ignored; a
    table without rows gives none. Texts are read whole, in time linear in their length.
    """
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_scan_batches(threshold),
                           f"doc_id {id_type}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(text: str | None, novelty: Novelty, threshold: float = NOVELTY, mark: str = "[secret]") -> str | None:
    """The text with every span, overlaps merged, replaced by ``mark``."""
    if not text:
        return text
    out, at = [], 0
    for a, b, _ in all_spans(text, novelty, threshold):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mark]
        at = b
    return "".join([*out, text[at:]])


def _redact_batches(threshold):
    def run(batches):
        novelty = Novelty()
        for batch in batches:
            for part in slices(batch, "text"):
                clean = pa.array([redact(t, novelty, threshold) for t in part.column("text").to_pylist()], pa.string())
                at = part.schema.get_field_index("text")
                yield part.set_column(at, "text", clean)

    return run


def redact_secrets(docs: DataFrame, threshold: float = NOVELTY) -> DataFrame:
    """The same rows and columns with the secrets of ``text`` replaced."""
    return docs.mapInArrow(_redact_batches(threshold), docs.schema)


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    return scan_secrets(spark.read.parquet(f"{sf_dir}/documents.parquet"))
