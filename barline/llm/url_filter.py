"""URL filters: host rules, and a blocked Bloom filter ahead of an exact list join.

Everything here is DataFrame functions. A listed URL sets ``PROBES`` bits of one
512-bit block that its hash names; the filter is a table of blocks, built by a
bitwise-or aggregate. URLs whose bits are all set may be listed; only those meet
the list itself, in an equi-join on the whole canonical URL that drops false
positives. Blocks are a function of the list's size (about 12 bits a URL), so
the filter's false positives stay rare at any size, and no broadcast is forced:
Spark broadcasts the filter or the list where its own size threshold allows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 6
BITS_PER_URL = 12

#: (action, host, path prefix); the longest rule that fits wins.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Labels of hosts whose pages the standard list is made from.
SPAM_LABELS = ("spam-farm", "cheap-pills", "casino-win", "free-bets", "ads-track", "adult-x")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(url.isNull() | (at == 0), F.lit("")).otherwise(F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"(?s)^([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``? #`` or the end; else empty."""
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*(/[^?#]*)?", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www. m. blog.``, path without a file ending or closing slashes.

    Scheme, query and fragment do not tell two pages apart here.
    """
    bare = F.regexp_replace(host, r"^(www|m|blog)\.", "")
    return F.concat(bare, F.regexp_replace(path, r"(\.html)?/*$", ""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits host and path, as a struct (rule, action), or null."""
    out = None
    for action, name, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(prefix)
        hit = F.struct(F.lit(name + prefix).alias("rule"), F.lit(action).alias("action"))
        out = F.when(fits, hit) if out is None else out.when(fits, hit)
    return out if out is not None else F.lit(None).cast("struct<rule:string,action:string>")


def _bits(h: Column) -> Column:
    """Eight words of 64 bits with the probe bits of a hash set."""
    spread = [F.pmod(F.shiftrightunsigned(h, 9 * k), F.lit(512)) for k in range(PROBES)]
    return F.array(*[
        _or_all([F.when(F.shiftright(p, 6) == w, _bit(p)).otherwise(F.lit(0)) for p in spread])
        for w in range(8)
    ])


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))


def _or_all(columns: list[Column]) -> Column:
    out = columns[0].cast("long")
    for c in columns[1:]:
        out = out.bitwiseOR(c.cast("long"))
    return out


def bloom(listed: DataFrame, column: str, blocks: int) -> DataFrame:
    """Rows (block, w0..w7) of a blocked Bloom filter of ``listed[column]``."""
    h = F.xxhash64(F.col(column), F.lit(1))
    rows = listed.select(F.pmod(F.xxhash64(F.col(column)), F.lit(blocks)).alias("block"), _bits(h).alias("bits"))
    return rows.groupBy("block").agg(*[F.bit_or(F.col("bits")[w]).alias(f"w{w}") for w in range(8)])


def in_list(urls: DataFrame, listed: DataFrame, column: str, n_listed: int) -> DataFrame:
    """The different values of ``urls[column]`` that ``listed[column]`` holds.

    The Bloom join narrows them first; the join on the value itself decides.
    """
    blocks = max(1, -(-n_listed * BITS_PER_URL // 512))
    values = urls.select(column).where(F.col(column).isNotNull()).distinct()
    probe = values.withColumns({
        "block": F.pmod(F.xxhash64(F.col(column)), F.lit(blocks)),
        "bits": _bits(F.xxhash64(F.col(column), F.lit(1))),
    })
    may = probe.join(bloom(listed, column, blocks), "block")
    for w in range(8):
        may = may.where(F.col("bits")[w].bitwiseAND(F.col(f"w{w}")) == F.col("bits")[w])
    return may.select(column).join(listed.select(column).distinct(), column)


def judge_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules=RULES) -> DataFrame:
    """Verdict on each URL: that of its longest rule, else block if it is listed, else allow.

    ``listed`` has one column ``canonical``. A null URL or one without ``://`` has an
    empty host and path, fits no rule and is never listed, so it is allowed. Repeated
    rows stay repeated; an empty list blocks nothing, a table without rows gives none; null
    ids are passed on; other columns are ignored; URLs are read whole.
    """
    rows = pages.select(F.col(id_col).alias(id_col), F.col(url_col).alias("_url"))
    rows = rows.select(id_col, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"))
    rows = rows.withColumns({"_rule": rule_of(F.col("host"), F.col("path"), rules),
                             "canonical": F.when(F.col("host") != "", canonical(F.col("host"), F.col("path")))})
    n_listed = listed.select("canonical").distinct().count()
    hits = in_list(rows, listed, "canonical", n_listed).withColumn("listed", F.lit(True))
    verdict = F.coalesce(F.col("_rule.action"), F.when(F.col("listed"), "block"), F.lit("allow"))
    return rows.join(hits, "canonical", "left").select(
        id_col, "host", "path", F.col("_rule.rule").alias("rule"), verdict.alias("verdict"),
        F.coalesce("listed", F.lit(False)).alias("listed"))


def spam_list(pages: DataFrame, url_col: str = "url", labels=SPAM_LABELS) -> DataFrame:
    """The list of canonical URLs on hosts that carry one of ``labels``."""
    host, path = host_of(F.col(url_col)), path_of(F.col(url_col))
    found = F.arrays_overlap(F.split(host, r"\."), F.array(*[F.lit(x) for x in labels]))
    return pages.where(found).select(canonical(host, path).alias("canonical")).distinct()


SQL = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN ''
                       ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
hp AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*(/[^?#]*)?', 1) AS path FROM u),
c AS (
  SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m|blog)\.', '') || regexp_replace(path, '(\.html)?/*$', '') END AS canonical,
    CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
         WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
         WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM hp),
l AS (SELECT DISTINCT canonical FROM c WHERE list_has_any(string_split(host, '.'), ['spam-farm', 'cheap-pills', 'casino-win', 'free-bets', 'ads-track', 'adult-x']))
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  l.canonical IS NOT NULL AS listed
FROM c LEFT JOIN l ON c.canonical = l.canonical
"""


def op9_url_filter(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, spam_list(pages))
