"""Landed text payloads to typed rows: daily JSON, feed entries, news items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Field names of the daily payload.
SERIES_FIELD = "Time Series (Daily)"
BAR_FIELDS = {
    "open": "1. open", "high": "2. high", "low": "3. low", "close": "4. close",
    "adjusted_close": "5. adjusted close", "volume": "6. volume",
}
REFUSALS = ("Error Message", "Note")

SUMMARY_CHARS = 500
NEWS_ITEMS = 15

# The news item, nested or flat.
_NEWS_SCHEMA = """
    title string, publisher string, link string, providerPublishTime string,
    content struct<title: string, pubDate: string,
                   provider: struct<displayName: string>,
                   canonicalUrl: struct<url: string>,
                   clickThroughUrl: struct<url: string>>
"""


def parse_daily(payloads: DataFrame, ingested_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``(symbol, payload)`` rows to bars and rejects.

    A payload that reports an error, or is not a series, is rejected whole; a
    day whose numbers cannot be read is rejected alone.
    """
    schema = f"struct<`{SERIES_FIELD}`: map<string, map<string, string>>>"
    refused = F.coalesce(
        *[F.get_json_object("payload", f"$['{name}']") for name in REFUSALS]
    )
    read = payloads.withColumns(
        {"series": F.from_json("payload", schema)[SERIES_FIELD], "refused": refused}
    )
    bad = F.col("refused").isNotNull() | F.col("series").isNull()
    whole = read.where(bad).select(
        "symbol", F.lit(None).cast("string").alias("date"),
        F.coalesce("refused", F.lit("not a daily series")).alias("reason"),
    )
    days = read.where(~bad).select("symbol", F.explode("series").alias("day", "bar"))
    typed = days.select(
        "symbol",
        F.col("day").try_cast("date").alias("date"),
        *[
            F.col("bar")[field].try_cast("bigint" if name == "volume" else "double").alias(name)
            for name, field in BAR_FIELDS.items()
        ],
        F.col("day"),
    )
    fields = ["date", *BAR_FIELDS]
    unreadable = F.lit(False)
    for c in fields:
        unreadable = unreadable | F.col(c).isNull()
    rows = typed.where(~unreadable).select(
        "symbol", *fields,
        (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"),
    )
    parts = typed.where(unreadable).select(
        "symbol", F.col("day").alias("date"), F.lit("unreadable day").alias("reason")
    )
    return rows, whole.unionByName(parts)


def parse_entries(entries: DataFrame, as_of: Column, lookback_days: int = 7,
                  summary_chars: int | None = None) -> DataFrame:
    """Feed entries ``(symbol, feed_url, feed_title, title, summary, link,
    published)`` to headlines. An entry without a time counts as new. Summaries
    stay whole unless a display asks for their first ``summary_chars``."""
    summary = F.coalesce("summary", F.lit(""))
    published = F.coalesce("published", as_of)
    recent = entries.withColumn("published", published).where(
        F.col("published") >= as_of - F.expr(f"INTERVAL {int(lookback_days)} DAYS")
    )
    return recent.select(
        "symbol",
        F.to_date("published").alias("date"),
        F.coalesce("title", F.lit("")).alias("headline"),
        (F.substring(summary, 1, summary_chars) if summary_chars else summary).alias("summary"),
        F.coalesce("link", F.lit("")).alias("url"),
        F.coalesce("feed_title", "feed_url").alias("source"),
        as_of.alias("ingested_at"),
    )


def news_items(payloads: DataFrame) -> DataFrame:
    """``(symbol, payload)`` with a JSON array to one row per item with its
    place in the array."""
    items = F.from_json("payload", "array<string>")
    return payloads.select("symbol", F.posexplode(items).alias("seq", "item"))


def parse_news(items: DataFrame, limit: int | None = None) -> DataFrame:
    """``(symbol, seq, item)`` to articles, those without a title dropped. With a
    ``limit``, the first so many items per symbol are taken before that; per map
    task only ``limit`` rows of a symbol are shuffled."""
    first = items
    if limit is not None:
        w = Window.partitionBy("symbol").orderBy("seq")
        first = items.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= limit)
    j = F.from_json("item", _NEWS_SCHEMA)
    n = first.withColumn("j", j).withColumn("c", F.col("j.content"))
    nested = F.col("c").isNotNull()

    def text(c: str) -> Column:
        return F.nullif(F.col(c), F.lit(""))

    link = F.coalesce("c.canonicalUrl", "c.clickThroughUrl")["url"]
    return n.select(
        "symbol",
        "seq",
        F.coalesce(text("c.title"), text("j.title")).alias("title"),
        F.coalesce(text("c.provider.displayName"), F.col("j.publisher"), F.lit("")).alias("publisher"),
        F.when(nested, F.coalesce(link, F.lit(""))).otherwise(
            F.coalesce("j.link", F.lit(""))
        ).alias("url"),
        F.coalesce("c.pubDate", "j.providerPublishTime", F.lit("")).alias("published_at"),
    ).where(F.col("title").isNotNull())


def untitled_news(items: DataFrame) -> DataFrame:
    """Items that ``parse_news`` leaves out, with the reason."""
    j = F.from_json("item", _NEWS_SCHEMA)
    title = F.coalesce(F.nullif(j["content"]["title"], F.lit("")), F.nullif(j["title"], F.lit("")))
    return items.where(title.isNull()).select("symbol", "item", F.lit("no title").alias("reason"))


def unread_news(payloads: DataFrame) -> DataFrame:
    """Payloads that are no array of items, with the reason."""
    items = F.from_json("payload", "array<string>")
    return payloads.where(items.isNull()).select(
        "symbol", F.col("payload").alias("item"), F.lit("not a list of items").alias("reason"))


def news_headlines(articles: DataFrame, as_of: Column) -> DataFrame:
    """Articles as dated headlines. A time is ISO text or epoch seconds; an article without
    a readable one counts as new."""
    text = F.col("published_at")
    day = F.coalesce(F.to_date(text.try_cast("timestamp")),
                     F.to_date(F.timestamp_seconds(text.try_cast("bigint"))), F.to_date(as_of))
    return articles.select(
        "symbol", day.alias("date"), F.col("title").alias("headline"), F.lit("").alias("summary"),
        "url", F.col("publisher").alias("source"), as_of.cast("timestamp").alias("ingested_at"))
