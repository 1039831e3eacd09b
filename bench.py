"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
``etl_build`` covers building the lake tables from the given ones; the other
entries run on them, as they would on a stored lake.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from barline.session import get_spark  # noqa: E402
from checks import lake  # noqa: E402
from checks.queries import QUERIES  # noqa: E402

HEADLINE = [
    "bars_daily", "clean_bars", "dedupe_latest", "validate_fallback", "returns", "bollinger", "rsi",
    "macd", "atr", "indicators_all", "feature_matrix", "market_window", "left_join_prices_indicators",
    "upsert_prices", "lookback_sequences", "drift_backtest", "equity_curve", "eval_metrics",
    "ann_mean_cov", "mc_portfolios", "portfolio_record", "lexicon_score", "sentiment_symbol",
    "top15_articles", "tick_bars", "latest_tick", "tick_quality", "stream_tick_bars", "gbt_forecast",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_spark(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    times: dict[str, float] = {}
    start = time.perf_counter()
    lake.featured(spark, sf_dir)
    times["etl_build"] = round(time.perf_counter() - start, 3)
    for name in HEADLINE:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
