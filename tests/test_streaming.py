"""Incremental historisation with Structured Streaming."""

import os

from immolens.operators.gold import to_gold
from immolens.schema import SILVER
from immolens.sources.files import read_history, write_gold
from immolens.streaming import historize_available


def snapshot(spark, date, prices):
    rows = [(f"T{i}", "30 m²", f"{p} €", "d", f"https://x/a/{i}/", "p", i) for i, p in enumerate(prices)]
    return to_gold(spark.createDataFrame(rows, SILVER), date)


def test_stream_appends_new_dates_and_replaces_reruns(spark, tmp_dir):
    gold, hist, ckpt = (os.path.join(tmp_dir, n) for n in ("gold", "history", "ckpt"))
    write_gold(snapshot(spark, "2025-02-02", [600, 700]), gold)
    write_gold(snapshot(spark, "2025-02-09", [610]), gold)
    historize_available(spark, gold, hist, ckpt)
    assert read_history(spark, hist).count() == 3

    write_gold(snapshot(spark, "2025-02-16", [620, 630, 640]), gold)
    historize_available(spark, gold, hist, ckpt)
    assert read_history(spark, hist).count() == 6

    # a rerun of one date replaces that date only
    write_gold(snapshot(spark, "2025-02-09", [611, 612]), gold)
    historize_available(spark, gold, hist, ckpt)
    by_date = {str(r[0]): r[1] for r in read_history(spark, hist).groupBy("date_scraping").count().collect()}
    assert by_date == {"2025-02-02": 2, "2025-02-09": 2, "2025-02-16": 3}

    # nothing new: no change
    historize_available(spark, gold, hist, ckpt)
    assert read_history(spark, hist).count() == 7


def test_a_date_split_over_micro_batches_keeps_all_rows(spark, tmp_dir):
    gold, hist, ckpt = (os.path.join(tmp_dir, n) for n in ("gold", "history", "ckpt"))
    rows = snapshot(spark, "2025-03-02", [600 + i for i in range(12)])
    # three files for one date, then one micro-batch per file
    rows.repartition(3).write.mode("append").partitionBy("date_scraping").parquet(gold)
    historize_available(spark, gold, hist, ckpt, max_files_per_trigger=1)
    assert read_history(spark, hist).count() == 12
