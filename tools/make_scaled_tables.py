"""Write a scaled (and optionally skewed) copy of the driver tables.

``lineitem`` is copied ``--copies`` times with shifted order keys into a
multi-file Parquet folder; with ``--skew`` every third line item is moved
to part 0 and supplier 0, so one listing (and its city) holds a third of
all rows. The other tables are linked from the source folder. Used for the
scaling and skew checks in README.md:

    python tools/make_scaled_tables.py /root/testdata/sf0.1 "$(mktemp -d /tmp/run-XXXXXX)" --copies 10 [--skew]
    BENCH_SF_DIR=<out> python bench.py
    python tools/oracle_check.py <out> price_evolution persistence ...
"""
from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import functions as F  # noqa: E402

from immolens.session import local_session  # noqa: E402
from tools.oracle_check import TABLES  # noqa: E402


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("src")
    ap.add_argument("dst")
    ap.add_argument("--copies", type=int, default=10)
    ap.add_argument("--skew", action="store_true")
    ap.add_argument("--files", type=int, default=32)
    args = ap.parse_args()

    spark = local_session(8)
    li = spark.read.parquet(f"{args.src}/lineitem.parquet")
    width = li.agg(F.max("l_orderkey")).first()[0] + 1
    copies = spark.range(args.copies).withColumnRenamed("id", "copy")
    big = (li.crossJoin(F.broadcast(copies))        # ``copies`` rows, a parameter
             .withColumn("l_orderkey", F.col("l_orderkey") + F.col("copy") * width)
             .drop("copy"))
    if args.skew:
        hot = F.col("l_orderkey") % 3 == 0
        big = (big.withColumn("l_partkey", F.when(hot, F.lit(0)).otherwise(F.col("l_partkey")))
                  .withColumn("l_suppkey", F.when(hot, F.lit(0)).otherwise(F.col("l_suppkey"))))
    big.repartition(args.files).write.mode("overwrite").parquet(f"{args.dst}/lineitem.parquet")
    for t in TABLES:
        if t != "lineitem" and not os.path.exists(f"{args.dst}/{t}.parquet"):
            os.symlink(os.path.realpath(f"{args.src}/{t}.parquet"), f"{args.dst}/{t}.parquet")
    print(spark.read.parquet(f"{args.dst}/lineitem.parquet").count(), "line items in", args.dst)


if __name__ == "__main__":
    main()
