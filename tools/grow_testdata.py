"""Derive an N-times larger copy of one driver scale, for growth checks.

usage: python tools/grow_testdata.py SRC_DIR DST_DIR [N] [FILES]

Every row of orders, lineitem and events is repeated N times with its key
shifted by a per-copy offset (keys stay unique, duplicates and defects stay
where the key arithmetic puts them); the small tables are copied.  Each grown
table is written as FILES Parquet files, like a real bronze table.  DST_DIR
must be a fresh scratch folder; the source is only read.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tillroll.session import local_session  # noqa: E402

# table -> key columns shifted per copy, and the shift (above the largest key)
GROWN = {
    "orders": ("o_orderkey",),
    "lineitem": ("l_orderkey",),
    "events": ("event_id",),
}
COPIED = ("region", "nation", "customer", "supplier", "part")


def main() -> None:
    src, dst = sys.argv[1], sys.argv[2]
    n = int(sys.argv[3]) if len(sys.argv) > 3 else 10
    files = int(sys.argv[4]) if len(sys.argv) > 4 else 16
    spark = local_session(8, 16)
    offsets = {}
    for name, keys in GROWN.items():
        df = spark.read.parquet(f"{src}/{name}.parquet")
        offsets[name] = df.agg(F.max(keys[0])).collect()[0][0] + 1
    # lineitem shares the order key space with orders
    offsets["lineitem"] = offsets["orders"] = max(offsets["orders"], offsets["lineitem"])
    for name, keys in GROWN.items():
        df = spark.read.parquet(f"{src}/{name}.parquet")
        copy = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_copy")
        grown = (df.select("*", copy)
                   .withColumns({k: F.col(k) + F.col("_copy") * offsets[name] for k in keys})
                   .drop("_copy"))
        grown.repartition(files).write.mode("errorifexists").parquet(f"{dst}/{name}.parquet")
    for name in COPIED:
        spark.read.parquet(f"{src}/{name}.parquet").write.mode("errorifexists").parquet(f"{dst}/{name}.parquet")
    print({name: spark.read.parquet(f"{dst}/{name}.parquet").count() for name in GROWN})


if __name__ == "__main__":
    main()
