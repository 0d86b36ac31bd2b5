"""A third of all rows under one key: how the operators hold up against plain windows.

    python benchmarks/skew.py [folder] [copies per quote]

Writes raw quotes in which one hotel, stay and scrape day holds a third of all rows, then
prints the time of each operator.
"""

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ratecal.functions.frames import newest  # noqa: E402
from ratecal.functions.ranking import number_rows  # noqa: E402
from ratecal.session import local_session  # noqa: E402
from ratecal.sources.testtables import TestTables  # noqa: E402

KEYS = ["hotel_group", "hotel_name_key", "date", "day"]


def skewed(spark, folder, copies):
    raw = TestTables(spark, folder).cash_raw().withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    hot = F.pmod(F.xxhash64("_id", "copy"), F.lit(3)) == 0
    one = {"hotel_group": "asia", "hotel_name_key": "hot", "date": F.to_date(F.lit("1998-05-01")),
           "created_at": F.lit("1998-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.pmod(F.xxhash64("_id"), F.lit(86400)).cast("decimal(18,6)"))}
    moved = {n: F.when(hot, v if not isinstance(v, str) else F.lit(v)).otherwise(F.col(n)) for n, v in one.items()}
    ids = F.concat_ws("-", "_id", F.col("copy").cast("string"))
    return raw.withColumns(moved).withColumns({"_id": ids, "day": F.to_date("created_at")}).drop("copy")


def timed(label, build):
    start = time.time()
    build().write.format("noop").mode("overwrite").save()
    print(f"{label:52} {time.time() - start:7.2f} s", flush=True)


def main(folder="/root/testdata/sf0.1", copies="10"):
    spark = local_session(8, shuffle_partitions=64)
    stored = tempfile.mkdtemp(prefix="skew-") + "/raw"
    skewed(spark, folder, int(copies)).repartition(64).write.parquet(stored)
    rows = spark.read.parquet(stored)
    top = rows.groupBy(*KEYS).count().agg(F.max("count")).first()[0]
    print(f"{rows.count()} rows, {top} under one key")
    order = (F.col("created_at").desc(), F.col("_id").desc())
    ranked = Window.partitionBy(*KEYS).orderBy(*order)

    timed("(warm-up)", lambda: newest(rows, KEYS, *order))
    timed("newest per key (used)", lambda: newest(rows, KEYS, *order))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "-1")
    timed("newest per key, limited after the shuffle only", lambda: newest(rows, KEYS, *order))
    timed("all row numbers, range-partitioned (used)", lambda: number_rows(rows, KEYS, *order))
    timed("all row numbers, plain window", lambda: rows.withColumn("rn", F.row_number().over(ranked)))


if __name__ == "__main__":
    main(*sys.argv[1:])
