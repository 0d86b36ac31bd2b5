"""Times the plans chosen for the costly operators against the obvious alternatives.

    python benchmarks/designs.py [folder] [quotes per stay to multiply by]

Clean tables are written first, so only the operator is timed. The two ways to find
neighbours are also checked to give the same rows; tests check the other pairs.
"""

import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ratecal.operators import asof, grid  # noqa: E402
from ratecal.plans.catalog import SPINE, _all_quotes  # noqa: E402
from ratecal.schemas import CELL, HOTEL, STAY  # noqa: E402
from ratecal.session import local_session  # noqa: E402
from ratecal.sources.testtables import TestTables  # noqa: E402


def band_join(cells, cash):
    """Previous and next cash quote by joining all quotes of the stay and keeping the nearest."""
    quotes = cash.select(*STAY, F.col("date_booked").alias("day"), F.col("cash").alias("price"))
    out = cells
    for side, before in (("prev", True), ("next", False)):
        order = F.col("day").desc() if before else F.col("day")
        beyond = F.col("day") < F.col("date_booked") if before else F.col("day") > F.col("date_booked")
        a, b = out.alias("a"), quotes.alias("b")
        same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in STAY]
        joined = a.join(b, [*same, beyond], "left").select("a.*", "day", "price")
        w = Window.partitionBy(*CELL).orderBy(order)
        nearest = joined.withColumn("rn", F.row_number().over(w)).filter("rn = 1").drop("rn")
        out = nearest.withColumnsRenamed({"day": f"day_{side}", "price": f"cash_{side}"})
    return out.select(*CELL, "cash_prev", "cash_next")


def joined_grid(cash, points):
    """The dense grid by joining both quote tables to every cell."""
    days = grid.hotel_days(grid.hotels_of(cash), *SPINE)
    cells = days.select(*HOTEL, "date_booked", F.explode(F.sequence("date_booked", grid.last_stay("date_booked"))).alias("date_stay"))
    return cells.join(cash.select(*CELL, "cash"), list(CELL), "left").join(points.select(*CELL, "points"), list(CELL), "left")


def timed(label, build, runs=2):
    best = None
    for _ in range(runs):
        start = time.time()
        build().write.format("noop").mode("overwrite").save()
        best = min(best or 1e9, time.time() - start)
    print(f"{label:58} {best:7.2f} s", flush=True)


def main(folder="/root/testdata/sf0.01", denser="1"):
    spark = local_session(8)
    stored = tempfile.mkdtemp(prefix="designs-")
    cash, points = _all_quotes(TestTables(spark, folder))
    if int(denser) > 1:  # more booking days per stay, from the quotes themselves
        shift = F.explode(F.sequence(F.lit(0), F.lit(int(denser) - 1))).alias("shift")
        def thicken(quotes, price):
            rows = quotes.select(*STAY, F.col("date_booked").alias("day"), price, shift)
            rows = rows.withColumn("date_booked", F.date_sub("day", F.col("shift") * 3))
            return rows.groupBy(*CELL).agg(F.max(price).alias(price))
        cash, points = thicken(cash, "cash"), thicken(points, "points")
    cash.write.parquet(f"{stored}/cash")
    points.write.parquet(f"{stored}/points")
    cash, points = spark.read.parquet(f"{stored}/cash"), spark.read.parquet(f"{stored}/points")
    # Cells at the stays that have quotes: every quoted booking day is a cell.
    cells = cash.select(*CELL).union(points.select(*CELL)).distinct()
    cells.write.parquet(f"{stored}/cells")
    cells = spark.read.parquet(f"{stored}/cells")
    print(f"{folder}: {cash.count()} cash quotes, {points.count()} points quotes, {cells.count()} cells")

    def window_form():
        rows = cells.withColumn("_cell", F.lit(True)).unionByName(
            cash.select(*CELL, F.col("cash").alias("_cash")), allowMissingColumns=True
        )
        return asof.add_neighbours(rows, {"cash": F.col("_cash")}).filter("_cell").select(*CELL, "cash_prev", "cash_next")

    same = window_form().exceptAll(band_join(cells, cash)).count() == 0
    print("window form and band join agree:", same)
    timed("neighbours, window over united rows (used)", window_form)
    timed("neighbours, band join and row_number", lambda: band_join(cells, cash))
    timed("estimates at sampled windows, fused (used)", lambda: asof.sample_estimates(cash, points, *SPINE))
    timed("estimates at sampled windows, base then neighbours",
          lambda: asof.interpolate(asof.nearest_quotes(grid.sample_base(cash, points, *SPINE), cash, points)))
    timed("sampled cells, offsets only (used)", lambda: grid.sample_base(cash, points, *SPINE))
    timed("sampled cells, filter of the dense grid", lambda: grid.at_windows(grid.dense_grid(cash, points, *SPINE)), 1)
    timed("priced cells, from the quotes (used)", lambda: grid.observed_cells(cash, points, *SPINE))
    timed("priced cells, filter of the dense grid", lambda: grid.with_price(grid.dense_grid(cash, points, *SPINE)), 1)
    timed("dense grid, arrays per stay (used)", lambda: grid.dense_grid(cash, points, *SPINE), 1)
    timed("dense grid, both tables joined to every cell", lambda: joined_grid(cash, points), 1)


if __name__ == "__main__":
    main(*sys.argv[1:])
