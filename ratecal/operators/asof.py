"""Nearest earlier and later quotes of a cell, and prices interpolated between them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratecal.functions.calendar import date_literal, month_of
from ratecal.functions.frames import spread
from ratecal.operators.grid import (
    OFFSETS, cells_of, date_spine, hotel_months, hotels_of, in_spine, last_stay, observed_cells, own_price, place, sampled_days, stays_and_quotes,
)
from ratecal.schemas import CELL, HOTEL, PRICE, STAY

EARLIER, LATER = "prev", "next"
# names of the day-gap columns
GAPS = {("cash", EARLIER): "cp_gap", ("cash", LATER): "cn_gap", ("points", EARLIER): "pp_gap", ("points", LATER): "pn_gap"}


def add_neighbours(rows: DataFrame, quotes: dict[str, Column], sides=(EARLIER, LATER)) -> DataFrame:
    """For every row, the nearest quote of its stay on a day strictly before and after its own.

    `quotes` maps a price name to the column that holds it on rows that are quotes and NULL
    elsewhere. Adds `<price>_prev`, `<price>_next` and the gaps in days.

    The frame is a range of days that ends one day away, so a quote of the same day never
    counts. The later side uses the same frame over the reversed calendar: a frame that
    only grows takes one pass, while `1 following .. unbounded` is evaluated anew per row.
    """
    day = F.unix_date("date_booked")
    stays = Window.partitionBy(*STAY)
    frames = {
        side: stays.orderBy(order).rangeBetween(Window.unboundedPreceding, -1)
        for side, order in ((EARLIER, day), (LATER, -day))
    }
    found = {}
    for price, value in quotes.items():
        quote = F.when(value.isNotNull(), F.struct(F.col("date_booked").alias("day"), value.alias("price")))
        for side in sides:
            found[price, side] = F.last(quote, ignorenulls=True).over(frames[side])
    out = rows.withColumns({f"_{price}_{side}": column for (price, side), column in found.items()})
    for price, side in found:
        packed = f"_{price}_{side}"
        gap = F.abs(F.datediff("date_booked", f"{packed}.day"))
        out = out.withColumns({f"{price}_{side}": F.col(f"{packed}.price"), GAPS[price, side]: gap}).drop(packed)
    return out


def nearest_quotes(base: DataFrame, cash: DataFrame, points: DataFrame, sides=(EARLIER, LATER)) -> DataFrame:
    """Any table of cells with the quotes nearest to each: a strict as-of join of both quote
    tables in both directions.

    Quotes are gathered by stay, at most one a day, and each cell looks for its neighbours among those of its stay. Cells
    are neither sorted nor united with quotes; those that are dealt by stay, like `sample_base`'s, stay where they are.
    """
    none = F.lit(None)
    quote = lambda price: F.struct(F.col("date_booked").alias("day"), F.col(price).cast(PRICE).alias("price"))
    kind = "struct<day:date,price:decimal(18,4)>"
    rows = cash.select(*STAY, quote("cash").alias("_cash"), none.cast(kind).alias("_points")).union(
        points.select(*STAY, none.cast(kind), quote("points"))
    )
    known = (
        spread(rows, place())
        .groupBy(place().alias("_place"), *STAY)
        .agg(F.collect_list("_cash").alias("_cash"), F.collect_list("_points").alias("_points"))
    )
    # One key to join by, which is what both sides are dealt by. The stay is compared in the pairs that it makes, as a
    # range, for an equality would be a further key to deal by. Structs of NULLs are equal.
    mine, theirs = (F.struct(*[F.col(f"{side}.{c}") for c in STAY]) for side in "ab")
    same = (F.col("_place") == F.xxhash64(*[F.col(f"a.{c}") for c in STAY])) & mine.between(theirs, theirs)
    held = base.alias("a").join(known.hint("shuffle_hash").alias("b"), same, "left").select("a.*", "_cash", "_points")
    day = F.col("date_booked")
    found = [neighbour(p, side, day) for p in ("cash", "points") for side in sides]
    held = held.withColumn("_found", F.when(F.col("_cash").isNotNull(), F.struct(*found)))
    return held.select(*[F.col(f"`{c}`") for c in base.columns], *_neighbours(sides))


def neighbour(price: str, side: str, day: Column) -> Column:
    """The day and price of the quote nearest to a day on one side of it, from a stay's quotes."""
    if side == EARLIER:
        return F.array_max(F.filter(f"_{price}", lambda q: q.day < day)).alias(f"{price}_{side}")
    return F.array_min(F.filter(f"_{price}", lambda q: q.day > day)).alias(f"{price}_{side}")


def _neighbours(sides=(EARLIER, LATER)) -> list[Column]:
    """Prices and gaps of the neighbours in `_found`."""
    out = []
    for price in ("cash", "points"):
        for side in sides:
            quote = F.col(f"_found.{price}_{side}")
            out += [
                quote.price.alias(f"{price}_{side}"),
                F.abs(F.datediff("date_booked", quote.day)).alias(GAPS[price, side]),
            ]
    return out


def interpolate(cells: DataFrame) -> DataFrame:
    """Adds `cash_est` (to cents) and `points_est` (to whole points) from a cell's neighbours."""
    return cells.withColumns({"cash_est": _estimate("cash", 2), "points_est": _estimate("points", 0)})


def _estimate(price: str, digits: int) -> Column:
    """On the line between both neighbours, else whichever there is. A cell's own price plays
    no part, so estimates of cells that have one measure the error."""
    prev, nxt = F.col(f"{price}_prev"), F.col(f"{price}_next")
    before, after = F.col(GAPS[price, EARLIER]), F.col(GAPS[price, LATER])
    between = (prev * after + nxt * before) / (before + after)
    return F.round(F.coalesce(between, prev, nxt), digits).cast(PRICE)


def sample_estimates(cash: DataFrame, points: DataFrame, start, end, offsets=OFFSETS) -> DataFrame:
    """Sampled cells, their neighbours and estimates, from the clean tables at once. Equal to
    `interpolate(nearest_quotes(sample_base(..), ..))`.

    Each sampled day of a stay is held against the stay's quotes, after the one shuffle. The work is quotes x offsets,
    and making the cells; for hundreds of offsets the three steps are cheaper.
    """
    def find(day):
        sides = [neighbour(p, side, day) for p in ("cash", "points") for side in (EARLIER, LATER)]
        return F.struct(own_price("cash", day), own_price("points", day), *sides)

    stays = stays_and_quotes(cash, points, start, end, offsets).filter("is_stay")
    cells = cells_of(stays, sampled_days(offsets), find).filter(in_spine(start, end))
    window = F.datediff("date_stay", "date_booked").alias("booking_window")
    return estimated(cells.select(*CELL, window, "_found.cash", "_found.points", *_neighbours()))


def estimated(cells: DataFrame) -> DataFrame:
    """Cells with their neighbours as rows of the estimate table."""
    return interpolate(cells).select(
        *CELL, "booking_window", "cash", "points", "cash_est", "points_est",
        "cash_prev", "cp_gap", "cash_next", "cn_gap", "points_prev", "pp_gap", "points_next", "pn_gap",
    )


def adjacent_interpolation(grid: DataFrame) -> DataFrame:
    """Estimates from the grid rows next to a cell (the booking days before and after, priced
    or not), the distance to the nearer one for cells without a price, and the relative error.

    Kept for completeness: since an estimate falls back on the cell's own price first, the
    error of a priced cell is always 0. `nearest_quotes` is the operator to use.
    """
    w = Window.partitionBy(*STAY).orderBy("date_booked")
    side = {
        f"{name}_{column}": shift(column).over(w)
        for name, shift in (("prev", F.lag), ("next", F.lead))
        for column in ("cash", "points", "date_booked")
    }
    rows = grid.withColumns(side)
    before = F.datediff("date_booked", "prev_date_booked")
    after = F.datediff("next_date_booked", "date_booked")
    span = F.datediff("next_date_booked", "prev_date_booked")
    for price, digits in (("cash", 2), ("points", 0)):
        own, prev, nxt = F.col(price), F.col(f"prev_{price}"), F.col(f"next_{price}")
        between = F.round(prev + (nxt - prev) * before / span, digits).cast(PRICE)
        estimate = F.coalesce(own, between, prev, nxt)
        rows = rows.withColumns(
            {
                f"est_{price}": estimate,
                f"est_{price}_gap": F.when(own.isNull(), F.least(before, after)).otherwise(0),
                f"est_{price}_error": F.when(own.isNotNull(), F.abs(estimate - own) / own),
            }
        )
    return rows


def adjacent_summary(cash: DataFrame, points: DataFrame, start, end) -> DataFrame:
    """What `adjacent_interpolation` finds on the dense grid, summed by hotel and booking month, without building the grid.

    A cell can only have an estimate if it or a cell next to it is priced, so cells are made from the priced ones: each
    tells its price to its own day and to the days before and after. All others add to the counts only, and how many
    there are follows from the calendar. Work grows with the quotes, not with the 365 cells of each hotel and day.
    """
    spark = cash.sparkSession
    day = F.col("date_booked")
    told = observed_cells(cash, points, start, end).select(
        *STAY, "cash", "points", F.explode(F.array(*[F.struct(F.lit(k).alias("from"), F.date_sub(day, k).alias("day")) for k in (-1, 0, 1)])).alias("x")
    )
    told = told.select(*STAY, F.col("x.day").alias("date_booked"), "x.from", "cash", "points")
    told = told.filter(in_spine(start, end) & F.col("date_stay").between(day, last_stay("date_booked")))
    side = {-1: "prev", 0: "own", 1: "next"}
    cells = told.groupBy(*CELL).agg(
        *[F.max(F.when(F.col("from") == k, F.col(p))).alias(f"{p}_{name}") for p in ("cash", "points") for k, name in side.items()]
    )
    # booking days without a neighbour on the grid: those of a stay that can be booked on one day only
    bounds = spark.range(1).select(date_literal(start).alias("start"), date_literal(end).alias("end"))
    spine = date_spine(bounds)
    single = spine.groupBy("date_stay").agg(F.count(F.lit(1)).alias("n"), F.min("date_booked").alias("date_booked")).filter("n = 1")
    single = single.select("date_stay", "date_booked", F.lit(True).alias("_single"))
    cells = cells.join(single, ["date_stay", "date_booked"], "left")
    sums = []
    for price, digits in (("cash", 2), ("points", 0)):
        own, prev, nxt = (F.col(f"{price}_{name}") for name in ("own", "prev", "next"))
        between = F.round(prev + (nxt - prev) / 2, digits).cast(PRICE)
        estimate = F.coalesce(own, between, prev, nxt)
        sums += [
            F.count(estimate).alias(f"est_{price}_n"), F.sum(estimate).alias(f"est_{price}"),
            F.count_if(own.isNotNull() & F.col("_single").isNull()).alias(f"_{price}"), F.count(own).alias(f"_all_{price}"),
            F.max(F.when(own.isNotNull(), F.abs(estimate - own) / own)).alias(f"est_{price}_error"),
        ]
    month = month_of("date_booked").alias("month_booked")
    found = cells.groupBy(*HOTEL, month).agg(*sums)
    every = spine.join(single, ["date_stay", "date_booked"], "left").groupBy(month).agg(
        F.count(F.lit(1)).alias("cells"), F.count_if(F.col("_single").isNull()).alias("_beside")
    )
    months = hotel_months(hotels_of(cash), date_literal(start), date_literal(end)).withColumnRenamed("_month", "month_booked")
    rows = months.join(F.broadcast(every), "month_booked").join(found, [*HOTEL, "month_booked"], "left")
    # 0 for a priced cell, 1 for others beside a cell, nothing for those without
    gap = lambda p: F.when((F.col("_beside") > 0) | (F.col(f"_all_{p}") > 0), F.col("_beside") - F.coalesce(F.col(f"_{p}"), F.lit(0)))
    return rows.select(
        *HOTEL, "month_booked", "cells", *[F.coalesce(F.col(f"est_{p}_n"), F.lit(0)).alias(f"est_{p}_n") for p in ("cash", "points")],
        "est_cash", "est_points", gap("cash").alias("est_cash_gap"), gap("points").alias("est_points_gap"), "est_cash_error", "est_points_error",
    )
