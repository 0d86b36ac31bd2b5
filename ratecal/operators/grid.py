"""The calendar grid: hotels x stay dates x booking dates, with the quotes known for each cell.

Cash and points tables are clean, that is unique per (group, key, stay, booked day). So
one (group, key, stay) never holds more rows than the calendar has booking days, which
bounds every per-stay array, group and window here however skewed the hotels are.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratecal.functions.calendar import date_literal
from ratecal.functions.frames import spread
from ratecal.schemas import CELL, GROUP, HOTEL, KEY, PRICE, STAY

OFFSETS = (3, 7, 14, 30, 60, 90, 180)  # fixed values: days ahead that are sampled


def hotels_of(cash: DataFrame, *extra: str) -> DataFrame:
    """The hotels a grid covers: those of the cash table. Hotels with points only have no cells."""
    return cash.select(*HOTEL, *extra).distinct()


def last_stay(booked) -> Column:
    """The last stay date bookable on a day: one year ahead, less a day."""
    return F.date_sub(F.add_months(booked, 12), 1)


def date_spine(bounds: DataFrame) -> DataFrame:
    """Every booking day from `start` to `end` with each stay date of the year that follows.
    `bounds` has those two columns, one row per spine."""
    days = bounds.select(F.explode(F.sequence("start", "end")).alias("date_booked"))
    return spread(days, "date_booked").select(
        "date_booked", F.explode(F.sequence("date_booked", last_stay("date_booked"))).alias("date_stay")
    )


def booking_bounds(quotes: DataFrame) -> DataFrame:
    """First and last booking day of a table, as bounds of a spine."""
    return quotes.agg(F.min("date_booked").alias("start"), F.max("date_booked").alias("end"))


def hotel_months(hotels: DataFrame, first, last) -> DataFrame:
    """One row per hotel and month from `first` to `last` (date columns), as `_month`.

    Hotels are few, days many: they are spread out by hotel and month before the days are
    made, so that making them is not left to the few tasks that hold the hotel list.
    """
    months = F.sequence(F.trunc(first, "month"), last, F.expr("INTERVAL 1 MONTH"))
    return spread(hotels.withColumn("_month", F.explode(months)), *hotels.columns, "_month")


def days_of_month(first, last) -> Column:
    return F.sequence(F.greatest("_month", first), F.least(F.last_day("_month"), last))


def hotel_calendar(hotels: DataFrame, first, last, name: str) -> DataFrame:
    """One row per hotel and day from `first` to `last` (date columns)."""
    by_month = hotel_months(hotels, first, last)
    return by_month.select(*hotels.columns, F.explode(days_of_month(first, last)).alias(name))


def hotel_days(hotels: DataFrame, start, end) -> DataFrame:
    """One row per hotel and booking day of the spine."""
    return hotel_calendar(hotels, date_literal(start), date_literal(end), "date_booked")


def stays_and_quotes(cash: DataFrame, points: DataFrame, start, end, offsets=OFFSETS) -> DataFrame:
    """Every stay the sampled cells of a spine can have (`is_stay`) and every other one with quotes, each with the
    days and prices of its quotes: arrays `_cash` and `_points`, NULL on a stay without quotes.

    This is the one shuffle of the sample operators, by hotel and month of stay: of quotes, and of one row per hotel and
    month. Stays and their cells are made after it. Most stays have no quote; they are never shuffled, sorted or grouped.
    """
    first = F.date_add(date_literal(start), min(offsets))
    last = F.date_add(date_literal(end), max(offsets))
    none, month = F.lit(None), F.trunc("date_stay", "month").alias("_month")
    day = F.col("date_booked")
    quote = lambda price: F.struct(day.alias("day"), F.col(price).cast(PRICE).alias("price"))
    kind = "struct<day:date,price:decimal(18,4)>"
    months = hotel_months(hotels_of(cash), first, last)
    rows = (
        months.select(*HOTEL, "_month", none.cast("date").alias("date_stay"), F.lit(True).alias("_own"), none.cast(kind).alias("_cash"), none.cast(kind).alias("_points"))
        .union(cash.select(*HOTEL, month, "date_stay", F.lit(False), quote("cash"), none.cast(kind)))
        .union(points.select(*HOTEL, month, "date_stay", F.lit(False), none.cast(kind), quote("points")))
    )
    known = (
        spread(rows, *HOTEL, "_month")
        .groupBy(*HOTEL, "_month", "date_stay")
        .agg(F.max("_own").alias("_own"), F.collect_list("_cash").alias("_cash"), F.collect_list("_points").alias("_points"))
        .groupBy(*HOTEL, "_month")
        .agg(F.max("_own").alias("_own"), F.collect_list(F.when(~F.col("_own"), F.struct("date_stay", "_cash", "_points"))).alias("_known"))
    )
    days = days_of_month(first, last)
    bare = F.transform(
        F.array_except(F.when(F.col("_own"), days).otherwise(F.array().cast("array<date>")), F.col("_known.date_stay")),
        lambda stay: F.struct(
            stay.alias("date_stay"), none.cast(f"array<{kind}>").alias("_cash"), none.cast(f"array<{kind}>").alias("_points")
        ),
    )
    stays = known.select(*HOTEL, "_own", F.concat("_known", bare).alias("_stays")).select(*HOTEL, "_own", F.inline("_stays"))
    return stays.withColumn("is_stay", F.col("_own") & F.col("date_stay").between(first, last)).drop("_own")


def sampled_days(offsets=OFFSETS) -> Column:
    """The booking days of a stay's sampled cells."""
    return F.array(*[F.date_sub("date_stay", n) for n in dict.fromkeys(offsets)])


def in_spine(start, end) -> Column:
    return F.col("date_booked").between(date_literal(start), date_literal(end))


def place() -> Column:
    """Where a stay lies: a number that tables of cells and quotes are dealt by, so that they meet without being dealt
    again. Unlike the stay's own columns it is never NULL."""
    return F.xxhash64(*STAY)


def cells_of(stays: DataFrame, days: Column, find: Callable[[Column], Column]) -> DataFrame:
    """The cells of stays on `days`, with what `find` makes of a day and the stay's quotes, a struct, as `_found`: NULL on
    stays without quotes, for which nothing is looked up."""
    known = stays.withColumn("_days", days)
    known = known.withColumn("_all", F.when(F.col("_cash").isNotNull(), F.transform("_days", find)))
    cells = known.select(*STAY, "is_stay", "_all", F.posexplode("_days").alias("_i", "date_booked"))
    return cells.select(*CELL, "is_stay", F.get("_all", "_i").alias("_found"))


def own_price(price: str, day: Column) -> Column:
    return F.array_max(F.filter(f"_{price}", lambda q: q.day == day)).price.alias(price)


def _own_prices(stays: DataFrame, start, end, offsets) -> DataFrame:
    """The sampled cells (`is_cell`) and all quoted ones, each with the prices of its own day."""
    none = F.array().cast("array<date>")
    sampled = F.when(F.col("is_stay"), sampled_days(offsets)).otherwise(none)
    days = F.when(
        F.col("_cash").isNotNull(), F.array_distinct(F.concat(sampled, F.col("_cash.day"), F.col("_points.day")))
    ).otherwise(sampled)
    cells = cells_of(stays, days, lambda day: F.struct(own_price("cash", day), own_price("points", day)))
    is_cell = F.col("is_stay") & _window().isin(*offsets) & in_spine(start, end)
    cells = cells.select(*CELL, is_cell.alias("is_cell"), "_found.cash", "_found.points")
    return cells.filter("is_cell OR cash IS NOT NULL OR points IS NOT NULL")


def sample_base(cash: DataFrame, points: DataFrame, start, end, offsets=OFFSETS) -> DataFrame:
    """The grid's cells at the sampled booking windows: what filtering the dense grid leaves
    (for offsets under 365), without building the rest of it. Dealt by stay, which quotes can then be held against."""
    stays = spread(stays_and_quotes(cash, points, start, end, offsets).filter("is_stay"), place())
    cells = _own_prices(stays, start, end, offsets).filter("is_cell")
    return cells.select(*CELL, _window(), "cash", "points")


def sparse_grid(cash: DataFrame, points: DataFrame, start, end, offsets=OFFSETS) -> DataFrame:
    """The sampled cells and, besides, every (hotel, stay, booked day) that has a quote, also
    of hotels or days the spine does not cover."""
    stays = stays_and_quotes(cash, points, start, end, offsets)
    return _own_prices(stays, start, end, offsets).select(*CELL, _window(), "cash", "points")


def observed_cells(cash: DataFrame, points: DataFrame, start, end) -> DataFrame:
    """The cells of the dense grid that hold a price, straight from the quotes: equal to
    filtering the dense grid, without building it."""
    spine = in_spine(start, end) & F.col("date_stay").between(F.col("date_booked"), last_stay("date_booked"))
    none = F.lit(None).cast(PRICE)
    rows = cash.select(*CELL, F.col("cash").cast(PRICE), none.alias("points")).union(
        points.join(hotels_of(cash), list(HOTEL), "left_semi").select(*CELL, none, F.col("points").cast(PRICE))
    )
    merged = rows.filter(spine).groupBy(*CELL).agg(F.max("cash").alias("cash"), F.max("points").alias("points"))
    return merged.select(*CELL, _window(), "cash", "points")


def dense_grid(cash: DataFrame, points: DataFrame, start, end) -> DataFrame:
    """Every cell: each hotel of the cash table, booking day of the spine and stay date of the
    year that follows, with the prices known for it."""
    return _fill(hotels_of(cash), _observed_days(cash, points), HOTEL, start, end)


def dense_grid_v1(cash: DataFrame, points: DataFrame, start, end) -> DataFrame:
    """First-generation grid: hotels are distinct with their city and quotes are matched by
    key and dates alone. Where hotel groups share a key, a cell is repeated for each pairing
    of their quotes."""
    on = [KEY, "date_stay", "date_booked"]
    pairs = cash.select(*on, F.col("cash").cast(PRICE)).join(
        points.select(*on, F.col("points").cast(PRICE)), on, "full"
    )
    return _fill(hotels_of(cash, "city"), pairs, (KEY,), start, end)


def _observed_days(cash: DataFrame, points: DataFrame) -> DataFrame:
    none = F.lit(None).cast(PRICE)
    rows = cash.select(*CELL, F.col("cash").cast(PRICE), none.alias("points")).union(
        points.select(*CELL, none, F.col("points").cast(PRICE))
    )
    return spread(rows, *STAY).groupBy(*CELL).agg(F.max("cash").alias("cash"), F.max("points").alias("points"))


def _fill(hotels: DataFrame, observed: DataFrame, match, start, end) -> DataFrame:
    """The cells of `hotels` with the prices of `observed`.

    Works by (hotel, stay): the observed booking days of a stay are gathered into one array, at most a year of days. The
    stay's days are then runs: each observed day, and the days between two of them, which have no price. Runs are unpacked
    into cells last, so what is found out for a stay costs its runs, of which most stays have one, and a cell costs its
    making only. Only quotes and (hotel, stay) pairs are shuffled, never the cells. The result stays partitioned by
    (hotel, stay) for windows that follow.
    """
    first, last = date_literal(start), date_literal(end)
    stay = [*match, "date_stay"]
    within = in_spine(start, end) & F.col("date_stay").between(F.col("date_booked"), last_stay("date_booked"))
    known = (
        spread(observed.filter(within), *stay)
        .groupBy(*stay)
        .agg(F.sort_array(F.collect_list(F.struct("date_booked", "cash", "points"))).alias("known"))
    )
    hotel_stays = hotel_calendar(hotels, first, last_stay(last), "date_stay")

    # A leap day makes a booking year 366 days long; 364 days ahead a stay can always be booked.
    year = F.array(*[F.date_sub("date_stay", n) for n in (366, 365, 364)])
    low = F.greatest(F.array_min(F.filter(year, lambda day: last_stay(day) >= F.col("date_stay"))), first)
    high = F.least("date_stay", last)
    empty = F.lit(None).cast(PRICE)
    run = lambda a, b, cash, points: F.struct(a.alias("from"), b.alias("to"), cash.alias("cash"), points.alias("points"))
    days = F.col("known.date_booked")
    between = F.zip_with(
        F.concat(F.array(F.date_sub("low", 1)), days), F.concat(days, F.array(F.date_add("high", 1))),
        lambda a, b: run(F.date_add(a, 1), F.date_sub(b, 1), empty, empty),
    )
    observed_days = F.transform("known", lambda q: run(q.date_booked, q.date_booked, q.cash, q.points))
    runs = F.when(
        F.col("known").isNotNull(), F.concat(observed_days, F.filter(between, lambda r: r["from"] <= r.to))
    ).otherwise(F.array(run(F.col("low"), F.col("high"), empty, empty)))
    return (
        spread(hotel_stays, *stay)
        .withColumns({"low": low, "high": high})
        .join(known, stay, "left")
        .select(*hotels.columns, "date_stay", F.inline(runs))
        .select(*hotels.columns, "date_stay", F.explode(F.sequence("from", "to")).alias("date_booked"), "cash", "points")
        .select(*hotels.columns, "date_stay", "date_booked", _window(), "cash", "points")
    )


def with_price(grid: DataFrame) -> DataFrame:
    """Cells with a cash or points price."""
    return grid.filter("cash IS NOT NULL OR points IS NOT NULL")


def at_windows(grid: DataFrame, offsets=OFFSETS) -> DataFrame:
    """Cells of a built grid at the sampled booking windows."""
    return grid.filter(F.col("booking_window").isin(*offsets))


def _window() -> Column:
    return F.datediff("date_stay", "date_booked").alias("booking_window")
