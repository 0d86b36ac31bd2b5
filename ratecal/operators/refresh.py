"""Estimates kept up to date: when quotes arrive, only the cells that they can change are estimated again.

A cell's neighbours are the nearest quotes before and after its booking day. A new quote can only take the place of a
neighbour for cells between the quotes next to it on both sides, so these cells, and no others, are made anew.

The table of estimates is kept as a first table and the changes of each arrival, so that an arrival writes the cells it
made anew and neither reads nor writes the others. `current` is the table they make together.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratecal.functions.frames import newest
from ratecal.operators.asof import EARLIER, GAPS, LATER, add_neighbours, estimated, nearest_quotes, sample_estimates
from ratecal.operators.grid import OFFSETS, hotels_of, in_spine, sampled_days
from ratecal.schemas import CELL, HOTEL, PRICE, STAY


def merged_quotes(stored: DataFrame, arrived: DataFrame) -> DataFrame:
    """Clean quotes after an arrival: the newest of each cell, late ones included."""
    return newest(stored.unionByName(arrived), list(CELL), F.col("created_at").desc(), F.col("_id").desc())


def changed_spans(stored: DataFrame, merged: DataFrame, arrived: DataFrame, price: str) -> DataFrame:
    """Stay, `low`, `high` for each booking day whose price is not what it was: the days of the stored quotes next to it, NULL
    where there is none. Only stays with arrivals are looked at."""
    stays = arrived.select(*STAY).distinct()
    now = merged.join(stays, list(STAY), "left_semi").select(*CELL, F.col(price).cast(PRICE).alias("_now"))
    was = stored.join(stays, list(STAY), "left_semi").select(*CELL, F.col(price).cast(PRICE).alias("_was"))
    both = now.join(was, list(CELL), "full")
    found = add_neighbours(both, {price: F.col("_was")}).filter(~F.col("_now").eqNullSafe(F.col("_was")))
    low, high = GAPS[price, EARLIER], GAPS[price, LATER]
    return found.select(*STAY, F.expr(f"date_sub(date_booked, {low})").alias("low"), F.expr(f"date_add(date_booked, {high})").alias("high"))


@dataclass(frozen=True)
class Refreshed:
    """`estimates`, `cash` and `points` as they are now; `touched`: the cells that were estimated again, `changes`: their
    estimates."""

    estimates: DataFrame
    cash: DataFrame
    points: DataFrame
    touched: DataFrame
    changes: DataFrame


def refresh(
    estimates: DataFrame, cash: DataFrame, points: DataFrame, new_cash: DataFrame, new_points: DataFrame, start, end, offsets=OFFSETS,
    keep=lambda name, rows: rows,
) -> Refreshed:
    """Estimates (as `sample_estimates` gives them) after clean quotes have arrived: equal to a rebuild from all quotes.

    Work follows the arrivals: shuffled are stays with arrivals and the keys of cells. Hotels that had no cash
    quote before get all their cells. The caller stores the quotes, and either the estimates, or the changes, whose work
    follows the arrivals too (`current` then gives the estimates); so the next arrival starts from tables. `keep` may store
    what is used several times (`cash`, `points`, `touched`) and give it back as a table, so that it is made once.
    """
    now_cash, now_points = keep("cash", merged_quotes(cash, new_cash)), keep("points", merged_quotes(points, new_points))
    known = hotels_of(cash)
    fresh_hotels = hotels_of(new_cash).join(known, list(HOTEL), "left_anti")
    spans = changed_spans(cash, now_cash, new_cash, "cash").unionByName(changed_spans(points, now_points, new_points, "points"))
    spans = spans.join(known, list(HOTEL), "left_semi")
    near = F.coalesce(F.col("date_booked") >= F.col("low"), F.lit(True)) & F.coalesce(F.col("date_booked") <= F.col("high"), F.lit(True))
    cells = spans.withColumn("date_booked", F.explode(sampled_days(offsets))).filter(near & in_spine(start, end)).select(*CELL).distinct()
    cells = keep("touched", cells)

    stays = cells.select(*STAY).distinct()
    own_cash, own_points = (t.join(stays, list(STAY), "left_semi") for t in (now_cash, now_points))
    base = cells
    for price, quotes in (("cash", own_cash), ("points", own_points)):
        base = base.join(quotes.select(*CELL, F.col(price).cast(PRICE)), list(CELL), "left")
    base = base.withColumn("booking_window", F.datediff("date_stay", "date_booked"))
    again = estimated(nearest_quotes(base, own_cash, own_points))
    fresh = sample_estimates(*(t.join(fresh_hotels, list(HOTEL), "left_semi") for t in (now_cash, now_points)), start, end, offsets)
    changes = again.unionByName(fresh)
    out = estimates.join(cells, list(CELL), "left_anti").unionByName(changes)
    return Refreshed(out, now_cash, now_points, cells.unionByName(fresh.select(*CELL)), changes)


def current(first: DataFrame, changes: DataFrame) -> DataFrame:
    """The estimates after some arrivals: `first` with the `changes` of all of them, `run` being the arrival's number. The
    latest change of a cell counts. However many arrivals there are, the first table meets them once, and is not sorted. They
    meet by stay: its cells stay side by side, so that what is shuffled packs well."""
    latest = newest(changes, list(CELL), F.col("run").desc()).drop("run")
    days = latest.groupBy(*STAY).agg(F.collect_set("date_booked").alias("_days")).hint("shuffle_hash").alias("c")
    same = F.array_contains("c._days", F.col("f.date_booked"))
    for name in STAY:
        same &= F.col(f"f.{name}") == F.col(f"c.{name}")
    return first.alias("f").join(days, same, "left_anti").unionByName(latest)
