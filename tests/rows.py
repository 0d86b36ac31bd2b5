"""Small hand-written tables."""

from datetime import date, datetime
from decimal import Decimal

from ratecal.functions.frames import conform
from ratecal.schemas import HOTEL_CASH, HOTEL_POINTS, PRICE
from pyspark.sql import types as T

D = date.fromisoformat
TS = datetime.fromisoformat

CLEAN = {
    price: T.StructType(
        [T.StructField(n, k) for n, k in (
            ("hotel_group", T.StringType()), ("hotel_name_key", T.StringType()),
            ("date_stay", T.DateType()), ("date_booked", T.DateType()), (price, PRICE),
        )]
    )
    for price in ("cash", "points")
}


def clean(spark, price, rows):
    """Clean quotes from (key, stay, booked, price)."""
    data = [("g", key, D(stay), D(booked), Decimal(str(value))) for key, stay, booked, value in rows]
    return spark.createDataFrame(data, CLEAN[price])


def raw_cash(spark, rows):
    """Raw cash quotes from (id, key, stay, created, price, overrides)."""
    data = []
    for _id, key, stay, created, price, *more in rows:
        row = dict(_id=_id, hotel_group="g", hotel_id="1", hotel_name_key=key, date=D(stay), created_at=TS(created),
                   cash_value=None if price is None else Decimal(str(price)), currency="USD", award_category="a")
        row.update(*more)
        data.append(tuple(row.get(f.name) for f in HOTEL_CASH))
    return spark.createDataFrame(data, HOTEL_CASH)


def raw_points(spark, rows):
    data = []
    for _id, key, stay, created, points in rows:
        row = dict(_id=_id, hotel_group="g", hotel_id="1", hotel_name_key=key, date=D(stay), created_at=TS(created),
                   points=Decimal(str(points)), award_category="a")
        data.append(tuple(row.get(f.name) for f in HOTEL_POINTS))
    return spark.createDataFrame(data, HOTEL_POINTS)


def values(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
