"""Declared schemas of the documents read and the tables written."""

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 4)

GROUP, KEY = "hotel_group", "hotel_name_key"
HOTEL = (GROUP, KEY)
STAY = (GROUP, KEY, "date_stay")
CELL = (GROUP, KEY, "date_stay", "date_booked")


def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_text, _date, _time, _int = T.StringType(), T.DateType(), T.TimestampNTZType(), T.IntegerType()

# Documents. `cash_value` is declared as text because it may hold an object, a
# scalar or nothing; the JSON reader then keeps the raw JSON of an object.
CASH_DOCUMENT = _struct(
    ("_id", _text), ("hotel_group", _text), ("hotel_name", _text), ("hotel_id", _text),
    ("hotel_name_key", _text), ("city", _text), ("award_category", _text),
    ("date", _text), ("cash_value", _text), ("created_at", _time),
)
POINTS_DOCUMENT = _struct(
    ("_id", _text), ("hotel_group", _text), ("hotel_name", _text), ("hotel_id", _text),
    ("hotel_name_key", _text), ("city", _text), ("award_category", _text),
    ("points_level", _text), ("date", _text), ("points", PRICE), ("created_at", _time),
)
TEMPLATE_DOCUMENT = _struct(
    ("_id", _text), ("hotel_group", _text), ("name", _text), ("hotel_id", _text),
    ("description", _text), ("address", _text), ("city", _text), ("slug_city", _text),
    ("state", _text), ("state_code", _text),
    ("coordinates", _struct(("latitude", _text), ("longitude", _text))),
    ("cash_value", _struct(("currency", _text),)),
    ("review_count", _text), ("review_rating", _text), ("country", _text),
    ("country_code", _text), ("telephone", _text), ("chain_rating", _text),
    ("created_at", _time),
)

# Raw tables, in output column order; the last four columns say where a row came from.
LINEAGE = (("run_id", _text), ("input_table", _text), ("chunk_n", _int), ("extract_dt", _time))

HOTEL_CASH = _struct(
    ("hotel_group", _text), ("hotel_name", _text), ("date", _date), ("cash_value", PRICE),
    ("currency", _text), ("created_at", _time), ("award_category", _text),
    ("hotel_name_key", _text), ("hotel_id", _text), ("_id", _text), *LINEAGE,
)
HOTEL_POINTS = _struct(
    ("hotel_group", _text), ("hotel_name", _text), ("date", _date), ("points", PRICE),
    ("created_at", _time), ("award_category", _text), ("points_level", _text),
    ("hotel_name_key", _text), ("hotel_id", _text), ("_id", _text), *LINEAGE,
)
HOTEL_TEMPLATE = _struct(
    ("hotel_group", _text), ("hotel_name", _text), ("hotel_id", _text),
    ("description", _text), ("address", _text), ("city", _text), ("slug_city", _text),
    ("state", _text), ("state_code", _text), ("latitude", T.DecimalType(18, 8)),
    ("longitude", T.DecimalType(18, 8)), ("currency", _text), ("review_count", _int),
    ("review_rating", PRICE), ("country", _text), ("country_code", _text),
    ("telephone", _text), ("chain_rating", PRICE), ("created_at", _time), ("_id", _text),
    ("run_id", _int), ("dt", _time),
)
RUN = _struct(("run_id", _int), ("run_name", _text), ("details", _text), ("run_dt", _time))
