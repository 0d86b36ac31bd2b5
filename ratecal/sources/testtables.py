"""Quotes, documents and hotel templates in the shapes the operators expect, derived from
the order tables of the test data: an order line is a quote, its supplier the hotel."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecal.schemas import GROUP, PRICE
from ratecal.session import new_folder


class TestTables:
    """The derived tables of one test data folder. All are lazy."""

    __test__ = False  # not a test class

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def stored(self) -> "TestTables":
        """The same tables over quotes that are written to the work folder once, for what reads them many times: the joins
        behind them are then done once, not for every collection, chunk or run."""
        path, out = new_folder(self.spark), TestTables(self.spark, self.folder)
        self.quotes().write.parquet(path)
        kept = self.spark.read.parquet(path)
        out.quotes = lambda: kept
        return out

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def hotels(self) -> DataFrame:
        """Suppliers with their nation as city and their region as hotel group."""
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(F.col("s_suppkey").alias("l_suppkey"), *self._hotel_columns())
        )

    @staticmethod
    def _hotel_columns():
        return [
            F.lower("r_name").alias("hotel_group"),
            F.col("s_suppkey").cast("string").alias("hotel_id"),
            F.col("s_name").alias("hotel_name"),
            F.lower(F.replace("s_name", F.lit("#"), F.lit("-"))).alias("_key"),
            F.lower("n_name").alias("city"),
            F.col("s_acctbal").cast(PRICE).alias("review_rating"),
        ]

    def quotes(self) -> DataFrame:
        """Flat quotes. Each has a cash price; every other line of an order has points too."""
        part, line = F.col("l_partkey"), F.col("l_linenumber")
        return (
            self.table("lineitem")
            .join(self.table("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
            # one small table after the other: each is broadcast by its own file size, and quotes stay in place
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select("*", *self._hotel_columns())
            .select(
                F.concat_ws(
                    "-", F.lpad(F.col("l_orderkey").cast("string"), 12, "0"), line.cast("string"),
                    part.cast("string"), F.col("l_suppkey").cast("string"),
                ).alias("_id"),
                "hotel_group",
                "hotel_id",
                "hotel_name",
                F.when(part % 97 == 0, "").otherwise(F.col("_key")).alias("hotel_name_key"),
                "city",
                F.trunc(F.to_date("l_shipdate"), "month").alias("date"),
                (F.col("o_orderdate") + F.make_dt_interval(hours=line)).alias("created_at"),
                F.col("l_extendedprice").cast(PRICE).alias("cash_value"),
                F.when(part % 10 == 9, "EUR").otherwise("USD").alias("currency"),
                F.when(line % 2 == 0, (F.col("l_quantity") * 1000).cast(PRICE)).alias("points"),
                F.col("l_returnflag").alias("award_category"),
                F.col("l_linestatus").alias("points_level"),
                part.alias("_part"),
            )
        )

    def cash_raw(self) -> DataFrame:
        return self.quotes().drop("points", "points_level", "_part")

    def points_raw(self) -> DataFrame:
        return self.quotes().filter("points IS NOT NULL").drop("cash_value", "currency", "_part")

    def documents(self) -> DataFrame:
        """Quotes as documents. `cash_value` is JSON text: mostly an object, in places a scalar,
        missing, or with an amount that is no number; some stay dates do not parse."""
        part = F.col("_part")
        amount = F.when(part % 23 == 0, "x").otherwise(F.col("cash_value").cast("string"))
        price = (
            F.when(part % 13 == 0, F.col("cash_value").cast("string"))
            .when(part % 17 == 0, F.lit(None))
            .otherwise(F.to_json(F.struct(amount.alias("amount"), F.col("currency").alias("currency"))))
        )
        stay = F.when(part % 19 == 0, "not a date").otherwise(F.date_format("date", "yyyy-MM-dd"))
        return self.quotes().withColumns({"cash_value": price, "date": stay}).drop("currency", "_part")

    def collections(self) -> dict[str, DataFrame]:
        """Documents by group, kind and age, under the names collections go by. Only scanned if used."""
        docs = self.documents()
        age = {"archived_": F.col("created_at") < F.lit("2000-01-01"), "": F.col("created_at") >= F.lit("2000-01-01")}
        out = {}
        for prefix, of_age in age.items():
            for group in ("africa", "america", "asia", "europe", "middle east"):
                rows = docs.filter(of_age & (F.col(GROUP) == group))
                out[f"{prefix}hotel_calendar_cash_{group}"] = rows.drop("points", "points_level")
                out[f"{prefix}hotel_calendar_{group}"] = rows.filter("points IS NOT NULL").drop("cash_value")
        return out

    def template_documents(self) -> DataFrame:
        """Hotel descriptions, one per hotel and year it has quotes in; some undated, many fields blank."""
        year = F.year("l_shipdate").alias("_year")
        seen = self.table("lineitem").groupBy("l_suppkey", year).agg(
            F.max("l_shipdate").alias("_seen"), F.count(F.lit(1)).alias("_count")
        )
        number = F.col("l_suppkey") + F.col("_year")
        return seen.join(self.hotels(), "l_suppkey").select(
            F.concat_ws("-", F.lit("t"), F.col("_year").cast("string"), F.col("hotel_id")).alias("_id"),
            "hotel_group",
            F.when(number % 29 == 0, "").otherwise(F.col("hotel_name")).alias("name"),
            "hotel_id",
            F.when(number % 3 == 0, "").otherwise(F.concat(F.lit("seen in "), F.col("_year"))).alias("description"),
            F.lit("").alias("address"),
            "city",
            F.col("city").alias("slug_city"),
            F.lit("").alias("state"),
            F.lit(None).cast("string").alias("state_code"),
            F.struct(
                F.when(number % 5 == 0, "").otherwise((number % 90).cast("string")).alias("latitude"),
                (number % 180).cast("string").alias("longitude"),
            ).alias("coordinates"),
            F.struct(F.when(number % 7 == 0, "").otherwise("USD").alias("currency")).alias("cash_value"),
            F.col("_count").cast("string").alias("review_count"),
            F.col("review_rating").cast("string").alias("review_rating"),
            F.lit("").alias("country"),
            F.lit(None).cast("string").alias("country_code"),
            F.lit("").alias("telephone"),
            F.lit("").alias("chain_rating"),
            F.when(number % 11 == 0, F.lit(None)).otherwise(F.col("_seen")).alias("created_at"),
        )
