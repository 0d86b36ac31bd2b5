"""The two jobs: documents to raw tables, and raw tables to the analysis sample."""

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratecal.operators import asof, clean, grid, sample
from ratecal.operators.documents import clean_cash, clean_points, clean_templates, snapshot_dedupe
from ratecal.operators.grid import OFFSETS
from ratecal.schemas import HOTEL_CASH, HOTEL_POINTS, HOTEL_TEMPLATE
from ratecal.sources.collections import union_collections, window_copy
from ratecal.sources.tables import overwrite, read_table, start_run, with_lineage, write_run

# First booking day of the grid, and the booking days of the final sample.
SPINE_START = "2022-11-15"
SAMPLE_FIRST, SAMPLE_LAST = "2022-12-01", "2023-07-31"


def raw_rows(collections: Mapping[str, DataFrame], kind: str, run_id, extract_dt, ids_unique=False) -> DataFrame:
    """The rows that collections of one kind add to the raw table: one plan for all of them."""
    docs = snapshot_dedupe(union_collections(collections), ("input_table",), ids_unique)
    rows = clean_cash(docs) if kind == "cash" else clean_points(docs)
    return with_lineage(rows, run_id, chunk_n=0, extract_dt=extract_dt)


def extract_quotes(
    spark: SparkSession,
    cash: Mapping[str, DataFrame],
    points: Mapping[str, DataFrame],
    folder: str,
    extract_dt,
    prefix="",
    ids_unique=False,
    run_id: int | None = None,
) -> int:
    """Adds cash and points collections to the raw tables under a new run number, or again under that
    of a run that failed half-way: what it had stored is replaced. `ids_unique` says that the
    collections hold each `_id` once, as a document store sees to."""
    if run_id is None:
        run_id = start_run(spark, f"{folder}/{prefix}run", "extract_quotes", f"prefix={prefix}")
    for kind, collections, schema in (("cash", cash, HOTEL_CASH), ("points", points, HOTEL_POINTS)):
        rows = raw_rows(collections, kind, run_id, extract_dt, ids_unique)
        write_run(rows, f"{folder}/{prefix}hotel_{kind}", schema, run_id)
    return run_id


def extract_templates(
    spark: SparkSession, collections: Mapping[str, DataFrame], folder: str, extract_dt, prefix="", run_id: int | None = None
) -> int:
    """Adds hotel descriptions of all collections; here the run and extraction time columns are
    `run_id` and `dt`."""
    if run_id is None:
        run_id = start_run(spark, f"{folder}/{prefix}run", "extract_templates")
    rows = reduce(DataFrame.unionByName, [clean_templates(docs) for docs in collections.values()])
    rows = rows.withColumns({"run_id": F.lit(run_id), "dt": F.lit(extract_dt).cast("timestamp_ntz")})
    write_run(rows, f"{folder}/{prefix}hotel_template_raw", HOTEL_TEMPLATE, run_id)
    return run_id


def copy_collections(collections: Mapping[str, DataFrame], folder: str, start, end, format="json") -> None:
    """Replaces each collection's copy in `folder`: calendar collections by what was scraped
    in the interval, templates by everything."""
    for name, docs in collections.items():
        overwrite(window_copy(docs, name, start, end), f"{folder}/{name}", format=format)


def build_sample(
    cash_raw: DataFrame,
    points_raw: DataFrame,
    templates: DataFrame,
    folder: str,
    city: str,
    end,
    start=SPINE_START,
    first=SAMPLE_FIRST,
    last=SAMPLE_LAST,
    exclude: DataFrame | None = None,
    offsets=OFFSETS,
) -> DataFrame:
    """Raw tables to `hotel_sample`. Stored on the way are what later steps read more than
    once: the clean tables (read by hotel list, cells and quotes) and the estimates (read by
    the sample and every quality report)."""
    spark = cash_raw.sparkSession
    hotels = clean.sampled_hotels(templates, city)
    overwrite(clean.cash_quotes(cash_raw, hotels), f"{folder}/hotel_cash_clean")
    overwrite(clean.points_quotes(points_raw, hotels), f"{folder}/hotel_points_clean")
    cash = spark.read.parquet(f"{folder}/hotel_cash_clean")
    points = spark.read.parquet(f"{folder}/hotel_points_clean")
    overwrite(asof.sample_estimates(cash, points, start, end, offsets), f"{folder}/hotel_sample_est", partition_by=("hotel_group",))
    estimates = spark.read.parquet(f"{folder}/hotel_sample_est")
    overwrite(sample.final_sample(estimates, first, last, exclude), f"{folder}/hotel_sample", partition_by=("hotel_group",))
    return spark.read.parquet(f"{folder}/hotel_sample")


RAW_VIEWS = {
    "hotel_cash_raw": ("hotel_cash", HOTEL_CASH),
    "hotel_points_raw": ("hotel_points", HOTEL_POINTS),
    "hotel_templates": ("hotel_template_raw", HOTEL_TEMPLATE),
}
# View names for SQL on top of the stored tables, and the table of the jobs each shows.
VIEWS = {
    "hotel_cash": "hotel_cash_clean",
    "hotel_points": "hotel_points_clean",
    "hotel_sample_est": "hotel_sample_est",
    "hotel_sample": "hotel_sample",
}


def create_views(spark: SparkSession, folder: str, start, end) -> None:
    """Makes the stored tables, and the grid over them, available to `spark.sql`. `hotel` is the
    dense grid, computed when asked for; `hotel_dense` has its priced cells only."""
    for view, (table, schema) in RAW_VIEWS.items():
        read_table(spark, f"{folder}/{table}", schema).createOrReplaceTempView(view)
    for view, table in VIEWS.items():
        spark.read.parquet(f"{folder}/{table}").createOrReplaceTempView(view)
    quotes = spark.table("hotel_cash"), spark.table("hotel_points")
    grid.dense_grid(*quotes, start, end).createOrReplaceTempView("hotel")
    grid.observed_cells(*quotes, start, end).createOrReplaceTempView("hotel_dense")
