"""Staging: cleaning, de-duplication and product-code replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesmart.functions.intervals import with_day_blocks, with_interval_blocks
from salesmart.functions.ordering import ascending
from salesmart.functions.text import clean_str, empty_to_null
from salesmart.schemas import MONEY, STG_SALES, WEIGHTS

SALES_CLEANED = ("region", "chain_name", "sku_id", "product_group")
# The document, chain and customer codes are taken as they come.
SALES_KEPT = ("doc_id", "chain_id", "customer_id")


def cast_if_needed(df: DataFrame, name: str, kind: T.DataType) -> Column:
    """The column itself where it has the type already.

    A cast that does nothing leaves an alias behind, which can keep Spark from seeing
    that two branches of a plan compute the same exchange.
    """
    column = F.col(name)
    return column if df.schema[name].dataType == kind else column.cast(kind).alias(name)


def clean_sales(raw: DataFrame, empty_as_null: bool = False) -> DataFrame:
    """Typed sales with the descriptive columns stripped. Returns (qty < 0) stay.

    With ``empty_as_null`` empty strings become NULL, in the code columns too. Columns
    that ``raw`` lacks are left out.
    """
    strip = empty_to_null if empty_as_null else clean_str

    def column(name: str) -> Column:
        if name in SALES_CLEANED:
            return strip(name).alias(name)
        if name in SALES_KEPT:
            return F.nullif(F.col(name), F.lit("")).alias(name) if empty_as_null else F.col(name)
        return cast_if_needed(raw, name, STG_SALES[name].dataType)

    return raw.select(*[column(c) for c in STG_SALES.names if c in raw.columns])


# Total order of the rows of one document: by date, then by all that remains. A caller
# who drops columns from the end of this list keeps the same rows without them.
DOCUMENT_ORDER = (
    "date",
    "region",
    "chain_id",
    "chain_name",
    "product_group",
    "qty",
    "sku_id",
    "revenue_byn",
    "customer_id",
)


def document_order(sales: DataFrame) -> list[str]:
    return [c for c in DOCUMENT_ORDER if c in sales.columns]


def first_documents(sales: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """One row per doc_id: the earliest, ties by the remaining columns.

    Ranking with ``= 1`` lets Spark keep one row per document in each task before the
    shuffle, so a document repeated very often sends one row per task, not all.
    """
    by_doc = Window.partitionBy("doc_id").orderBy(*ascending(order or document_order(sales)))
    return (
        sales.withColumn("_rank", F.row_number().over(by_doc))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def duplicate_documents(sales: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """The rows that ``first_documents`` leaves out, copies included.

    Only rows of repeated documents are ranked, and in two steps: within (document,
    input task), then the first of each among themselves. No task gets more of one
    document than an input task held, or than there were input tasks.
    """
    order = ascending(order or document_order(sales))
    repeated = (
        sales.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").alias("r")
    )
    rows = (
        sales.withColumn("_task", F.spark_partition_id())
        .alias("s")
        .join(repeated, F.col("s.doc_id").eqNullSafe(F.col("r.doc_id")), "left_semi")
    )
    in_task = Window.partitionBy("doc_id", "_task").orderBy(*order)
    firsts_together = F.when(F.row_number().over(in_task) > 1, F.col("_task")).otherwise(-1)
    in_group = Window.partitionBy("doc_id", "_group").orderBy(*order)
    kept = (F.col("_group") == -1) & (F.col("_rank") == 1)
    return (
        rows.withColumn("_group", firsts_together)
        .withColumn("_rank", F.row_number().over(in_group))
        .filter(~kept)
        .drop("_task", "_group", "_rank")
    )


def replace_sku(sales: DataFrame, links: DataFrame) -> DataFrame:
    """Old product codes to current ones, whatever the validity dates.

    A code linked twice yields a row per link. The join side is left to the planner,
    which broadcasts the links only below ``spark.sql.autoBroadcastJoinThreshold``;
    above it AQE splits the partitions of codes that sell very often.
    """
    link = links.select(F.col("old_sku_id").alias("_old"), F.col("current_sku_id").alias("_new"))
    return (
        sales.join(link, F.col("sku_id") == F.col("_old"), "left")
        .withColumn("sku_id", F.coalesce("_new", "sku_id"))
        .drop("_old", "_new")
    )


def links_by_day(codes_and_days: DataFrame, links: DataFrame) -> DataFrame:
    """The link in force for each (sku_id, date) that has one: ``sku_id, date, _new``.

    A link is in force from valid_from to valid_to, both included, without end where
    valid_to is NULL. Of several, the one that starts last wins, then the one that
    ends last, then the greater code.
    """
    in_force = F.struct(
        F.col("valid_from"),
        F.coalesce("valid_to", F.lit("9999-12-31").cast("date")).alias("valid_to"),
        F.col("current_sku_id"),
    )
    blocks = (
        with_interval_blocks(links, F.col("valid_from"), F.col("valid_to"))
        .groupBy(F.col("old_sku_id").alias("sku_id"), "level", "block")
        .agg(F.max(in_force).alias("_link"))
    )
    old_codes = links.select(F.col("old_sku_id").alias("sku_id"))
    asked = codes_and_days.join(old_codes, "sku_id", "left_semi").distinct()
    return (
        with_day_blocks(asked, F.col("date"))
        .join(blocks, ["sku_id", "level", "block"])
        .groupBy("sku_id", "date")
        .agg(F.max("_link").alias("_link"))
        .select("sku_id", "date", F.col("_link.current_sku_id").alias("_new"))
    )


def replace_sku_asof(
    sales: DataFrame, links: DataFrame, codes_and_days: DataFrame | None = None
) -> DataFrame:
    """Old product codes to the ones in force on the day of the sale; one row each.

    The links are resolved once per distinct (code, day) and joined back by equality.
    ``codes_and_days`` may hold more pairs than ``sales`` does: give the sales before
    de-duplication to spare computing that twice.
    """
    asked = (sales if codes_and_days is None else codes_and_days).select("sku_id", "date")
    return (
        sales.join(links_by_day(asked, links), ["sku_id", "date"], "left")
        .withColumn("sku_id", F.coalesce("_new", "sku_id"))
        .select(*sales.columns)
    )


def stg_sales(raw: DataFrame, links: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """One cleaned row per document, with the current product code.

    Rows are ranked as they come and only the kept ones cleaned, after the shuffle.
    """
    return replace_sku(clean_sales(first_documents(raw, order)), links)


def stg_sku_links(raw: DataFrame) -> DataFrame:
    return raw.select(
        clean_str("old_sku_id").alias("old_sku_id"),
        clean_str("current_sku_id").alias("current_sku_id"),
        "valid_from",
        "valid_to",
    )


def stg_plan(raw: DataFrame, with_chain_name: bool = False) -> DataFrame:
    """Monthly plan, its month as the first day; quantities and weights are 32-bit."""
    names = [clean_str("chain_name").alias("chain_name")] if with_chain_name else []
    return raw.select(
        clean_str("chain_id").alias("chain_id"),
        clean_str("region").alias("region"),
        clean_str("product_group").alias("product_group"),
        F.concat("month", F.lit("-01")).cast("date").alias("plan_month"),
        F.col("plan_qty").cast("float").alias("plan_qty"),
        *[F.col(w).cast("float").alias(w) for w in WEIGHTS],
        *names,
    )


def stg_stock_movements(raw: DataFrame) -> DataFrame:
    return raw.select(
        cast_if_needed(raw, "date", T.DateType()),
        *[
            clean_str(c).alias(c)
            for c in ("warehouse_id", "warehouse_name", "sku_id", "operation_type")
        ],
        cast_if_needed(raw, "qty", MONEY),
        cast_if_needed(raw, "unit_cost_byn", MONEY),
    )
