"""Files that filters on either column of a clustered table can skip."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from salesmart.operators.curve import curve_position
from salesmart.sinks.warehouse import Warehouse, differing_rows

FILES = 16


def rows(spark):
    n = F.col("id")
    return spark.range(20_000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (n % 366).cast("int")).alias("date"),
        F.concat(F.lit("REGION_OF_"), F.element_at(F.array(*map(F.lit, ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE"))), (F.hash(n) % 5 + 5) % 5 + 1)).alias("region"),
        n.alias("qty"),
    )


def read_for(folder, column, first, last):
    """Files whose bounds in the footer do not rule the filter out."""
    hit = 0
    for path in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        at = [meta.row_group(0).column(i).path_in_schema for i in range(meta.num_columns)].index(column)
        bounds = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
        hit += any(str(b.min) <= last and first <= str(b.max) for b in bounds)
    return hit


def test_both_filters_skip_files(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    df = rows(spark)
    store.replace("mart", "plain", df, order=["date", "region"], files=FILES)
    out = store.replace("mart", "laid", df, order=["date", "region"], cluster=["region", "date"], files=FILES)
    assert out.columns == df.columns and differing_rows(out, df).isEmpty()
    asked = {"region": ("REGION_OF_ASIA", "REGION_OF_ASIA"), "date": ("2024-01-01", "2024-01-07")}
    plain, laid = ({c: read_for(store.path("mart", t), c, *asked[c]) for c in asked} for t in ("plain", "laid"))
    assert plain["region"] == FILES and laid["region"] <= FILES // 2
    assert laid["date"] <= FILES // 2


def test_months_may_be_clustered(spark, tmp_path):
    store = Warehouse(spark, str(tmp_path))
    df = rows(spark)
    out = store.replace("mart", "laid", df, by_month_of="date", cluster=["region", "date"])
    assert differing_rows(out, df).isEmpty() and store.written["laid"] == 20_000


def test_any_column_with_an_order(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (NULL, NULL, NULL, ''), (1.5, TIMESTAMP '2024-01-01 00:00:00', 'é', 'a'),"
        "(1.5, TIMESTAMP '2024-01-02 00:00:00', '', NULL), (-2.0, NULL, 'zz', 'b') AS t(x, at, s, e)"
    )
    found = df.select(curve_position(df, ["x", "at", "s", "e"]).alias("p")).collect()
    assert all(r.p is not None and 0 <= r.p < 1 << 20 for r in found)
    empty = df.filter("x > 9")
    assert empty.select(curve_position(empty, ["x", "s"])).count() == 0
    with pytest.raises(TypeError):
        curve_position(spark.sql("SELECT array(1) AS a"), ["a"])
