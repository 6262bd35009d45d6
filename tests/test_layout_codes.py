import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fleetmart.operators import curve
from fleetmart.plans import rules
from fleetmart.session import run_dir


def kept_groups(path, column, low, high):
    """(row groups that may hold a value between low and high, all)."""
    kept = total = 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            total += 1
            kept += s is None or not s.has_min_max or (s.max >= low and s.min <= high)
    return kept, total


def test_a_filter_on_any_column_skips_most_row_groups(spark):
    n = 40_000
    df = spark.range(n).select(
        ((F.col("id") * 7919) % n).alias("a"), ((F.col("id") * 104729 + 7) % n).cast("double").alias("b"), F.lpad(((F.col("id") * 1299709) % n).cast("string"), 6, "0").alias("c"), F.col("id"),
    )
    path = run_dir(spark, "curve")
    curve.write_curve(df, path, ["a", "b", "c"], rows_per_file=600)
    assert spark.read.parquet(path).agg(F.count("*"), F.count_distinct("id")).first() == (n, n)
    for column, low, high in (("a", 100, 1500), ("b", 20_000.0, 21_500.0), ("c", "030000", "031500")):
        kept, total = kept_groups(path, column, low, high)
        assert total > 50 and kept < total / 2


def test_curve_of_nulls_few_values_and_other_types(spark):
    df = spark.createDataFrame([(None, None, None, None), (True, "x", None, 1.5), (False, "", None, float("nan")), (True, "é", None, -2.0)], "f boolean, s string, d date, x double")
    path = run_dir(spark, "curve")
    curve.write_curve(df, path, ["f", "s", "d", "x"])
    assert spark.read.parquet(path).count() == 4
    curve.write_curve(df.limit(0), run_dir(spark, "curve"), ["f"])
    with pytest.raises(ValueError):
        curve.curve_position(df, [])


def test_codes_of_seven_digits(spark):
    codes = ["RIDE-19960102-1000003", "RIDE-19960102-000009", "RIDE-19960102-999999", "RIDE-1996-1", None]
    df = spark.createDataFrame([(c,) for c in codes], "ride_code string")
    assert rules.max_ride_sequence_any_length(df).first()[0] == 1_000_003 and rules.max_ride_sequence_any_length(df.limit(0)).first()[0] == 0
    got = [r[0] for r in df.select(rules.code_after(F.col("ride_code"), F.lit(1))).collect()]
    assert got == ["RIDE-19960102-1000004", "RIDE-19960102-000010", "RIDE-19960102-1000000", None, None]
