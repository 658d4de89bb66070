import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def compare(spark, name, sf_dir="/root/testdata/sf0.001"):
    """Runs a query and its SQL in DuckDB on the same tables; the rows must be equal."""
    import glob

    import duckdb
    import pandas as pd

    import __spark_entry__

    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    cell = lambda v: "~" if pd.isna(v) else str(v) if isinstance(v, (bool, str)) or "bool" in str(type(v)) else round(float(v), 4) if isinstance(v, (int, float)) or "numpy" in str(type(v)) else str(v)
    rows = lambda df: sorted((tuple(map(cell, r)) for r in df[sorted(df.columns)].itertuples(index=False, name=None)), key=str)
    a, b = __spark_entry__.queries()[name](spark, sf_dir).toPandas(), con.execute(__spark_entry__.oracle_sql()[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a) == rows(b)
