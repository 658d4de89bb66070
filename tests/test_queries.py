import pytest

from tests.conftest import compare
from tessera.plans import catalog


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_sql(spark, name):
    compare(spark, name)


def test_entry(spark):
    import __spark_entry__

    df = __spark_entry__.entry(spark)
    assert df.count() > 1000 and set(df.columns) == {"x", "y", "walk_mask", "RegionID"}


def test_dependency_hash_changes_with_a_leaf(spark):
    from tessera.operators.graph import dependency_hash

    e = spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "d")], "src string, dst string")
    of = lambda leaf: {r.node: r.hash for r in dependency_hash(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", leaf)], "node string, hash long"), e).collect()}
    x, y = of(4), of(5)
    assert [k for k in "abcd" if x[k] != y[k]] == ["a", "b", "d"]


def test_dependency_cycle_stops(spark):
    from tessera.operators.graph import dependency_hash

    e = spark.createDataFrame([("a", "b"), ("b", "a")], "src string, dst string")
    with pytest.raises(ValueError):
        dependency_hash(spark.createDataFrame([("a", 1), ("b", 2)], "node string, hash long"), e, levels=3)
