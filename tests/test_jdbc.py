import pytest

from parcelflow.sources.jdbc import scan_jdbc


def test_partitioned_jdbc_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        scan_jdbc(spark, "jdbc:postgresql://db/fleet", "SELECT 1 AS x", partition_column="x")
    with pytest.raises(ValueError):
        scan_jdbc(spark, "jdbc:postgresql://db/fleet", "SELECT 1 AS x", partition_column="x",
                  lower_bound=0, upper_bound=10)
