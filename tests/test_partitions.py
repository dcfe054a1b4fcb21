"""Same result with 1 and 8 shuffle partitions (and input split in 1 or many pieces)."""

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.oracle_check import rows_of

NAMES = ["pipe_next_product", "join_asof_snapshot", "win_gini_norm", "agg_group_median", "win_fold_stratified",
         "join_knn", "spe_regrid", "set_update"]


@pytest.mark.parametrize("name", NAMES)
def test_partition_invariance(spark, name):
    q = E.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = q(spark, SF_SMALL)
            results.append(rows_of(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1]
