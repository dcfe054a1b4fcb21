"""Force every key to be 'hot' (slices of a few rows) and check the queries built on ordered
scans still match their oracles exactly."""

import duckdb
import pytest

import __spark_entry__ as E
import quarry.operators.sequence as seq
from quarry.sources.tables import TABLES
from tests.conftest import SF_SMALL
from tools.oracle_check import rows_of

NAMES = ["pipe_next_product", "join_asof_snapshot", "join_asof_snapshot_inclusive", "win_gini_norm", "win_gini_by_group",
         "win_cumsum", "win_cumsum_global", "win_diff_new", "win_skip_head", "win_epoch", "win_fold_contiguous",
         "win_fold_stratified", "win_batch", "agg_group_median", "agg_mean_median", "prj_holdout_tail", "spe_regrid",
         "vox_stack", "join_fk_index", "join_group_stat"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_hot_path_matches_oracle(spark, con, name, monkeypatch):
    monkeypatch.setattr(seq, "SLICE_ROWS", 5)
    sdf = E.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    res = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert rows_of(sdf.columns, srows) == rows_of(dcols, res.fetchall())
