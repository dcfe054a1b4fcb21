"""Every registered query runs on empty tables of the same schemas; model fits refuse an empty
training table with one clear error."""

import os
import tempfile

import pytest

import __spark_entry__ as E
from quarry.operators.ml import EmptyTraining
from quarry.sources.tables import TABLES
from tests.conftest import SF_SMALL

MODEL_FITS = {"fe_fill_tree", "ml_base_unused", "ml_boost_clf", "ml_boost_custom", "ml_boost_multi", "ml_boost_reg",
              "ml_coef_rank", "ml_compare", "ml_fold_average", "ml_fold_report", "ml_forest", "ml_grid_cv", "ml_linear_svc", "ml_logreg",
              "ml_logreg_cv", "ml_mlp_top", "ml_naive_bayes", "ml_rbf_svc", "ml_segmented", "ml_stack", "pipe_claims",
              "udf_callbacks", "pipe_next_product_rank"}


@pytest.fixture(scope="module")
def empty_dir(spark):
    d = tempfile.mkdtemp(prefix="quarry-empty-")
    for t in TABLES:
        spark.read.parquet(os.path.join(SF_SMALL, f"{t}.parquet")).limit(0).write.mode("overwrite").parquet(
            os.path.join(d, f"{t}.parquet"))
    return d


@pytest.mark.parametrize("name", sorted(set(E.queries()) - MODEL_FITS))
def test_runs_on_empty_tables(spark, empty_dir, name):
    rows = E.queries()[name](spark, empty_dir).collect()
    assert isinstance(rows, list)


@pytest.mark.parametrize("name", ["ml_logreg", "ml_boost_reg", "ml_forest"])
def test_model_fit_refuses_empty(spark, empty_dir, name):
    with pytest.raises(Exception) as e:
        E.queries()[name](spark, empty_dir).collect()
    assert isinstance(e.value, EmptyTraining) or "empty" in str(e.value).lower()
