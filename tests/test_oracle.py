"""Every query against its SQL, and the model queries for their shape."""

import importlib
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from tests.conftest import TESTDATA
from tests.oracle_check import compare, connect

from tagloom.plans.oracle import SQL
from tagloom.plans.queries import QUERIES

SF = str(TESTDATA / "sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    assert set(QUERIES) - set(SQL) == {
        "als_rmse",
        "als_favor_products",
        "als_favor_brands",
        "als_brand_histogram",
        "als_favor_types",
        "rfm_segments",
    }


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, con, name):
    count, difference = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert difference is None
    assert count > 0


def test_entry(spark):
    entry = importlib.import_module("__spark_entry__")
    profile = entry.entry(spark)
    assert profile.columns[:2] == ["id", "gender"]
    assert profile.count() > 0
    assert profile.count() == profile.select("id").distinct().count()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_model_queries(spark, name):
    found = QUERIES[name](spark, SF)
    assert found.count() > 0
    if "id" in found.columns:
        assert found.count() == found.select("id").distinct().count()
    if name == "als_rmse":
        row = found.collect()[0]
        assert row.predictions > 0 and 0 < row.rmse < 100


@pytest.mark.parametrize("pipeline_too", [False, True])
def test_the_rest_loads_without_the_training_data_folders(tmp_path, pipeline_too):
    root = Path(__file__).resolve().parent.parent
    shutil.copytree(root / "tagloom", tmp_path / "tagloom", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    for name in ["__spark_entry__.py"] + ["corpus_pipeline.py"] * (not pipeline_too):
        if (root / name).exists():
            shutil.copy(root / name, tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True)
    assert done.stdout.split() == [str(len(QUERIES)), "True"], done.stderr
