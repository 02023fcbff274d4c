import sys

import pytest

import __spark_entry__ as entry

sys.path.insert(0, "tools")
from tools.check_oracles import connect, difference  # noqa: E402

from conftest import SMALL

# Checked here on the smallest tables; tools/check_oracles.py runs all queries.
SAMPLE = (
    "c1_trim_outliers", "d1_sample_n", "e8_median_by_weekday_city", "f2_average_rank", "f4_zscore_by_quarter",
    "h8_metrics_by_split", "i1_rfm_city", "i7_features_v1_fit_apply", "j2_split_histogram", "j3_train_gbt",
    "j5_train_interval", "k3_validate_requests",
)


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10 and [r["score"] for r in rows] == sorted((r["score"] for r in rows), reverse=True)


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_its_sql(spark, name):
    got = entry.queries()[name](spark, SMALL).toPandas()
    problem = difference(got, connect(SMALL).execute(entry.oracle_sql()[name]).df())
    assert problem is None


def test_types_count_as_differences():
    import pandas as pd

    whole, real = pd.DataFrame({"a": [1, 2]}), pd.DataFrame({"a": [1.0, 2.0]})
    assert difference(whole, real).startswith("types") and difference(whole, whole) is None
    assert difference(pd.DataFrame({"a": [1.0, None]}), pd.DataFrame({"a": pd.array([1, None], "Int64")})) is None


@pytest.mark.parametrize("module", ["public_tokenizers", "xxhash", "regex"])
def test_entry_survives_a_missing_module_of_the_corpus_part(module):
    import subprocess

    code = f"import sys; sys.modules[{module!r}] = None; import __spark_entry__ as e; print(len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and int(done.stdout.split()[-1]) >= 100
