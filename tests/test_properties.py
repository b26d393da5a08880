
from __future__ import annotations

import pytest

from lotwise.params import RunWindow
from lotwise.plans.daily import daily_datasets

KEY = ["LOT_ID", "TESTER_ID", "LOT_QTY", "date_time_local"]


@pytest.fixture(scope="module")
def datasets(log01):
    ds = daily_datasets(log01, RunWindow.daily("2024-02-03"), cache=True)
    yield ds
    ds.release()


def test_variance_keys_subset_of_totallot(datasets):
    missing = datasets.variance.select(KEY).subtract(datasets.totallot.select(KEY))
    assert missing.count() == 0


def test_outputs_are_distinct(datasets):
    for df in (datasets.variance, datasets.totallot):
        assert df.count() == df.distinct().count()


def test_rerun_is_identical(log01, datasets):
    again = daily_datasets(log01, RunWindow.daily("2024-02-03"), cache=False)
    assert again.variance.exceptAll(datasets.variance).count() == 0
    assert datasets.variance.exceptAll(again.variance).count() == 0
    assert again.totallot.exceptAll(datasets.totallot).count() == 0


def test_layouts(datasets):
    from lotwise.schemas import TOTALLOT_COLUMNS, VARIANCE_COLUMNS

    assert tuple(datasets.variance.columns) == VARIANCE_COLUMNS
    assert tuple(datasets.totallot.columns) == TOTALLOT_COLUMNS
    assert all(t == "string" for _, t in datasets.variance.dtypes)
