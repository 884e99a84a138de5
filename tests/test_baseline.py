"""The pandas stand-in of the bench gives the rows of the queries that it is timed against."""

from pathlib import Path

import pandas as pd
import pytest

import pandas_baseline
from atomweft.plans import catalogue

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(pandas_baseline.QUERIES))
def test_stand_in(spark, name):
    got, want = pandas_baseline.QUERIES[name](str(DATA)), catalogue.queries()[name](spark, str(DATA)).toPandas()
    names = sorted(want.columns)
    got, want = (x[names].sort_values(names).reset_index(drop=True) for x in (got, want))
    pd.testing.assert_frame_equal(got, want, check_dtype=False, rtol=1e-9)
