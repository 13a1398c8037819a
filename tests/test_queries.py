"""Every registered query against its SQL."""

import pytest
from compare import assert_same

from tidewell.queries.all import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    df = QUERIES[name](spark, small)
    if name in ORACLES:
        assert_same(df, ORACLES[name], small)
    else:
        assert df.count() > 0
