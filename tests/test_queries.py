import os

import pytest

from chunksink import queries
from tests.oracle import SF_DIR, compare


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_equals_its_sql(spark, name):
    compare(spark, queries.QUERIES[name], queries.ORACLES[name])
