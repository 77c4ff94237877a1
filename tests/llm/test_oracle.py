import os

import pytest

from storelake.llm.queries import ORACLE, QUERIES
from tests.compare import connect, difference

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF_DIR), ORACLE[name], connect(SF_DIR)) is None
