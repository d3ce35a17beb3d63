import pytest
from compare import TESTDATA, compare, connect

from footfall.llm.oracle import oracle_sql
from footfall.llm.queries import queries

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize("name", oracle_sql())
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(SF_DIR), name, SF_DIR, queries()[name], oracle_sql()[name]) is None
