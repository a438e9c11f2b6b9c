import pytest

from claimscreen import queries as screening
from tests.oracle import assert_same

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", list(screening.queries()))
def test_matches_sql(spark, name):
    assert_same(screening.queries()[name](spark, SF), screening.oracle_sql()[name], SF)
