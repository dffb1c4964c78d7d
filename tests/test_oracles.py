"""Every query of the engine's own operators against its SQL, over whole small tables."""

import pytest

from oracle import differ
from terraloom import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    if name in queries.ORACLES:
        assert not differ(spark, queries.QUERIES[name], queries.ORACLES[name], SF)
    else:
        assert queries.QUERIES[name](spark, SF).count() > 0
