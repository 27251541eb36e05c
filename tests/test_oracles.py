"""Every registered query of the reference's operators against its SQL twin."""

from __future__ import annotations

import pytest
from compare import duck_rows, spark_rows

from trailmark.plans import oracles, registry

SF = "/root/testdata/sf0.001"


def test_every_query_has_a_twin():
    assert set(registry.queries()) == set(oracles.oracles())


@pytest.mark.parametrize("name", sorted(registry.PLANS))
def test_query_equals_its_twin(spark, name):
    names, rows = spark_rows(registry.queries()[name](spark, SF))
    assert (names, rows) == duck_rows(oracles.oracles()[name], SF)
