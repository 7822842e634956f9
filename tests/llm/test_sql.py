"""The package's queries against SQL, and what the registry holds."""

from __future__ import annotations

import pytest
from helpers import SF, same_rows

from docmill.llm import queries



@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_matches_sql(spark, name):
    same_rows(queries.QUERIES[name](spark, SF), queries.SQL[name])


def test_a_query_for_each_operator():
    assert sorted(int(n.split("_")[0][2:]) for n in queries.QUERIES) == [*range(1, 14)]


def test_native_plans_hold_no_python(spark):
    for name in ("op5_poisson_mix", "op10_feistel_pseudonyms", "op12_license_scan"):
        plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "ExistingRDD"))
