"""Property: the salted skew join returns exactly the plain left join."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from eventmart.operators.joins import skew_left_join
from tests.conftest import rows

keys = st.one_of(st.none(), st.integers(min_value=0, max_value=4))


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(fact_keys=st.lists(keys, min_size=0, max_size=40),
       dim_keys=st.lists(st.integers(min_value=0, max_value=5), min_size=0, max_size=8),
       parts=st.integers(min_value=1, max_value=6))
def test_salted_join_equals_plain_join(spark, fact_keys, dim_keys, parts):
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(fact_keys)], "id bigint, k bigint")
    dim = spark.createDataFrame([(k, f"d{j}") for j, k in enumerate(dim_keys)],
                                "dk bigint, name string")
    salted = skew_left_join(fact, dim, "k", "dk", max_rows=0, partitions=parts)
    plain = fact.join(dim, fact["k"] == dim["dk"], "left")
    assert salted.columns == plain.columns
    assert rows(salted) == rows(plain)


def test_salted_join_with_a_map_column(spark):
    fact = spark.createDataFrame([(1, {"a": 1}), (1, {"b": 2}), (None, {})],
                                 "k bigint, props map<string,int>")
    dim = spark.createDataFrame([(1, "one")], "dk bigint, name string")
    out = skew_left_join(fact, dim, "k", "dk", max_rows=0, partitions=2)
    assert rows(out, "k", "name") == [(1, "one"), (1, "one"), (None, None)]
