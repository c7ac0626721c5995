"""Property tests: eager aggregation + distributed rank equal the literal SQL on random inputs."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests import naive
from tests.test_gold import DEST_SCHEMA, FACT_SCHEMA, USER_SCHEMA
from traveltiers.operators import gold

BASE = datetime(2024, 1, 1)

fact_row = st.tuples(
    st.integers(0, 5),                      # user
    st.integers(0, 4),                      # destination
    st.booleans(), st.booleans(),           # clicked, purchased
    st.one_of(st.none(), st.integers(0, 600000).map(lambda c: c / 100)),  # price (cents-exact)
    st.integers(0, 90),                     # day offset
)
dest_row = st.tuples(st.integers(0, 6), st.sampled_from(["A", "B"]))
user_row = st.tuples(st.integers(0, 7), st.sampled_from(["budget", "premium"]))


def build(spark, facts, dests, users):
    f = [(i, BASE + timedelta(days=d), u, k, c, p, price, 2024, 1, "weekday")
         for i, (u, k, c, p, price, d) in enumerate(facts)]
    fact = spark.createDataFrame(f, FACT_SCHEMA)
    dest = spark.createDataFrame([(k, n, 1.0, 2.0, "Northern") for k, n in dests], DEST_SCHEMA)
    user = spark.createDataFrame([(k, "low_frequency", s, 0.0, 0, None, None) for k, s in users], USER_SCHEMA)
    return fact, dest, user


def same(a, b):
    cols = b.columns
    a, b = a.select(*cols), b.select(*cols)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(fact_row, min_size=0, max_size=40), st.lists(dest_row, min_size=1, max_size=8),
       st.lists(user_row, min_size=1, max_size=8))
def test_eager_aggregation_and_rank_equal_literal(spark, facts, dests, users):
    fact, dest, user = build(spark, facts, dests, users)
    lit_d = naive.destinations(dest, fact)
    ours_d = gold.gold_destination_performance(dest, fact)
    assert same(ours_d, lit_d)
    lit_u = naive.users(user, fact)
    assert same(gold.gold_user_engagement(user, fact), lit_u)
