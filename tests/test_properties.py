"""Property checks on random bronze rows (hypothesis): ranges, unique keys, counts."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from shopmetrics import schema as S
from shopmetrics.operators import gold as G
from shopmetrics.operators import silver as SV

ints = st.one_of(st.none(), st.integers(min_value=-2**31, max_value=2**31 - 1))
small = st.one_of(st.none(), st.integers(min_value=-20, max_value=7000))
reals = st.one_of(st.none(), st.floats(min_value=-1e4, max_value=1e4, allow_nan=False))
text = st.one_of(st.none(), st.text(alphabet=" abcXYZ_!3.", max_size=8))
dates = st.one_of(st.none(), st.sampled_from(["2024-02-29", "2023-02-29", "n/a", "2024-13-01", "2024-1-5", ""]))
row = st.tuples(st.one_of(st.none(), st.integers(0, 20)), text, st.sampled_from([" a ", "b", None]),
                reals, reals, small, small, reals, st.one_of(small, ints), dates, text,
                st.one_of(st.none(), st.booleans()), st.sampled_from(["2024-01-01T00:00:00", "2024-01-02T00:00:00", None]))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=0, max_size=40))
def test_silver_ranges_keys_and_counts(spark, rows):
    bronze = spark.createDataFrame(rows, S.BRONZE_SCHEMA)
    silver = SV.build_silver(bronze)
    out = silver.collect()
    keys = [r.ProductID for r in out]
    assert len(keys) == len(set(keys)) == len({r[0] for r in rows})
    for r in out:
        assert r.Price is None or 0 <= r.Price <= 500
        assert r.Rating is None or 1.0 <= r.Rating <= 5.0
        assert r.NumReviews is None or 0 <= r.NumReviews <= 5000
        assert r.StockQuantity is None or 0 <= r.StockQuantity <= 1000
        assert r.Sales is None or r.Sales >= 0
        assert r.Discount is None or r.Discount >= 0
        assert (r.Year is None) == (r.DateAdded is None)
    stats = G.category_stats(silver).collect()
    assert sum(s._count for s in stats) == len(out)
