import datetime as dt

from shopmetrics import schema as S
from shopmetrics.operators import silver as SV

from conftest import rows


def bronze(spark, data):
    return spark.createDataFrame(data, S.BRONZE_SCHEMA)


def rec(pid, price=10.0, rating=3.0, reviews=10, stock=10, sales=5.0, disc=10, date="2024-03-01",
        city="Oslo", ts="2024-01-01T00:00:00", name=" n ", cat=" home "):
    return (pid, name, cat, price, rating, reviews, stock, sales, disc, date, city, True, ts)


def test_dedupe_latest_wins(spark):
    df = bronze(spark, [rec(1, price=1.0, ts="2024-01-01T00:00:00"), rec(1, price=2.0, ts="2024-01-02T00:00:00"),
                        rec(2, price=3.0), rec(None, price=4.0), rec(None, price=5.0)])
    out = {r.ProductID: r.Price for r in SV.latest_per_product(df).collect()}
    assert out == {1: 2.0, 2: 3.0, None: 5.0}


def test_dedupe_ties_broken_by_other_columns(spark):
    df = bronze(spark, [rec(1, price=1.0), rec(1, price=9.0), rec(1, price=3.0)])
    assert SV.latest_per_product(df).first().Price == 9.0


def test_rules_boundaries(spark):
    data = [
        rec(1, sales=-1.0, disc=0, price=500.0, rating=1.0, reviews=5000, stock=1000),
        rec(2, sales=0.0, disc=50, price=500.01, rating=0.99, reviews=5001, stock=1001),
        rec(3, sales=1.0, disc=51, price=-0.01, rating=5.0, reviews=-1, stock=-1),
        rec(4, sales=1.5, disc=100, price=0.0, rating=5.01),
        rec(5, disc=101), rec(6, disc=150), rec(7, disc=6000), rec(8, disc=-5),
        rec(9, date="n/a", city="St. John 3"), rec(10, price=19.995, city="São_Paulo!"),
    ]
    out = {r.ProductID: r for r in SV.clean_products(SV.latest_per_product(bronze(spark, data))).collect()}
    assert [out[i].Sales for i in (1, 2, 3, 4)] == [0.0, 0.0, 1000.0, 1.5]
    assert [out[i].Discount for i in range(1, 9)] == [0.0, 50.0, 50.0, 50.0, 1.01, 1.5, 60.0, 0.0]
    assert out[1].Price == 500.0 and out[2].Price is None and out[3].Price is None and out[4].Price == 0.0
    assert out[1].Rating == 1.0 and out[2].Rating is None and out[3].Rating == 5.0 and out[4].Rating is None
    assert (out[1].NumReviews, out[2].NumReviews, out[3].NumReviews) == (5000, None, 0)
    assert (out[1].StockQuantity, out[2].StockQuantity, out[3].StockQuantity) == (1000, None, 0)
    assert out[9].DateAdded is None and out[9].Year is None and out[9].Month is None
    assert out[1].DateAdded == dt.date(2024, 3, 1) and (out[1].Year, out[1].Month) == (2024, 3)
    assert out[9].City == "St John" and out[10].City == "SoPaulo"
    assert out[1].Category == "HOME" and out[1].ProductName == "n"
    assert abs(out[10].Price - 20.0) < 1e-6


def test_silver_types(spark):
    out = SV.clean_products(bronze(spark, [rec(1)]))
    types = dict(out.dtypes)
    assert types["Price"] == "float" and types["Rating"] == "float" and types["Discount"] == "double"
    assert types["DateAdded"] == "date" and types["Year"] == "int"


def test_nulls_everywhere_pass_through(spark):
    df = bronze(spark, [(1,) + (None,) * 12])
    r = SV.build_silver(df).first()
    assert r.ProductID == 1 and r.Price is None and r.Sales is None and r.Discount is None and r.City is None


def test_scaling_sample_std_and_zero(spark):
    df = bronze(spark, [rec(1, price=1.0, rating=3.0), rec(2, price=3.0, rating=3.0), rec(3, price=None)])
    out = {r.ProductID: r for r in SV.scale_columns(SV.clean_products(df)).collect()}
    sd = 2 ** 0.5  # sample std of (1, 3)
    assert abs(out[1].scaled_Price - 1 / sd) < 1e-9 and abs(out[2].scaled_Price - 3 / sd) < 1e-9
    assert out[3].scaled_Price is None
    assert out[1].scaled_Rating == 0.0  # constant column


def test_vectors(spark):
    df = SV.build_silver(bronze(spark, [rec(1), rec(2, price=20.0)]), vectors=True)
    r = df.orderBy("ProductID").first()
    assert len(r.features) == 5 and len(r.scaled_features) == 5


def test_dedupe_unique_keys_and_partition_invariance(spark):
    data = [rec(i % 7, price=float(i), ts=f"2024-01-{1 + i % 28:02d}T00:00:00") for i in range(200)]
    a = SV.build_silver(bronze(spark, data).repartition(1))
    b = SV.build_silver(bronze(spark, data).repartition(8))
    assert a.count() == a.select("ProductID").distinct().count() == 7
    assert sorted(rows(a)) == sorted(rows(b))
