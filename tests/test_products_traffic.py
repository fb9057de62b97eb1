import datetime as dt

from clickflow.operators import products as prod
from clickflow.operators import traffic as tr
from click_util import rows

ACT = "date date, city_id long, click_product_id long"
CITY = "city_id int, city_name string, area string"
PROD = "product_id long, product_name string, extend_info string"


def test_area_top3_hand_built(spark):
    d = dt.date(2024, 1, 5)
    acts = spark.createDataFrame(
        [(d, 1, 10)] * 3 + [(d, 2, 10)] + [(d, 1, 11)] * 2 + [(d, 2, 12)] * 2 + [(d, 1, 13)] * 2   # 11/12/13 tie
        + [(d, 1, 14)] + [(d, 99, 10)] * 5                      # unknown city dropped
        + [(d, 1, 77)] * 9                                      # unknown product dropped
        + [(d, 3, 20)] + [(d, 1, None)] + [(dt.date(2024, 2, 1), 1, 10)] * 9,  # null product, out of range
        ACT)
    cities = spark.createDataFrame([(1, "c1", "AFRICA"), (2, "c2", "AFRICA"), (3, "c3", "ANTARCTICA")], CITY)
    products = spark.createDataFrame([
        (10, "p10", '{"product_status": 0}'), (11, "p11", '{"product_status": 1}'), (12, "p12", "bad json"),
        (13, "p13", "{}"), (14, "p14", '{"product_status": "0"}'), (20, "p20", '{"product_status": 0}'),
    ], PROD)
    got = rows(prod.area_top3_products(acts, cities, products, "2024-01-01", "2024-01-31"))
    assert got == [
        ("AFRICA", "A", 10, 4, "1:c1,2:c2", "p10", "Self"),
        ("AFRICA", "A", 11, 2, "1:c1", "p11", "Third Party"),
        ("AFRICA", "A", 12, 2, "2:c2", "p12", "Third Party"),
        ("ANTARCTICA", "D", 20, 1, "3:c3", "p20", "Self"),
    ]


def test_pv_uv_by_hand(spark):
    """Two users in one hour, a user twice in one hour, hours without padding, one user on several sites and days."""
    lines = spark.createDataFrame([(x,) for x in [
        "shop,ann,2024-03-01 09:05:00", "shop,ben,2024-03-01 09:59:59",
        "shop,ann,2024-03-01 10:00:00", "shop,ann,2024-03-01 10:30:00", "shop,ben,2024-03-01 10:45:10",
        "news,ann,2024-03-01 00:00:01", "news,cyd,2024-03-02 23:10:00", "news,cyd,2024-03-03 23:10:00",
    ]], "value string")
    got = rows(tr.pv_uv(tr.parse_pv_lines(lines)))
    assert got == sorted([
        ("shop", "2024-03-01", "9", 2, 2), ("shop", "2024-03-01", "10", 3, 2), ("news", "2024-03-01", "0", 1, 1),
        ("news", "2024-03-02", "23", 1, 1), ("news", "2024-03-03", "23", 1, 1),
    ], key=lambda r: tuple((x is None, str(x)) for x in r))
    approx = rows(tr.pv_uv(tr.parse_pv_lines(lines), approx=True))
    assert approx == got


def test_global_top1(spark):
    df = spark.createDataFrame([(i,) for i in range(1, 11)], "v int").repartition(5)
    assert tr.global_top1(df, "v").first().v == 10
