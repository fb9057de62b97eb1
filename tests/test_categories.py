from clickflow.operators import categories as cat
from click_util import rows

SCHEMA = ("session_id string, click_category_id long, order_category_ids array<bigint>, "
          "pay_category_ids array<bigint>")


def _actions(spark):
    return spark.createDataFrame([
        ("s1", 1, None, None),          # clicked only: 1
        ("s1", None, [2, 2], None),     # ordered only: 2 (twice in one list)
        ("s2", None, None, [3]),        # paid only: 3
        ("s2", 4, [4], [4]),            # 4 all kinds
        ("s3", 5, [5], [5]),            # 5 ties with 4 on all counts
        ("s3", 12, [None], None),       # 12; null id in a list is skipped
        ("s1", 12, None, None),
    ], SCHEMA)


def test_counts_single_pass_equals_join_form(spark):
    a = _actions(spark)
    one = rows(cat.category_counts(a))
    assert one == rows(cat.category_counts_by_join(a))
    assert one == [(1, 1, 0, 0), (12, 2, 0, 0), (2, 0, 2, 0), (3, 0, 0, 1), (4, 1, 1, 1), (5, 1, 1, 1)]
    assert sorted(r.category_id for r in cat.visited_categories(a).collect()) == [1, 2, 3, 4, 5, 12]


def test_top_categories_order_and_ties(spark):
    top = [r.category_id for r in cat.top_categories(cat.category_counts(_actions(spark)), 4).collect()]
    assert top == [12, 4, 5, 1]


def test_top_sessions_per_category(spark):
    a = spark.createDataFrame(
        [("s%d" % i, 7, None, None) for i in range(12) for _ in range(i % 4 + 1)] + [("s1", 8, None, None)], SCHEMA)
    top = cat.top_categories(cat.category_counts(a), 1)  # category 7 only
    got = cat.top_sessions_per_category(a, top, 3).collect()
    # ties on the count are broken by session_id ascending
    assert sorted((r.category_id, r.session_id, r.click_count) for r in got) == \
        [(7, "s11", 4), (7, "s3", 4), (7, "s7", 4)]
