"""Spark SQL over the registered version, feed and history views of the scripted orders."""

from verlog.plans.history import orders_history
from verlog.sources.views import register

SF = "/root/testdata/sf0.001"


def test_views_agree_with_the_table(spark):
    t = orders_history(spark, SF)
    register(t, "order_views", versions=[2, 5], changes_from=2)
    for name, frame in (("order_views", t.current()), ("order_views_v2", t.as_of(2)), ("order_views_v5", t.as_of(5))):
        want = {(r.order_id, r.status, r.total) for r in frame.collect()}
        got = spark.sql(f"SELECT order_id, status, total FROM {name}").collect()
        assert {tuple(r) for r in got} == want and len(got) == len(want)


def test_feed_explains_the_difference(spark):
    """Rows of version 2, plus inserts and less deletes of later versions, are the rows of now."""
    t = orders_history(spark, SF)
    register(t, "order_views", versions=[2], changes_from=3)
    balance = spark.sql("""
        SELECT (SELECT count(*) FROM order_views_v2)
             + (SELECT count_if(_change_type = 'insert') - count_if(_change_type = 'delete') FROM order_views_changes) AS rows,
               (SELECT sum(total) FROM order_views_v2)
             + (SELECT sum(CASE _change_type WHEN 'insert' THEN total WHEN 'update_postimage' THEN total ELSE -total END)
                FROM order_views_changes) AS total""").first()
    now = spark.sql("SELECT count(*) AS rows, sum(total) AS total FROM order_views").first()
    assert tuple(balance) == tuple(now)


def test_history_counts_the_feed(spark):
    t = orders_history(spark, SF)
    register(t, "order_views", changes_from=1)
    wrong = spark.sql("""
        SELECT h.version FROM order_views_history h
        JOIN (SELECT _commit_version AS version, count_if(_change_type = 'delete') AS gone FROM order_views_changes
              GROUP BY 1) f ON f.version = h.version
        WHERE int(h.operationMetrics['numDeletedRows']) <> f.gone""").collect()
    assert wrong == []
