import random

from pyspark.sql import functions as F

from tenderloom.operators import dedup as D, sets as S


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_wins_is_order_independent(spark):
    rows = [(i % 37, i, f"v{i}") for i in range(2000)]
    want = {k: k for k in range(37)}
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, pos int, v string").repartition(7)
        got = {r.k: r.pos for r in D.first_wins(df, ["k"], ["pos"]).collect()}
        assert got == want


def test_first_wins_limits_groups_before_the_exchange(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(D.first_wins(df, ["k"], ["id"]))
    assert text.count("WindowGroupLimit") == 2 and text.count("Exchange") == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_lead_dedup_key_order(spark):
    rows = [
        (1, "a@x.org", "1", '"Ліцей"', "Київ"), (2, "a@x.org", "2", "ліцей", "Львів"), (3, "", "7", "Школа", "Суми"),
        (4, None, "7", "ШКОЛА ", "Київ"), (5, "", "", "Школа", "Суми"), (6, "", None, "школа", "СУМИ"), (7, "", None, None, None), (8, None, "", "", "")]
    df = spark.createDataFrame(rows, "pos int, email string, org_id string, name string, city string")
    assert sorted(r.pos for r in D.lead_dedup(df, ["pos"]).collect()) == [1, 3, 5, 7]


def test_dedup_if_key_keeps_every_blank(spark):
    rows = [(1, "a"), (2, "a"), (3, ""), (4, None), (5, ""), (6, "b")]
    df = spark.createDataFrame(rows, "pos int, k string")
    assert sorted(r.pos for r in D.dedup_if_key(df, "k", ["pos"]).collect()) == [1, 3, 4, 5, 6]


def test_most_complete_and_master(spark):
    df = spark.createDataFrame(
        [(1, "n", "", "9"), (2, "n", "a@x", ""), (3, "n", "b@x", ""), (4, "m", "", "")], "id int, name string, email string, phone string")
    assert {r.name: r.id for r in D.dedup_most_complete(df, "name", ["email", "phone"], ["id"]).collect()} == {"n": 3, "m": 4}
    df = spark.createDataFrame([("e", "P3", 1), ("e", "P1 x", 2), ("e", "P1 y", 3), ("f", "P2", 4)], "email string, label string, id int")
    assert {r.email: r.id for r in D.master_dedup(df, "email", "label", ["id"]).collect()} == {"e": 2, "f": 4}


def test_queries_keep_first_rank(spark):
    df = spark.createDataFrame([("t", 2, 1), ("t", 1, 9), ("", 0, 0), (None, 0, 1)], "id string, q int, pos int")
    assert [(r.id, r.q) for r in D.dedup_by_id_across_queries(df, "id", "q", "pos").collect()] == [("t", 1)]


def test_upsert(spark):
    cur = spark.createDataFrame([("a", 1, "old", "2024-01-01")], "k string, seq int, v string, ingested_at string")
    new = spark.createDataFrame([("a", 2, "mid", "2024-01-02"), ("a", 3, None, "2024-01-03"), ("b", 2, "n", "2024-01-02")], cur.schema)
    got = {r.k: (r.v, r.created_at, r.updated_at) for r in S.upsert_latest(cur, new, ["k"], ["seq"]).collect()}
    assert got == {"a": (None, "2024-01-01", "2024-01-03"), "b": ("n", "2024-01-02", None)}


def test_unions_and_sorts(spark):
    a = spark.createDataFrame([("1", "x")], "id string, a string")
    b = spark.createDataFrame([("1", "y"), ("", "z")], "id string, b string")
    got = S.union_superset({"A": a, "B": b}, "src")
    assert got.columns == ["id", "a", "src", "b"] and got.count() == 3
    assert [r.id for r in S.union_ids([a, b], "id").collect()] == ["1"]
    jobs = spark.createDataFrame([(1, "pending", 5), (2, "pending", 1), (3, "done", 0), (4, "pending", 1)], "id int, status string, created_at int")
    assert [r.id for r in S.pending_topk(jobs, 2).collect()] == [2, 4]
    assert "TakeOrderedAndProject" in plan(S.pending_topk(jobs, 2))
    amounts = spark.createDataFrame([(1, None), (2, 5.0), (3, 9.0)], "id int, x double")
    assert [r.id for r in S.sort_amount_desc(amounts, "x", "id").collect()] == [3, 2, 1]


def test_sort_splits_a_value_shared_by_most_rows(spark):
    df = spark.range(20000).select(F.lit(1).alias("priority"), F.lit("same").alias("name"), "id")
    parts = S.sort_leads(df, ["priority", "name"], "id").select(F.spark_partition_id().alias("p"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in parts.groupBy("p").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 1 and max(sizes) < 20000
