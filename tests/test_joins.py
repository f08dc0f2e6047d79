import pytest
from pyspark.sql import functions as F

from tenderloom import rules as R
from tenderloom.functions import text as T
from tenderloom.operators import joins as J
from tenderloom.plans import erp


def run_plan(df):
    """Executes df and gives its final adaptive plan."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def small_partitions(spark):
    """Settings under which a few thousand rows look like a skewed large join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def facts(spark, n=20000):
    """A third of the rows share one key, a third have none, the rest are spread."""
    key = F.when(F.col("id") % 3 == 0, "gmail.com").when(F.col("id") % 3 == 1, None).otherwise(
        F.concat(F.lit("d"), (F.col("id") % 500).cast("string")))
    return spark.range(0, n, 1, 8).select("id", key.alias("domain"), F.lit("x" * 40).alias("pad"))


def dims(spark):
    rows = [("gmail.com", "G")] + [(f"d{i}", f"v{i}") for i in range(0, 500, 2)]
    return spark.createDataFrame(rows, "domain string, v string")


def expected(n=20000):
    out = {}
    for i in range(n):
        d = "gmail.com" if i % 3 == 0 else None if i % 3 == 1 else f"d{i % 500}"
        out[i] = "G" if d == "gmail.com" else f"v{d[1:]}" if d and int(d[1:]) % 2 == 0 else None
    return out


@pytest.mark.parametrize("hot", [(), ("gmail.com",), ("gmail.com", "d2", "absent")])
def test_lookup_join_with_and_without_salts(spark, small_partitions, hot):
    df = J.lookup_join(facts(spark), dims(spark), F.col("domain"), "domain", {"v": "v"}, hot=hot)
    assert df.columns == ["id", "domain", "pad", "v"]
    assert {r.id: r.v for r in df.collect()} == expected()


def test_unnamed_hot_key_is_split_at_run_time(spark, small_partitions):
    df = J.lookup_join(facts(spark), dims(spark), F.col("domain"), "domain", {"v": "v"})
    assert "skew=true" in run_plan(df)


def partition_sizes(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())


def test_null_and_named_hot_keys_are_spread(spark, small_partitions):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = J.lookup_join(facts(spark), dims(spark), F.col("domain"), "domain", {"v": "v"}, hot=("gmail.com",))
        sizes = partition_sizes(df)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(sizes) < 20000 * 0.2  # one key alone holds a third


def test_small_lookup_is_broadcast_by_size(spark):
    assert "BroadcastHashJoin" in run_plan(J.lookup_join(facts(spark, 100), dims(spark), F.col("domain"), "domain", {"v": "v"}))


def test_heavy_keys(spark):
    assert J.heavy_keys(facts(spark, 3000), "domain", 0.1) == ["gmail.com"]


SOURCES = [
    (1, 0, "A", "00012345", "ТОВ Альфа", "0501112233", "bad"), (2, 1, "B", "12345", "Альфа", "0501112233", "B@x.org"),
    (3, 2, "C", "12345.0", "Бета", "+380501112233", "c@x.org"), (4, 0, "A", "", "Гама ТОВ", "1", "d@x.org"), (5, 0, "A", "77777", "аб", "", "e@mail.ru")]
SRC = "row_id int, src_rank int, source string, org_id string, name string, phone string, email string"


def test_first_and_last_wins(spark):
    src = spark.createDataFrame(SOURCES, SRC).repartition(3)
    order = ("src_rank", "row_id")
    by_id, by_name, by_phone = erp.contact_lookups(src)
    assert {r.key: (r.email, r.source) for r in by_id.collect()} == {"12345": ("b@x.org", "B")}
    assert {r.key: r.email for r in by_name.collect()} == {"альфа": "b@x.org", "бета": "c@x.org", "гама": "d@x.org"}
    assert {r.key: r.email for r in by_phone.collect()} == {"501112233": "b@x.org"}
    last = J.build_lookup_last_wins(src, T.phone_last9("phone"), order, min_len=9)
    assert {r.key: r.email for r in last.collect()} == {"501112233": "c@x.org"}


def test_tiers(spark):
    rows = [
        (1, " Own@x.org ", "12345", "Альфа", ""), (2, "", "0012345", "Бета", ""), (3, "x@mail.ru", "99999", "ФОП «Бета»", ""),
        (4, None, None, None, "050-111-22-33"), (5, None, "1", "ні", "12")]
    df = spark.createDataFrame(rows, "id int, email string, org_id string, name string, phone string")
    out = J.tiered_contact_match(df, *erp.contact_lookups(spark.createDataFrame(SOURCES, SRC)))
    got = {r.id: (r.found_email, r.email_source, r.match_type) for r in out.collect()}
    assert got == {
        1: ("Own@x.org", *R.MATCH_EXISTING), 2: ("b@x.org", "Збагачено з B", R.MATCH_ID), 3: ("c@x.org", "Збагачено з C", R.MATCH_NAME),
        4: ("b@x.org", "Збагачено з B", R.MATCH_PHONE), 5: ("", "", "")}


def test_tiers_meet_in_one_join_of_narrow_rows(spark):
    import re

    n = 6000
    wide = F.sha2(F.col("id").cast("string"), 512).alias("payload")
    df = spark.range(n).select(  # a third of all rows shares one name, another third one combination of keys
        "id", F.when(F.col("id") % 7 == 0, F.lit("own@x.org")).alias("email"), F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.lit("0012345")).alias("org_id"),
        F.when(F.col("id") % 3 == 0, F.lit("ФОП Гамма")).otherwise(F.lit("ніхто такий")).alias("name"),
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("050"), F.lpad("id", 7, "0"))).alias("phone"), wide)
    keyed = {"key": "string", "email": "string", "source": "string"}
    schema = ", ".join(f"{k} {t}" for k, t in keyed.items())
    by_id = spark.createDataFrame([("12345", "id@x.org", "A")] + [(f"9{k:07d}", f"z{k}@x.org", "Z") for k in range(3000)], schema)
    by_name = spark.createDataFrame([("гамма", "name@x.org", "B")] + [(f"назва {k}", f"y{k}@x.org", "Y") for k in range(3000)], schema)
    by_phone = spark.createDataFrame([(f"50{k:07d}", f"p{k}@x.org", "C") for k in range(0, n, 9)], schema)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = J.tiered_contact_match(df, by_id, by_name, by_phone)
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        joins = [line for line in plan.splitlines() if re.search(r"\w+Join ", line)]
        assert len(joins) == 2  # the probe of all tiers, and the table with its answers
        got = {r.id: (r.found_email, r.match_type) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(got) == n
    for i, r in got.items():
        want = ("own@x.org", R.MATCH_EXISTING[1]) if i % 7 == 0 else ("id@x.org", R.MATCH_ID) if i % 3 else ("name@x.org", R.MATCH_NAME)
        assert r == want


def test_multi_phone_takes_the_first_known(spark):
    lk = spark.createDataFrame([("111111111", "one@x"), ("222222222", "two@x")], "key string, email string")
    df = spark.createDataFrame([(1, "5; 0222222222, 0111111111"), (2, "x/y"), (3, None)], "id int, phones string")
    assert {r.id: r.e for r in J.match_multi_phone(df, "id", "phones", lk, "e").collect()} == {1: "two@x", 2: None, 3: None}


def test_attach_verified_matches_blank_to_blank_without_fan_out(spark):
    base = spark.createDataFrame([(1, " Альфа "), (2, ""), (3, None), (4, "Інша")], "id int, name string")
    ver = spark.createDataFrame([(1, "альфа", "first"), (2, "АЛЬФА", "second"), (3, " ", "blank"), (4, None, "blank2")], "pos int, name string, phones string")
    out = J.attach_verified(base, ver, "name", ["phones", "email"], ["pos"])
    assert {r.id: r.phones for r in out.collect()} == {1: "first", 2: "blank", 3: "blank", 4: None} and out.count() == 4


def test_domain_status_defaults_to_false(spark):
    df = spark.createDataFrame([("A@Up.org",), ("a@down.org",), ("a@other.org",), ("bad",), (None,)], "email string")
    st = spark.createDataFrame([("up.org", True), ("up.org", False), ("down.org", False)], "domain string, active boolean")
    assert {r.email: r.active for r in J.domain_status(df, "email", st).collect()} == {
        "A@Up.org": True, "a@down.org": False, "a@other.org": False, "bad": False, None: False}


def test_registry_fill_touches_blank_rows_only(spark):
    reg = spark.createDataFrame(
        [("00123456", "second", 2, 0, "s@x.org"), ("123456", "first", 1, 5, "late@x.org"), ("123456", "first", 1, 1, "z@x.ru"), ("9", "first", 1, 0, "a@x.org")],
        "org_id string, registry string, registry_rank int, pos int, email string")
    ans = J.first_valid_from_registry(reg)
    assert [(r.org_id, r.email) for r in ans.collect()] == [("123456", "late@x.org")]
    df = spark.createDataFrame([(1, "keep@x", "123456", "s", "m"), (2, "", "0123456", "", ""), (3, None, None, None, None)], "id int, email string, org_id string, email_source string, mx_status string")
    got = {r.id: (r.email, r.email_source, r.mx_status) for r in J.fill_from_registry(df, ans).collect()}
    assert got == {1: ("keep@x", "s", "m"), 2: ("late@x.org", "first", R.MX_ACTIVE_LABEL), 3: ("", "", "")}


def test_fill_missing_never_changes_what_is_there(spark):
    html = "Zed@firm.ua abc@firm.ua 0501112233 0501112233 +380671112233"
    pages = spark.createDataFrame([("12345678", html), ("Name", html), ("87654321", "nothing")], "key string, html string")
    rows = [
        (1, "old@x", "0441234567", "12345678", "n"), (2, "old@x", "", "12345678", "n"), (3, "broken", "12345", "1", "Name"), (4, None, None, "87654321", "n"),
        (5, "nan", "nan", "12345678", "n")]
    df = spark.createDataFrame(rows, "id int, email string, phone string, org_id string, name string")
    first = {r.id: (r.email, r.phone) for r in J.fill_missing_only(df, pages).collect()}
    two = "+380671112233, 0501112233"
    assert first == {1: ("old@x", "0441234567"), 2: ("old@x", two), 3: ("zed@firm.ua", two), 4: (None, None), 5: ("zed@firm.ua", two)}
    other = {r.id: (r.email, r.phone) for r in J.fill_missing_only(df, pages, "sorted").collect()}
    assert other[3] == ("broken", "12345") and other[5] == ("abc@firm.ua", two)


def test_semi_and_anti(spark):
    a = spark.createDataFrame([("1", "x"), ("2", "y"), ("", "z")], "id string, v string")
    b = spark.createDataFrame([("1",), ("1",)], "id string")
    assert [r.v for r in J.tenders_semi(a, b, "id").collect()] == ["x"]
    assert [r.v for r in J.new_only(a, b, "id").collect()] == ["y"]


def test_overlays(spark):
    schema = "row_id int, name string, email string, status string, reason string"
    main = spark.createDataFrame([(1, "a", "x", R.PARTNER_CHECK, "r"), (2, "b", "y", R.PARTNER_CHECK, "r"), (3, "c", "z", R.PARTNER_OK, "r")], schema)
    gone = spark.createDataFrame([(9, "old", "", R.PARTNER_REJECT, "r")], schema)
    over = spark.createDataFrame([(1, R.PARTNER_REJECT, "why"), (2, R.PARTNER_OK, "good")], "row_id int, status string, reason string")
    kept, excluded = J.apply_reclass(main, gone, over)
    assert {(r.row_id, r.reason) for r in kept.collect()} == {(2, "good"), (3, "r")}
    assert {(r.row_id, r.reason) for r in excluded.collect()} == {(9, "r"), (1, "why")}
    verdicts = spark.createDataFrame([(2, False, "no_mx"), (3, True, "ok")], "row_id int, ok boolean, verdict string")
    cleaned, rejects = J.apply_invalid(main, verdicts)
    assert {(r.row_id, r.email, r.reason) for r in cleaned.collect()} == {(1, "x", "r"), (2, "", "no_mx"), (3, "z", "r")}
    assert [(r.name, r.email, r.reason) for r in rejects.collect()] == [("b", "y", "no_mx")]


def test_label_dim(spark):
    df = spark.createDataFrame([("47.61",), ("00.00",), (None,)], "c string")
    assert [r.label for r in J.label_dim(df, R.PARTNER_CODES, "c").collect()] == [R.PARTNER_CODES["47.61"], "00.00", None]
    dim = spark.createDataFrame([("47.61", "books")], "code string, label string")
    assert {r.c: r.label for r in J.label_dim(df, dim, "c").collect()} == {"47.61": "books", "00.00": "00.00", None: None}


def test_lookup_reads_only_what_it_needs(spark, tmp_path):
    path = str(tmp_path / "wide")
    spark.range(10).selectExpr("id", "concat('a@d', id, '.ua') AS email", "repeat('x', 100) AS html", "map('k', 'v') AS m").write.parquet(path)
    statuses = spark.createDataFrame([("d1.ua", True)], "domain string, active boolean")
    out = J.domain_status(spark.read.parquet(path), "email", statuses).select("id", "active")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "html" not in plan.split("ReadSchema")[1] and out.filter("active").count() == 1
