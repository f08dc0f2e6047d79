import json

from pyspark.sql import functions as F

from tenderloom import rules as R
from tenderloom.operators import filters as X, flatten as L
from tenderloom.plans import tenders as P
from tenderloom.sources import schemas


def docs(spark, rows, schema=schemas.TENDER):
    rdd_free = spark.createDataFrame([(i, json.dumps(r, ensure_ascii=False)) for i, r in enumerate(rows)], "doc int, j string")
    parsed = rdd_free.select("doc", F.from_json("j", schema).alias("d"))
    return parsed.select("doc", "d.*")


def party(name=None, legal=None, id=None, email=None, tel=None):
    return {"name": name, "identifier": {"id": id, "legalName": legal}, "contactPoint": {"email": email, "telephone": tel, "name": " N "}}


TENDERS = [
    {"id": "1", "tenderID": "UA-1", "title": "Атлас", "value": {"amount": 2000.0}, "procuringEntity": party("", "Юрособа", "77", " A@X.org "),
     "items": [{"description": "a"}, {"description": ""}, {"description": "c", "classification": {"id": "22114200-4"}}, {"description": "d", "classification": {"id": "03000000-1"}}],
     "awards": [{"status": "active", "value": {"amount": 0}, "suppliers": [party("S", None, "1"), party("S", None, "1")]},
                {"status": "x", "value": {"amount": 5.0}, "suppliers": [party("S", None, "1"), party(None, "T", None)]}],
     "bids": [{"status": "b", "tenderers": [party("B", None, "2", "b@mail.ru")]}]},
    {"id": "2", "tenderID": "UA-1", "title": "later", "procuringEntity": party("Other", None, "77")},
    {"id": "3", "title": None, "description": "Карта", "status": "done"},
    {"title": "no id"},
]


def test_buyers(spark):
    rows = {r.tender_id: r for r in L.tender_buyers(docs(spark, TENDERS), ["doc"]).collect()}
    assert set(rows) == {"UA-1", "3"}
    a = rows["UA-1"]
    assert (a.buyer_name, a.email, a.amount, a.status, a.contact, a.category) == ("Юрособа", "a@x.org", 2000.0, "active", "N", "Шкільні Атласи")
    assert (rows["3"].amount, rows["3"].status, rows["3"].buyer_id) == (0.0, "done", "")
    assert a.url == R.TENDER_URL + "UA-1"


def test_winners_and_bidders(spark):
    d = docs(spark, TENDERS)
    got = {(r.party_name, r.party_id, r.party_amount, r.status) for r in L.tender_winners(d, ["doc"]).collect()}
    assert got == {("S", "1", 2000.0, "active"), ("T", "", 5.0, "x")}
    got = [(r.party_name, r.party_amount, r.email) for r in L.tender_bidders(d, ["doc"]).collect()]
    assert got == [("B", 0.0, "")]


def test_tender_row_forms(spark):
    d = docs(spark, TENDERS).filter("id = '1'")
    search, coded = L.tender_row(d, True).first(), L.tender_row(d, False).first()
    assert (search.tender_id, search.subject, search.class_codes, search.buyer_name) == ("UA-1", "a; c", "03000000-1, 22114200-4", "Юрособа")
    assert (coded.tender_id, coded.subject, coded.class_codes, coded.buyer_name) == ("1", "a; ; c", ", 03000000-1, 22114200-4", "")
    assert search.email == "A@X.org"


def test_profiles(spark):
    base = {"id": "1", "value": {"amount": 1000.0}, "title": "Глобус"}
    rows = [
        base, {**base, "title": "КАРТРИДЖ"}, {**base, "items": [{"description": "Дитяче Харчування"}]}, {**base, "procuringEntity": party("Обласна ЛІКАРНЯ")},
        {**base, "items": [{"unit": {"code": "kgm"}}]}, {**base, "value": {"amount": 999.0}}, {**base, "value": None}, {**base, "title": None}]
    assert sorted(r.doc for r in X.tender_profile(docs(spark, rows)).collect()) == [0, 7]
    coded = docs(spark, [base, {**base, "title": "Папір"}, {**base, "title": "Папір"}]).withColumn(
        "code", F.element_at(F.array(*[F.lit(c) for c in ("39162100-6", "39162100-6", "22114200-4")]), F.col("doc") + 1))
    assert sorted(r.doc for r in X.tender_profile_coded(coded, "code").collect()) == [0, 2]


def test_target(spark):
    rows = [{"title": "АТЛАС"}, {"description": "історія"}, {"items": [{"description": "Плакат"}]}, {"items": [{"classification": {"id": "39162110-9"}}]},
            {"title": "x", "items": [{"classification": {"id": "13916211"}}]}, {}]
    assert sorted(r.doc for r in X.tender_target(docs(spark, rows)).collect()) == [0, 1, 2, 3]


def test_strict_profile_folds_look_alikes(spark):
    rows = [(1, "Aтлac шкiльний", "Ліцей"), (2, "Атлас", "КНП Центр"), (3, "Атлас", "Акнпс"), (4, "Ремонт атласів", "Ліцей"), (5, "Стілець", "Ліцей"), (6, None, None)]
    df = spark.createDataFrame(rows, "id int, title string, buyer string")
    assert [r.id for r in X.strict_profile(df, "title", "buyer").collect()] == [1, 3]


def test_contracts(spark):
    row = {"id": "g", "contractID": "C-1", "dateSigned": "2024-05-06T10:00:00", "value": {"amount": 5000.0}, "buyer": party("Ліцей", None, "5", "q@d.org"),
           "suppliers": [{**party("S", None, "9", "c@x.org"), "signerInfo": {"name": "", "email": "Sign@x.org"}, "address": {"streetAddress": "", "locality": "Київ", "region": ""}}, party("Z")]}
    d = docs(spark, [row, {**row, "buyer": party("ДСНС України")}, {**row, "suppliers": []}, {**row, "value": {"amount": 1.0}}], schemas.CONTRACT)
    rows = L.contract_row(d)
    assert (rows.first().signed, rows.first().supplier_name, rows.first().url) == ("2024-05-06", "S", R.CONTRACT_URL + "C-1")
    assert X.contract_keep(rows).count() == 2
    s = L.supplier_contact_row(d).first()
    assert (s.signer, s.email, s.address) == (" N ", "sign@x.org", "Київ")
    assert L.supplier_contact_row(d).count() == 3


def test_supplier_job_keeps_the_most_complete(spark):
    base = {"suppliers": [party("S", None, "9", "", "1")]}
    d = docs(spark, [{"id": "a", **base}, {"id": "b", "suppliers": [party("S", None, "9", "s@up.org", "")]}, {"id": "a", "suppliers": [party("other")]}], schemas.CONTRACT)
    d = d.withColumn("query_rank", F.lit(0)).withColumn("pos", F.col("doc"))
    st = spark.createDataFrame([("up.org", True)], "domain string, active boolean")
    out = P.supplier_contacts(d, st)
    assert [(r.supplier_name, r.email, r.domain_label) for r in out["suppliers"].collect()] == [("S", "s@up.org", R.DOMAIN_ACTIVE_LABEL)]
    assert out["coverage"].first().with_email == 1


def test_first_find_decides_and_only_flat_rows_are_shuffled(spark):
    good = {"id": "a", "tenderID": "T-1", "title": "Атлас", "value": {"amount": 5000.0}, "items": [{"description": "x"}], "procuringEntity": party("Ліцей")}
    d = docs(spark, [{**good, "title": "КАРТРИДЖ"}, good, {**good, "tenderID": "T-2"}])
    d = d.withColumn("query_rank", F.lit(0)).withColumn("pos", F.col("doc"))
    st = spark.createDataFrame([("up.org", True)], "domain string, active boolean")
    assert [r.tender_id for r in P.target_tenders(d, st).collect()] == ["T-2"]  # the first find of T-1 is denied
    plan = P.target_tenders(d, st, ordered=False)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "rangepartitioning" in P.target_tenders(d, st)._jdf.queryExecution().executedPlan().toString()
    window = P.target_tenders(d, st, ordered=False)._jdf.queryExecution().optimizedPlan().toString()
    above = window[:window.index("Window")]
    assert "items" not in above and "procuringEntity" not in above


def test_supplier_job_shuffles_flat_rows_and_the_first_find_decides(spark):
    named = {"id": "a", "suppliers": [party("S", None, "9", "s@up.org", "1")]}
    d = docs(spark, [{"id": "a", "suppliers": [party(None)]}, named, {**named, "id": "b"}], schemas.CONTRACT)
    d = d.withColumn("query_rank", F.lit(0)).withColumn("pos", F.col("doc"))
    st = spark.createDataFrame([("up.org", True)], "domain string, active boolean")
    out = P.supplier_contacts(d, st)["suppliers"]
    assert [(r.supplier_name, r.contract_id) for r in out.collect()] == [("S", "b")]  # the first find of a has no name
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    lowest = plan.rindex("Window [")  # the first deduplication by id
    assert "suppliers" not in plan[:lowest] and "suppliers" in plan[lowest:]


def test_parties_of_other_tenders_go_before_deduplication(spark):
    import re

    many = [{"id": str(n), "tenderID": f"UA-{n}", "title": "Атлас шкільний" if n % 3 else "Картридж", "value": {"amount": 2000.0},
             "procuringEntity": party("Ліцей", None, "77"), "awards": [{"suppliers": [party("S", None, "1"), party("T", None, str(n % 2))]}],
             "bids": [{"tenderers": [party("B", None, "2"), party("B", None, "2")]}] * 2} for n in range(30)]
    d = docs(spark, many + many[:9])
    early, late = P.strict_parties(d, ["doc"]), P.tender_parties_strict(P.tender_parties(d, ["doc"]))
    for name in ("buyers", "winners", "bidders"):
        cols = early[name].columns
        assert sorted(map(str, early[name].collect())) == sorted(map(str, late[name].select(*cols).collect())) and early[name].count() > 0
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = P.strict_parties(d, ["doc"])["winners"]._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    nodes = re.findall(r"(Window \[|SortMergeJoin|Exchange|WindowGroupLimit)", plan[:plan.index("SortMergeJoin") + 20])
    assert "Exchange" not in nodes and nodes[-1] == "SortMergeJoin"  # the window reuses the partitioning of the semi-join


def test_projections(spark):
    c = spark.createDataFrame([("1", "A", None, 1, 5.0), ("2", None, " B", 0, None), ("3", None, None, None, 9.0)], "customer_id string, firstname string, lastname string, newsletter int, orders_total double")
    for name in ("email", "telephone", "orders_completed", "last_order_date", "date_added"):
        c = c.withColumn(name, F.lit("x"))
    assert [(r.customer_id, r.full_name, r.newsletter) for r in L.customer_profile(c).collect()] == [("3", "", None), ("1", "A", R.SUBSCRIBED), ("2", "B", R.NOT_SUBSCRIBED)]
    a, b = L.column_superset(c.select("customer_id", "email"), c.select("email", "newsletter"))
    assert a.columns == b.columns == ["customer_id", "email", "newsletter"]
