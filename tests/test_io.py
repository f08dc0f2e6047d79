import pytest
from pyspark.sql import functions as F

from tenderloom.session import scratch_dir, stored
from tenderloom.sources import bindings, scan, schemas, sink, upsertlog
from tenderloom.streaming import feeds


def write(path, name, text):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(text, encoding="utf-8")


def test_jsonl(spark, tmp_path):
    write(tmp_path, "a.jsonl", '{"name": "x"}\n\n{"name": \nnot json\n{"name": "y", "more": 1}\n')
    write(tmp_path, "b.jsonl", '{"name": "z"}\n')
    assert sorted(r.name for r in scan.scan_jsonl(spark, str(tmp_path), schemas.RAW_REGISTRY).collect()) == ["x", "y", "z"]
    good, bad = scan.scan_jsonl_strict_per_file(spark, str(tmp_path), schemas.RAW_REGISTRY)
    assert sorted(r.name for r in good.collect()) == ["x", "y", "z"]
    assert [(r.file[-7:], r.rejected) for r in bad.collect()] == [("a.jsonl", 2)]


def test_tagged(spark, tmp_path):
    write(tmp_path, "kved_47_61.jsonl", '{"name": "x"}\n')
    write(tmp_path, "kved_30.30.jsonl", '{"name": "y"}\n')
    got = {r.name: (r.activity_code, r.activity_label) for r in scan.scan_tagged_by_filename(spark, str(tmp_path), schemas.RAW_REGISTRY, {"47.61": "books"}).collect()}
    assert got == {"x": ("47.61", "books"), "y": ("30.30", "30.30")}


def test_aliased_csv(spark, tmp_path):
    write(tmp_path / "one", "a.csv", "Name,EMAIL,Phones\nA,a@x,1\n")
    write(tmp_path / "two" / "deep+er", "b.csv", "Код ЄДРПОУ,email\n5,b@x\n")
    write(tmp_path / "two", "c.csv", "name,phone\nC,1\n")
    write(tmp_path / "one", "note.txt", "email\nno\n")
    got = sorted(tuple(r) for r in scan.scan_csv_aliased(spark, str(tmp_path)).collect())
    assert got == [("a@x", "", "A", "1", "Email Catalog (one)"), ("b@x", "5", "", "", "Email Catalog (deep+er)")]
    assert scan.scan_csv_aliased(spark, str(tmp_path / "two"), label="L").filter("source like 'L%'").count() == 1


def test_aliased_csv_with_quoted_and_declared_headers(spark, tmp_path):
    write(tmp_path / "one", "a.csv", '"Name, full",Name,"Email"\n"x, y",A,a@x\n')
    assert [tuple(r) for r in scan.scan_csv_aliased(spark, str(tmp_path)).collect()] == [("a@x", "", "A", "", "Email Catalog (one)")]
    declared = [(["Name, full", "name", "EMAIL"], [str(tmp_path / "one")]), (["name"], [str(tmp_path / "none")])]
    assert [r.email for r in scan.scan_csv_aliased(spark, str(tmp_path), headers=declared).collect()] == ["a@x"]


def test_page_parts(spark, tmp_path):
    for n in (1, 2, 10):
        write(tmp_path, f"page_{n}.csv", f"name,address,phone,email\nn{n},a,p,e\n")
    write(tmp_path, "other.csv", "name,address,phone,email\nx,a,p,e\n")
    assert [(r.page, r.name) for r in scan.merge_page_parts(spark, str(tmp_path)).orderBy("page").collect()] == [(1, "n1"), (2, "n2"), (10, "n10")]


def test_csv_and_sheets(spark, tmp_path):
    df = spark.createDataFrame([("a;b", 1.5), (None, None)], "name string, x double")
    sink.write_csv(df, str(tmp_path / "c"))
    assert scan.scan_csv(spark, str(tmp_path / "c"), "name string, x double").count() == 2
    root = str(tmp_path / "s")
    assert sink.write_sheets({"main": df, "none": df.filter("false")}, root, {"none"}) == ["main"]
    assert sorted(tuple(r) for r in scan.scan_sheets(spark, root, ["main"])["main"].collect()) == [("", ""), ("a;b", "1.5")]
    sink.replace_one_sheet(sink.read_sheet(spark, root, "main").filter("x > 1").withColumn("x", F.col("x") + 1), root, "main")
    assert [tuple(r) for r in sink.read_sheet(spark, root, "main").collect()] == [("a;b", 2.5)]
    with pytest.raises(Exception, match="BAD_LINE"):
        sink.replace_one_sheet(df.select(F.raise_error(F.lit("BAD_LINE")).cast("string").alias("t")), root, "main")
    assert sink.read_sheet(spark, root, "main").count() == 1  # a failed write leaves the old rows


def test_snapshot(spark, tmp_path):
    write(tmp_path, "a.jsonl", "x\n\nyy\n")
    write(tmp_path, "b.jsonl", "z\n")
    r = sink.register_snapshot(spark, str(tmp_path), "s", "v", "u").first()
    assert (r.size_bytes, r.record_count, r.source_id) == (8, 4, "s")


def test_stored_is_readable_again(spark):
    df = stored(spark.range(10).withColumn("r", F.rand(1)))
    assert sorted(df.collect()) == sorted(df.collect()) and df.count() == 10
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


TENDER = '{"id": "%s", "title": "%s"}\n'


def test_feed_skips_seen_ids_and_resumes(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    write(tmp_path / "in", "1.json", TENDER % ("a", "Атлас") + TENDER % ("b", "Цемент") + TENDER % ("a", "Атлас"))
    feeds.stream_new_matches(spark, src, dst, cp).awaitTermination()
    write(tmp_path / "in", "2.json", TENDER % ("a", "Атлас") + TENDER % ("c", "Глобус") + TENDER % ("", "Карта"))
    feeds.stream_new_matches(spark, src, dst, cp).awaitTermination()
    assert sorted(r.id for r in spark.read.schema(schemas.TENDER).json(dst).collect()) == ["a", "c"]
    feeds.stream_new_matches(spark, src, dst, cp).awaitTermination()
    assert spark.read.schema(schemas.TENDER).json(dst).count() == 2


def test_feed_writes_compressed_matches_and_remembers_other_ids(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    write(tmp_path / "in", "1.json", TENDER % ("a", "Атлас") + TENDER % ("b", "Цемент"))
    feeds.stream_new_matches(spark, src, dst, cp).awaitTermination()
    write(tmp_path / "in", "2.json", TENDER % ("b", "Глобус"))  # old, though its first find did not match
    feeds.stream_new_matches(spark, src, dst, cp).awaitTermination()
    assert [(r.id, r.title) for r in spark.read.schema(schemas.TENDER).json(dst).collect()] == [("a", "Атлас")]
    assert all(f.name.endswith(".json.gz") for f in (tmp_path / "out").glob("part-*"))


@pytest.mark.parametrize("name, folder", [("stream_new_matches", "feed-in"), ("scan_tender_json", "tenders-json")])
def test_json_documents_are_stored_compressed(spark, tmp_path, monkeypatch, name, folder):
    from tenderloom.catalog import QUERIES, io_queries

    monkeypatch.setattr(io_queries, "scratch_dir", lambda _, part: str(tmp_path / f"{part}-0"))
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count()
    files = list(tmp_path.glob(f"{folder}-*/part-*"))
    assert files and all(f.name.endswith(".json.gz") for f in files)


@pytest.mark.parametrize("name, stem", [("orders", "tender_base"), ("customer", "card_pages"), ("customer", "school_pages")])
def test_wide_rows_are_built_by_many_tasks(spark, tmp_path, name, stem):
    rows = spark.range(50_000).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "1.5D AS o_totalprice", "timestamp'2024-01-01' AS o_orderdate",
        "id AS c_custkey", "'n' AS c_name", "'m' AS c_mktsegment").coalesce(1)
    rows.write.parquet(str(tmp_path / f"{name}.parquet"))  # one file, one row group
    wide = bindings.view(spark, str(tmp_path), stem)
    assert wide.rdd.getNumPartitions() == 3 and wide.count() == 50_000


def test_feed_with_bounded_state(spark, tmp_path):
    src, dst, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    line = '{"id": "%s", "title": "Атлас", "seen": "2024-01-01 00:00:0%d"}\n'
    write(tmp_path / "in", "1.json", line % ("a", 1) + line % ("a", 2) + line % ("b", 3))
    feeds.stream_new_matches(spark, src, dst, cp, schema=schemas.TENDER + ", seen string", event_time="seen", lateness="1 hour").awaitTermination()
    assert sorted(r.id for r in spark.read.schema("id string").json(dst).collect()) == ["a", "b"]


def test_upsert_log_is_idempotent(spark, tmp_path):
    log, schema = str(tmp_path / "log"), "name string, activity_code string, phone string, seq int, ingested_at string"
    b0 = spark.createDataFrame([("A", "1", "old", 1, "d1"), ("B", "1", "b", 1, "d1")], schema)
    b1 = spark.createDataFrame([("A", "1", "new", 1, "d2")], schema)

    def state():
        rows = sink.read_upserted(spark, log, ["name", "activity_code"], ["seq"]).collect()
        return {r.name: (r.phone, r.created_at, r.updated_at) for r in rows}

    sink.write_upsert_batch(b0, log, 0)
    sink.write_upsert_batch(b1, log, 1)
    want = {"A": ("new", "d1", "d2"), "B": ("b", "d1", None)}
    assert state() == want
    sink.write_upsert_batch(b1, log, 1)  # a replayed batch
    assert state() == want
    sink.write_upsert_batch(spark.createDataFrame([("C", "2", "c", 1, "d3")], schema), log, 0, "other")  # a new checkpoint
    assert state() == {**want, "C": ("c", "d3", None)}
    sink.publish_upserted(spark, log, str(tmp_path / "out"), ["name", "activity_code"], ["seq"])
    assert (tmp_path / "out" / "activity_code=1").exists()


KEY = ["k"]


def _batch(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v int, seq int, ingested_at string")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _files(path):
    import os
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_compacted_log_reads_like_the_whole_one(spark, tmp_path):
    log, plain = str(tmp_path / "log"), str(tmp_path / "plain")
    for n in range(40):
        run = "q2" if n % 5 == 4 else "q1"
        df = _batch(spark, (f"k{n % 7}", n, 0, f"d{n:02d}"), (f"k{n % 3}", -n, 1, f"d{n:02d}"), (f"only{n}", n, 0, f"d{n:02d}"))
        for root in (log, plain):
            upsertlog.write_upsert_batch(df, root, n, run)
        if n % 3 == 2:
            upsertlog.compact(spark, log, KEY, ["seq"], fan=3)
            upsertlog.vacuum(spark, log)
            assert len(upsertlog._last_manifest(spark, log)["parts"]) <= 2 * 4  # two of each level at most
    want = _rows(upsertlog.read_upserted(spark, plain, KEY, ["seq"]))
    assert _rows(upsertlog.read_upserted(spark, log, KEY, ["seq"])) == want and len(want) == 7 + 40
    assert upsertlog.pending_batches(spark, log) == 1 and upsertlog.pending_batches(spark, plain) == 40
    assert len(_files(f"{log}/run=q1")) < 10  # what was taken in is gone


def test_replay_after_a_merge_changes_nothing(spark, tmp_path):
    log = str(tmp_path / "log")
    first = _batch(spark, ("a", 1, 0, "d1"))
    upsertlog.write_upsert_batch(first, log, 0)
    upsertlog.write_upsert_batch(_batch(spark, ("a", 2, 0, "d2")), log, 1)
    assert upsertlog.compact(spark, log, KEY, ["seq"]) == 2 and upsertlog.compact(spark, log, KEY, ["seq"]) == 0
    upsertlog.vacuum(spark, log, keep=1)
    upsertlog.write_upsert_batch(first, log, 0)  # the stream lost its progress and sends the batch again
    assert _files(f"{log}/run=0") == []
    assert _rows(upsertlog.read_upserted(spark, log, KEY, ["seq"])) == [("a", 2, 0, "d1", "d2")]


def test_crashes_between_the_steps_of_a_merge(spark, tmp_path, monkeypatch):
    import os

    log = str(tmp_path / "log")
    for n in range(3):
        upsertlog.write_upsert_batch(_batch(spark, ("a", n, 0, f"d{n}"), (f"b{n}", n, 0, f"d{n}")), log, n)
    want = _rows(upsertlog.read_upserted(spark, log, KEY, ["seq"]))

    def state():
        return _rows(upsertlog.read_upserted(spark, log, KEY, ["seq"]))

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:  # the part is written, the manifest is not
        m.setattr(upsertlog, "_write_manifest", fail)
        with pytest.raises(RuntimeError):
            upsertlog.compact(spark, log, KEY, ["seq"])
    assert state() == want and upsertlog.pending_batches(spark, log) == 3 and len(_files(f"{log}/parts")) == 1
    os.makedirs(f"{log}/manifests")
    with open(f"{log}/manifests/{0:012d}.json", "w") as f:  # a manifest torn in the middle
        f.write('{"parts": [{"na')
    assert state() == want
    assert upsertlog.compact(spark, log, KEY, ["seq"]) == 3  # batches are still there: taken in, not yet removed
    assert state() == want and len(_files(f"{log}/run=0")) == 3
    os.makedirs(f"{log}/run=0/batch_id=9")  # a batch that never finished
    assert state() == want
    reader = upsertlog.read_upserted(spark, log, KEY, ["seq"])  # begins before the next merge
    upsertlog.write_upsert_batch(_batch(spark, ("a", 7, 0, "d7")), log, 3)
    upsertlog.compact(spark, log, KEY, ["seq"], fan=2)
    upsertlog.vacuum(spark, log)
    assert _rows(reader) == want
    upsertlog.vacuum(spark, log, keep=1)
    assert len(_files(f"{log}/parts")) == 1 and ("a", 7, 0, "d0", "d7") in state() and len(state()) == len(want)
    with pytest.raises(Exception):  # a second process that took the same number
        monkeypatch.setattr(upsertlog, "_manifest_numbers", lambda *_: [1])
        upsertlog._write_manifest(spark, log, {})


def test_ranges_of_batches():
    assert upsertlog._with_batches([[0, 4], [9, 9]], [5, 8, 12]) == [[0, 5], [8, 9], [12, 12]]
    assert upsertlog._with_batches([], list(range(1000))) == [[0, 999]]
