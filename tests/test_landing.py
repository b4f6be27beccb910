import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from recordmill import schemas
from recordmill.sources import bulk, files, landing, ndjson, tables
from recordmill.streaming.landing import land_new_files

AT = datetime(2024, 3, 5, 6, 7, 8)


def write_lines(spark, path, *lines):
    spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_ndjson_round_trip(spark, scratch):
    records = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    done = ndjson.write_raw(records, scratch, "src", AT, "run7")
    assert done["recordCount"] == 2
    assert done["s3Key"] == f"raw/src/2024/03/05/060708_{done['contentHash']}_run7.ndjson"
    assert ndjson.write_raw(records, scratch, "src", AT, "run7") == done
    back = ndjson.read_ndjson(spark, f"{scratch}/{done['s3Key']}")
    assert back.count() == 2
    assert sorted(json.loads(r.j)["name"] for r in back.select(F.to_json("data").alias("j")).collect()) == ["a", "b"]
    row = back.select(ndjson.source_of(F.col("file_path")).alias("s"), ndjson.date_of(F.col("file_path")).alias("d")).first()
    assert row.s == "src" and str(row.d) == "2024-03-05"


def test_zero_records_write_no_file(spark, scratch):
    done = ndjson.write_raw(spark.createDataFrame([], "id int"), scratch, "src", AT)
    assert done == {"source": "src", "recordCount": 0, "s3Key": None}
    assert not tables.path_exists(spark, scratch)


def test_fingerprint_ignores_order_but_not_copies(spark):
    def of(*lines):
        df = spark.createDataFrame([(x,) for x in lines], "line string").repartition(3)
        return df.agg(*ndjson.digest(F.col("line"))).first().content_hash

    assert of("a", "b", "c") == of("c", "a", "b")
    assert of("a", "a") != of("b", "b") and of("a", "b") != of("a", "b", "b")
    assert len(of("a")) == 16


def test_scan_accepts_any_value_and_skips_blank_lines(spark, scratch):
    write_lines(spark, scratch, '{"a":1}', "", "  \t", "3", "[1]", '"x"', "null")
    assert ndjson.read_ndjson(spark, scratch).count() == 5


def test_bad_line_fails_or_is_rescued(spark, scratch):
    write_lines(spark, scratch, '{"a":1}', "{bad")
    with pytest.raises(Exception):
        ndjson.read_ndjson(spark, scratch).select(F.to_json("data")).collect()
    kept = ndjson.read_ndjson(spark, scratch, rescue=True)
    assert kept.where("data IS NULL").first().line == "{bad"


def test_repeated_key_keeps_the_last(spark):
    df = spark.createDataFrame([('{"a":1,"a":2}',)], "s string")
    assert df.select(F.variant_get(F.parse_json("s"), "$.a", "int")).first()[0] == 2


def records(spark, n, path="raw/s/2024/03/05/x.ndjson"):
    return spark.range(n).select(F.lit(path).alias("file_path"), F.parse_json(F.concat(F.lit('{"id":'), "id", F.lit("}"))).alias("data"))


def test_write_read_and_prune_by_source(spark, scratch):
    for _ in range(2):
        landing.write_batch(landing.to_landing(records(spark, 42), "s", "l1", AT), scratch, "b1")
    landing.write_batch(landing.to_landing(records(spark, 3), "t", "l2", AT), scratch, "b2")
    rows = landing.read_landing(spark, scratch)
    assert rows.count() == 45
    one = landing.from_source(rows, "t")
    assert one.columns == ["load_id", "file_path", "ingested_at", "data"]
    assert one.count() == 3
    assert "PartitionFilters: [isnotnull(source" in one._jdf.queryExecution().executedPlan().toString()
    summary = {r.source: (r.load_id, r.rows_loaded, r.files_loaded) for r in landing.load_summary(rows).collect()}
    assert summary == {"s": ("l1", 42, 1), "t": ("l2", 3, 1)}


def test_null_in_a_required_column_fails_the_write(spark, scratch):
    rows = landing.to_landing(records(spark, 2), "s", "l1", AT)
    for column in ("data", "load_id", "source", "ingested_at"):
        with pytest.raises(Exception, match=f"NULL in landing column {column}"):
            empty = F.lit(None).cast(dict(rows.dtypes)[column])
            landing.write_batch(rows.withColumn(column, empty), scratch, "b")


def test_load_report(spark):
    rows = landing.to_landing(records(spark, 2), "s", "l1", AT)
    targets = spark.createDataFrame(
        [("l1", "s", "k"), ("l2", "s", "blank"), ("l3", "s", None)], "load_id string, source string, s3_key string"
    )
    got = {r.load_id: (r.rows_loaded, r.files_loaded, r.status, r.reason) for r in landing.load_report(targets, rows).collect()}
    assert got == {
        "l1": (2, 1, "LOADED", None),
        "l2": (0, 0, "SKIPPED", "file contained zero records"),
        "l3": (0, 0, "SKIPPED", "no s3Key in ingest result"),
    }


@pytest.mark.parametrize(
    "state, wanted",
    [
        ({"ingestResult": {"Payload": {"source": "a", "s3Key": "k"}}, "source": "z"}, ("a", "k")),
        ({"ingestResult": {"Payload": {"s3Key": "k"}}, "source": "z"}, ("unknown", "k")),
        ({"ingestResult": {"Payload": {}}, "source": "z", "s3Key": "q"}, ("z", "q")),
        ({"ingestResult": "text", "source": "z", "s3Key": "q"}, ("z", "q")),
        ({"source": "z", "s3Key": "q"}, ("z", "q")),
        ({}, ("unknown", None)),
    ],
)
def test_load_target(spark, state, wanted):
    df = spark.createDataFrame([(json.dumps(state),)], "s string").select(F.parse_json("s").alias("s"))
    assert tuple(df.select(*landing.load_target(F.col("s"))).first()) == wanted


def test_audit_is_newest_day_first(spark):
    rows = landing.to_landing(records(spark, 4, "f1"), "b", "l1", AT).union(
        landing.to_landing(records(spark, 2, "f2"), "a", "l2", AT)
    ).union(landing.to_landing(records(spark, 1, "f3"), "a", "l3", datetime(2024, 3, 6)))
    got = [(str(r.load_date), r.source, r.rows_loaded, r.load_count, r.file_count) for r in landing.landing_audit(rows).collect()]
    assert got == [("2024-03-06", "a", 1, 1, 1), ("2024-03-05", "a", 2, 1, 1), ("2024-03-05", "b", 4, 1, 1)]


def test_audit_expands_only_file_rows(spark):
    rows = spark.createDataFrame([], schemas.LANDING)
    plan = landing.landing_audit(rows)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Expand") :]
    assert "Exchange hashpartitioning(source" in below and "partial_count(1)" in below


def test_streamed_landing_is_exactly_once(spark, scratch):
    raw = f"{scratch}/raw/s/2024/03/05"

    def land():
        land_new_files(spark, f"{scratch}/raw", f"{scratch}/landing", f"{scratch}/cp", "l", AT)
        return landing.read_landing(spark, f"{scratch}/landing").count()

    write_lines(spark, raw, '{"id":1}', "", '{"id":2}')
    assert land() == 2
    assert land() == 2
    write_lines(spark, raw, '{"id":3}')
    assert land() == 3
    assert landing.read_landing(spark, f"{scratch}/landing").first().source == "s"


def test_rows_of_one_source_are_not_moved_when_they_land(spark, scratch, monkeypatch):
    moved, stage = [], landing.stage_batch
    monkeypatch.setattr(landing, "stage_batch", lambda rows, path, gather=True: moved.append(gather) or stage(rows, path, gather))
    for run, sources in enumerate((["s"], ["s", "t"])):
        for source in sources:
            write_lines(spark, f"{scratch}/raw/{source}/2024/03/05", f'{{"id":{run}}}', '{"id":7}')
        land_new_files(spark, f"{scratch}/raw", f"{scratch}/landing", f"{scratch}/cp", f"l{run}", AT)
    assert moved == [False, True]
    rows = landing.read_landing(spark, f"{scratch}/landing")
    assert sorted(tuple(r) for r in rows.groupBy("load_id", "source").count().collect()) == [("l0", "s", 2), ("l1", "s", 2), ("l1", "t", 2)]


def test_streams_and_bulk_files_share_a_landing_table(spark, scratch):
    for name in ("a", "b"):
        write_lines(spark, f"{scratch}/{name}/raw/s/2024/03/05", '{"id":1}')
        land_new_files(spark, f"{scratch}/{name}", f"{scratch}/landing", f"{scratch}/cp-{name}", "l", AT)
    spark.range(3).coalesce(1).write.option("header", "true").csv(f"{scratch}/bulk")
    bulk.land_changed(spark, f"{scratch}/bulk", f"{scratch}/seen", f"{scratch}/landing", "s", "l", AT)
    assert landing.read_landing(spark, f"{scratch}/landing").count() == 5


def test_a_batch_that_failed_after_its_write_is_replaced(spark, scratch, monkeypatch):
    raw = f"{scratch}/raw/s/2024/03/05"
    write_lines(spark, raw, '{"id":1}', '{"id":2}')
    write = landing.write_batch

    def write_then_fail(*args):
        write(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(landing, "write_batch", write_then_fail)
    with pytest.raises(Exception):
        land_new_files(spark, f"{scratch}/raw", f"{scratch}/landing", f"{scratch}/cp", "l1", AT)
    assert landing.read_landing(spark, f"{scratch}/landing").count() == 2
    monkeypatch.undo()
    land_new_files(spark, f"{scratch}/raw", f"{scratch}/landing", f"{scratch}/cp", "l2", AT)
    rows = landing.read_landing(spark, f"{scratch}/landing")
    assert rows.count() == 2 and rows.first().load_id == "l2"


def test_streamed_landing_rejects_a_batch_with_a_bad_line(spark, scratch):
    write_lines(spark, f"{scratch}/raw/s/2024/03/05", '{"id":1}', "{bad")
    with pytest.raises(Exception):
        land_new_files(spark, f"{scratch}/raw", f"{scratch}/landing", f"{scratch}/cp", "l", AT)
    assert landing.read_landing(spark, f"{scratch}/landing").isEmpty()


def test_changed_files(spark, scratch):
    write_lines(spark, f"{scratch}/a", "1")
    seen = files.list_files(spark, scratch).collect()
    seen = spark.createDataFrame(seen)
    assert files.changed_files(files.list_files(spark, scratch), seen).isEmpty()
    write_lines(spark, f"{scratch}/b", "2")
    fresh = files.paths_of(files.changed_files(files.list_files(spark, scratch), seen))
    assert len(fresh) == 1 and "/b/" in fresh[0]
    assert "content" not in files.list_files(spark, scratch)._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_manifest(spark, scratch):
    write_lines(spark, f"{scratch}/raw/s/2024/03/05", "1", "2", "3")
    row = ndjson.manifest(ndjson.read_ndjson(spark, scratch)).first()
    assert (row.source, row.record_count, len(row.content_hash)) == ("s", 3, 16)


def test_split_uri():
    assert files.split_uri("s3://bucket/a/b/") == ("bucket", "a/b/")


def test_versions(spark, scratch):
    assert tables.current(spark, scratch) is None
    tables.publish(spark.range(3), scratch)
    tables.publish(spark.range(5), scratch)
    tables.publish(tables.current(spark, scratch).where("id < 4"), scratch)
    assert tables.current(spark, scratch).count() == 4
    assert tables.prune(spark, scratch, keep=2) == 1
    assert tables.current(spark, scratch).count() == 4


def test_scalar_and_empty_relations(spark):
    assert tables.scalar(spark.range(7).selectExpr("max(id)")) == 6
    assert tables.scalar(spark.range(0)) is None
    assert schemas.empty(spark, schemas.TRAINING_DATA).columns == ["placeholder_column", "target"]


def test_append_columns(spark):
    a = spark.createDataFrame([(1, 2)], "a int, b int")
    b = spark.createDataFrame([(3, 4)], "c int, a int")
    assert sorted(map(tuple, tables.append_columns(a, b).collect()), key=str) == [(1, 2, None), (4, None, 3)]


def test_bulk_files_are_landed_once(spark, scratch):
    folder, seen, table = f"{scratch}/bulk", f"{scratch}/seen", f"{scratch}/landing"
    first = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string").coalesce(1)
    first.write.option("header", "true").csv(f"{folder}/one")

    def land(load):
        done = bulk.land_changed(spark, folder, seen, table, "sales", load, AT)
        return done["status"], done["rowsLoaded"], done["filesLoaded"]

    assert land("l1") == ("LOADED", 2, 1)
    assert land("l2") == ("SKIPPED", 0, 0)
    spark.createDataFrame([("x", 5.5)], "other string, id double").coalesce(1).write.option("header", "true").csv(f"{folder}/two")
    assert land("l3") == ("LOADED", 1, 1)
    rows = landing.from_source(landing.read_landing(spark, table), "sales")
    got = {r.j for r in rows.select(F.to_json("data").alias("j")).collect()}
    assert got == {'{"id":"1","name":"a"}', '{"id":"2","name":null}', '{"id":"5.5","other":"x"}'}


def test_bulk_landing_repeated_after_a_failure_adds_nothing(spark, scratch):
    folder, table = f"{scratch}/bulk", f"{scratch}/landing"
    spark.range(3).coalesce(1).write.option("header", "true").csv(folder)
    bulk.land_changed(spark, folder, f"{scratch}/seen", table, "k", "l1", AT)
    done = bulk.land_changed(spark, folder, f"{scratch}/never_written", table, "k", "l1", AT)
    assert done["rowsLoaded"] == 3 and landing.read_landing(spark, table).count() == 3


def test_a_write_repeated_on_another_day_replaces_the_first(spark, scratch):
    from datetime import datetime

    from pyspark.sql import functions as F

    from recordmill.sources import landing

    records = spark.range(2).select(F.lit("f").alias("file_path"), F.parse_json(F.lit("{}")).alias("data"))
    for at in (datetime(2024, 1, 1, 23, 59), datetime(2024, 1, 2, 0, 5)):
        landing.write_batch(landing.to_landing(records, "s", "load-1", at), scratch, "load-1")
    landing.write_batch(landing.to_landing(records, "s", "load-2", at), scratch, "load-2")
    assert landing.read_landing(spark, scratch).groupBy("load_id").count().orderBy("load_id").collect() == [("load-1", 2), ("load-2", 2)]


def test_text_with_quotes_commas_and_breaks_comes_back(spark, scratch):
    from recordmill.sources import csv

    rows = [("1", 'a "q", x'), ("2", "two\nlines"), ("3", ""), ("4", None), ("5", "back\\slash")]
    told = csv.export_csv(spark.createDataFrame(rows, "id string, text string"), scratch, "r")
    back = csv.read_training(spark, told["path"], {"id": "string", "text": "string"})
    assert sorted(tuple(r) for r in back.collect()) == [(i, t or None) for i, t in rows]


def test_prune_keeps_complete_versions(spark, scratch):
    from recordmill.sources import tables

    good = tables.publish(spark.range(3), scratch)
    for name in ("v99990101T000000000000-a", "v99990102T000000000000-b"):
        spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{scratch}/{name}")
    assert tables.prune(spark, scratch, keep=2) == 0 and tables.current(spark, scratch).count() == 3 and good


def landed(spark, path):
    return sorted((r.load_id, r.source, r.n) for r in landing.read_landing(spark, path).groupBy("load_id", "source").agg(F.count("*").alias("n")).collect())


def test_two_sources_share_a_name(spark, scratch):
    for source, n in (("a", 2), ("b", 3)):
        landing.write_batch(landing.to_landing(records(spark, n), source, "load-1", AT), scratch, "load-1")
    assert landed(spark, scratch) == [("load-1", "a", 2), ("load-1", "b", 3)]
    landing.write_batch(landing.to_landing(records(spark, 5), "a", "load-1", AT), scratch, "load-1")
    assert landed(spark, scratch) == [("load-1", "a", 5), ("load-1", "b", 3)]


def test_an_owner_replaces_sources_that_its_retry_lacks(spark, scratch):
    both = landing.to_landing(records(spark, 2), "a", "l", AT).union(landing.to_landing(records(spark, 1), "b", "l", AT))
    landing.write_batch(both, scratch, "7", "stream")
    landing.write_batch(landing.to_landing(records(spark, 4), "c", "l", AT), scratch, "7", "other")
    landing.write_batch(both.where("source = 'b'"), scratch, "7", "stream")
    assert landed(spark, scratch) == [("l", "b", 1), ("l", "c", 4)]
    landing.write_batch(both.limit(0), scratch, "7", "stream")
    assert landed(spark, scratch) == [("l", "c", 4)]
    assert landing.drop_unseen(spark, scratch) > 0 and landed(spark, scratch) == [("l", "c", 4)]


def test_a_crash_before_the_commit_shows_the_old_rows(spark, scratch, monkeypatch):
    landing.write_batch(landing.to_landing(records(spark, 2), "a", "l", AT), scratch, "x")
    monkeypatch.setattr(landing, "commit_batch", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        landing.write_batch(landing.to_landing(records(spark, 9), "a", "l", AT), scratch, "x")
    assert landed(spark, scratch) == [("l", "a", 2)]


def test_bulk_files_of_one_load_are_remembered_with_their_commit(spark, scratch, monkeypatch):
    def put(name, n):
        spark.range(n).coalesce(1).write.option("header", "true").csv(f"{scratch}/{name}")

    def land(source, load="l1"):
        done = bulk.land_changed(spark, f"{scratch}/{source}", f"{scratch}/seen", f"{scratch}/landing", source, load, AT)
        return done["rowsLoaded"], done["filesLoaded"]

    put("a/1", 2), put("b/1", 3)
    assert land("a") == (2, 1) and land("b") == (3, 1)
    put("a/2", 4)
    commit = landing.commit_batch
    monkeypatch.setattr(landing, "commit_batch", lambda *args: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        land("a")
    monkeypatch.setattr(landing, "commit_batch", commit)
    assert land("a") == (4, 1) and land("a") == (0, 0) and land("b") == (0, 0)
    assert landed(spark, f"{scratch}/landing") == [("l1", "a", 6), ("l1", "b", 3)]


def test_summary_and_audit_read_no_record(spark, scratch):
    landing.write_batch(landing.to_landing(records(spark, 4, "f1"), "b", "l1", AT), scratch, "1")
    landing.write_batch(landing.to_landing(records(spark, 2, "f2"), "b", "l2", AT), scratch, "2")
    rows, counted = landing.read_landing(spark, scratch), landing.landed_files(spark, scratch)
    assert landing.audit_of(counted).collect() == landing.landing_audit(rows).collect()
    assert sorted(landing.summary_of(counted).collect()) == sorted(landing.load_summary(rows).collect())
    assert "/rows" not in counted._jdf.queryExecution().executedPlan().toString()


def test_log_numbers_are_taken_once_and_snapshots_keep_what_counts(spark, scratch):
    from pyspark.sql import types as T

    from recordmill.sources.commits import Conflict, Log

    columns = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    log = Log(spark, scratch, columns, ["k"], snapshot_after=4)
    assert log.newest() == 0 and log.current().isEmpty()
    for i in range(11):
        assert log.publish([{"k": f"k{i % 3}", "v": i}, {"k": f"k{i % 3}", "v": -i}]) == i + 1
    assert sorted((r.k, r.v) for r in log.current().collect()) == sorted([("k0", 9), ("k0", -9), ("k1", 10), ("k1", -10), ("k2", 8), ("k2", -8)])
    with pytest.raises(Conflict):
        log.publish([{"k": "x", "v": 0}], after=10)
    assert log.publish([{"k": "x", "v": 0}], after=11) == 12
    assert not log._take(12, "")
    names = log._names()
    assert sum(n.endswith(".json") for n in names) <= 9 and sum(n.startswith("snapshot") for n in names) <= 2


def test_a_drop_is_passed_over_once_and_told_by_its_whole_fingerprint(spark, scratch):
    passes = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            passes.add(len(batch))
            yield batch

    rows = spark.range(50).mapInPandas(count, "id long")
    done = ndjson.write_raw(rows, scratch, "src", AT, "r")
    assert passes.value == 50 and done["recordCount"] == 50
    store, path = tables.file_system(spark, f"{scratch}/{done['s3Key']}/_fingerprint")
    assert ndjson.write_raw(spark.range(50), scratch, "src", AT, "r") == done
    out = store.create(path, True)
    out.write(bytearray(b"other 50"))
    out.close()
    with pytest.raises(ValueError, match="holds other records"):
        ndjson.write_raw(spark.range(50), scratch, "src", AT, "r")
    assert ndjson.read_ndjson(spark, scratch).count() == 50
    assert tables.subfolders(spark, f"{scratch}/raw") == [f for f in tables.subfolders(spark, f"{scratch}/raw") if "/_" not in f]


def test_quoted_prediction_cells(spark, scratch):
    from recordmill.sources import csv

    spark.createDataFrame([('"a ""q"", x",1',), ("plain,2",), ('"",3',)], "value string").coalesce(1).write.text(f"{scratch}/o")
    import glob
    import os

    part = glob.glob(f"{scratch}/o/part-*")[0]
    os.link(part, f"{scratch}/o/x.out")
    rows = csv.read_predictions(spark, f"{scratch}/o", "l", AT)
    assert sorted(r.prediction for r in rows.collect()) == ["", 'a "q", x', "plain"]
