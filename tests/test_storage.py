from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.catalog.tables import land_csv
from tidemark.operators.merge import DuplicateSourceKeys, replace_slice, upsert
from tidemark.sources.keyed import read_keyed
from tidemark.schemas import SOURCES, Layout
from tidemark.sources import bronze, files, run_log, scratch, snapshot, warehouse


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_csv_reader_keeps_text_and_nulls(spark, tmp_path):
    path = str(tmp_path / "c")
    given = [("C1", '  padded "quoted", comma ', None), ("C2", "", "x")]
    df = spark.createDataFrame(given, "customer_id STRING, first_name STRING, last_name STRING")
    land_csv(df, path)
    read = files.ingest_csv(spark, path, "customers", df.schema, batch_id="b1")
    assert rows(read.filter("customer_id = 'C1'"), "customer_id", "first_name", "last_name") == [given[0]]
    audit = read.head()
    assert audit["_source_system"] == "csv/customers" and audit["_batch_id"] == "b1"
    assert audit["_source_file"].endswith(".csv") and audit["_ingestion_timestamp"] is not None


def test_csv_reader_infers_types(spark, tmp_path):
    path = str(tmp_path / "c")
    land_csv(spark.createDataFrame([("a", 1, 2.5)], "k STRING, n INT, d DOUBLE"), path)
    read = files.ingest_csv(spark, path, "t")
    assert dict(read.dtypes)["n"] == "int" and dict(read.dtypes)["d"] == "double"


def test_json_reader_reads_arrays(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"k": "a",\n "n": 1}, {"k": "b"}]')
    (tmp_path / "b.json").write_text('{"k": "c",\n "n": 3}')
    read = files.ingest_json(spark, str(tmp_path), "t", spark.createDataFrame([], "k STRING, n INT").schema)
    assert rows(read.na.fill(0), "k", "n") == [("a", 1), ("b", 0), ("c", 3)]


def test_quarantine(spark, tmp_path):
    (tmp_path / "o.csv").write_text(
        "order_id,customer_id,order_date,status,total_amount,shipping_cost,payment_method,shipping_address\n"
        "O1,C1,2024-01-01T00:00:00,pending,1.5,0.5,card,here\n"
        "O2,C1,2024-01-01T00:00:00,pending,many,0.5,card,here\n"
        "O3,,2024-01-01T00:00:00,pending,1.5,0.5,card,here\n"
        "O4,C1,not a date,pending,1.5,,card,here\n"
        "O5,C1,2024-01-01T00:00:00,pending,1.5,0.5,card,here,extra,fields\n"
    )
    checked = files.ingest_csv_checked(spark, str(tmp_path / "o.csv"), "orders", SOURCES["orders"].schema)
    assert [r["order_id"] for r in checked.valid.collect()] == ["O1"]
    assert dict(checked.valid.dtypes)["total_amount"] == "double"
    assert checked.valid.select("order_id").count() == 1  # the verdict does not depend on the columns asked for
    reasons = {r["order_id"]: r["_reject_reason"] for r in checked.rejected.collect()}
    assert reasons == {"O2": "malformed record", "O3": "missing customer_id", "O4": "malformed record", "O5": "malformed record"}


def test_partition_overwrite_keeps_other_dates(spark, tmp_path):
    path = str(tmp_path / "b")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-02")], "id INT, d STRING")
    df = df.withColumn("d", F.to_date("d"))
    bronze.write_bronze(df.withColumn("load", F.lit(1)), path, ["d"])
    bronze.write_bronze(df.filter("id = 2").withColumn("load", F.lit(2)), path, ["d"])
    assert rows(spark.read.parquet(path), "id", "load") == [(2, 2), (3, 1)]


def test_snapshot_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not snapshot.snapshot_exists(spark, path)
    with pytest.raises(FileNotFoundError):
        snapshot.read_snapshot(spark, path)
    snapshot.write_snapshot(spark.range(3), path)
    snapshot.write_snapshot(snapshot.read_snapshot(spark, path).withColumn("x", F.lit(1)), path)
    assert snapshot.current_version(spark, path) == 2
    assert snapshot.read_snapshot(spark, path).columns == ["id", "x"]


def test_unfinished_version_is_ignored(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshot.write_snapshot(spark.range(3), path)
    (tmp_path / "t" / "version=00000002").mkdir()  # a job that died before its commit
    assert snapshot.read_snapshot(spark, path).count() == 3
    snapshot.write_snapshot(spark.range(5), path)
    assert snapshot.current_version(spark, path) == 3 and snapshot.read_snapshot(spark, path).count() == 5


def test_compact_keeps_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    snapshot.write_snapshot(spark.range(100).repartition(9), path)
    assert len(snapshot.read_snapshot(spark, path).inputFiles()) == 9
    assert snapshot.compact(spark, path, files=2).count() == 100
    assert len(snapshot.read_snapshot(spark, path).inputFiles()) == 2
    assert snapshot.compact(spark, path).count() == 100


def test_upsert_updates_inserts_and_repeats(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark.createDataFrame([("a", 1), ("b", 2)], "k STRING, v INT"), path, "k")
    change = spark.createDataFrame([("b", 20), ("c", 30)], "k STRING, v INT")
    assert upsert(change, path, "k") == 2
    expected = [("a", 1), ("b", 20), ("c", 30)]
    assert rows(read_keyed(spark, path), "k", "v") == expected
    upsert(change, path, "k")
    assert rows(read_keyed(spark, path), "k", "v") == expected


def test_upsert_stores_no_copy_of_the_table(spark, tmp_path, monkeypatch):
    path, stored = str(tmp_path / "t"), []

    def counted(df, label):
        found = scratch.materialise(df, label)
        stored.append(found[1])
        return found

    monkeypatch.setattr("tidemark.sources.keyed.materialise", counted)
    upsert(spark.range(400).selectExpr("CAST(id AS STRING) AS k", "0 AS n"), path, "k", check_keys=False)
    # Two keys change, one leaves; all buckets are touched by the third upsert and some are emptied by the last.
    changed = spark.createDataFrame([("7", 1), ("8", 1)], "k STRING, n INT")
    upsert(changed, path, "k", check_keys=False, replaces=spark.createDataFrame([("9",)], "k STRING"))
    assert sum(stored) < 20
    assert rows(read_keyed(spark, path).filter("n = 1 OR k = '9'"), "k") == [("7",), ("8",)] and read_keyed(spark, path).count() == 399
    upsert(changed, path, "k", check_keys=False, replaces=spark.range(9, 400).selectExpr("CAST(id AS STRING) AS k"))
    assert rows(read_keyed(spark, path), "k") == [(str(k),) for k in range(9)]
    upsert(changed.limit(0), path, "k", check_keys=False, replaces=spark.range(400).selectExpr("CAST(id AS STRING) AS k"))
    assert read_keyed(spark, path).count() == 0 and read_keyed(spark, path).columns == ["k", "n"]
    upsert(changed, path, "k", check_keys=False)
    assert rows(read_keyed(spark, path), "k") == [("7",), ("8",)]


def test_keyed_files_hold_no_dictionary_of_the_key_and_no_ranges_of_audit_texts(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark.range(5).selectExpr("CAST(id AS STRING) AS k", "'f' AS _source_file"), path, "k", check_keys=False)
    for file in tmp_path.glob("t/*/*/*.parquet"):
        held = pq.ParquetFile(file).metadata.row_group(0)
        key, source = held.column(0), held.column(1)
        assert not any("DICTIONARY" in e for e in key.encodings) and key.statistics is not None
        assert source.statistics is None or not source.statistics.has_min_max


def test_upsert_extends_the_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark.createDataFrame([("a", 1)], "k STRING, v INT"), path, "k")
    upsert(spark.createDataFrame([("b", 2, "new")], "k STRING, v INT, w STRING"), path, "k")
    got = {r["k"]: r["w"] for r in read_keyed(spark, path).collect()}
    assert got == {"a": None, "b": "new"}


def test_upsert_rejects_repeated_keys(spark, tmp_path):
    with pytest.raises(DuplicateSourceKeys, match="'a'"):
        upsert(spark.createDataFrame([("a", 1), ("a", 2)], "k STRING, v INT"), str(tmp_path / "t"), "k")


def test_replace_slice(spark, tmp_path):
    path = str(tmp_path / "t")
    base = [("a", datetime(2024, 1, 1, 5)), ("b", datetime(2024, 1, 1, 6)), ("c", datetime(2024, 1, 2)), ("d", None)]
    upsert(spark.createDataFrame(base, "k STRING, at TIMESTAMP"), path, "k")
    # b is gone, e is new, and c moved from the second day to the first.
    again = [("a", datetime(2024, 1, 1, 9)), ("e", datetime(2024, 1, 1)), ("c", datetime(2024, 1, 1))]
    replace_slice(spark.createDataFrame(again, "k STRING, at TIMESTAMP"), path, "k", "at", "2024-01-01")
    assert {r["k"]: r["at"] for r in read_keyed(spark, path).collect()} == dict(again) | {"d": None}


def test_ingest_all_error_handling(spark, tmp_path, raw_orders):
    layout = Layout(str(tmp_path))
    land_csv(raw_orders.withColumn("shipping_address", F.lit("here")), layout.landing("orders"))
    got = {r.table: r for r in bronze.ingest_all(spark, layout, "b", ["orders", "reviews"], on_error="continue")}
    assert got["orders"].rows == 8 and got["orders"].error is None
    assert got["reviews"].rows == 0 and "reviews" in got["reviews"].error
    with pytest.raises(Exception, match="reviews"):
        bronze.ingest_all(spark, layout, "b", ["orders", "reviews"])
    stored = spark.read.parquet(layout.bronze("orders"))
    assert stored.count() == 8 and "_partition_date" in stored.columns


def test_ingest_from_config(spark, tmp_path, raw_orders):
    land_csv(raw_orders.withColumn("shipping_address", F.lit("here")), str(tmp_path / "in" / "erp" / "orders"))
    config = spark.createDataFrame([("orders", "erp/orders")], "tableName STRING, sourcePath STRING")
    loaded = bronze.ingest_from_config(spark, config, str(tmp_path / "in"), str(tmp_path / "out"), date(2024, 2, 3))
    assert [(r.table, r.rows) for r in loaded] == [("orders", 8)]
    target = tmp_path / "out" / "orders" / "2024" / "02" / "03"
    assert spark.read.parquet(str(target)).count() == 8 and list(target.glob("*.snappy.parquet"))


def test_warehouse_load_replaces(spark, tmp_path):
    sink = warehouse.ParquetSink(str(tmp_path))
    warehouse.load_warehouse({"t": spark.range(5)}, sink)
    warehouse.load_warehouse({"t": spark.range(3)}, sink)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    step = run_log.StepRecord("r1", "etl", "data_quality", "all", "failed", 0, 3, "bad", run_log.now())
    run_log.append_steps(spark, path, [step])
    run_log.append_steps(spark, path, [])
    run_log.append_steps(spark, path, [step, step])
    assert run_log.read_run_log(spark, path).count() == 3


def test_materialise_counts_while_writing(spark):
    df, n = scratch.materialise(spark.range(7).withColumn("x", F.lit(1)), "t")
    assert n == 7 and df.count() == 7 and df.columns == ["id", "x"]
    assert df.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(spark.conf.get("spark.checkpoint.dir").lstrip("/"))


def test_scratch_on_a_cluster_needs_a_shared_folder():
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "yarn", "app-1"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.scratch_root(Session())


def test_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    from tidemark.sources import keyed

    path = str(tmp_path / "b")
    df = spark.range(400).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    assert keyed.write_keyed(df, path, "k", buckets=16) == 400
    first = set(keyed.read_keyed(spark, path).inputFiles())
    change = spark.createDataFrame([("7", 2), ("new", 3)], "k STRING, v INT")
    gone = spark.createDataFrame([("8",), ("7",)], "k STRING")
    assert keyed.upsert_keyed(change, path, "k", replaces=gone) == 2
    table = keyed.read_keyed(spark, path)
    assert 1 <= len(set(table.inputFiles()) - first) <= 3
    got = {r["k"]: r["v"] for r in table.collect()}
    assert len(got) == 400 and "8" not in got and got["7"] == 2 and got["new"] == 3 and got["9"] == 1
    change = change.withColumn("w", F.lit("x"))
    keyed.upsert_keyed(change, path, "k")
    got = {r["k"]: (r["v"], r["w"]) for r in keyed.read_keyed(spark, path).collect()}
    assert len(got) == 400 and got["7"] == (2, "x") and got["9"] == (1, None)
    keyed.upsert_keyed(change.limit(0), path, "k", replaces=df.select("k"))
    assert keyed.read_keyed(spark, path).select("k").collect() == [("new",)]
    keyed.write_keyed(df.limit(0), str(tmp_path / "empty"), "k", buckets=4)
    assert keyed.read_keyed(spark, str(tmp_path / "empty")).columns == ["k", "v"]
    keyed.upsert_keyed(change.filter("k = '7'"), path, "k")
    assert sorted(r["k"] for r in keyed.read_keyed(spark, path).collect()) == ["7", "new"]


def test_a_keyed_table_is_written_without_staging_or_shuffle_and_stays_until_then(spark, tmp_path):
    from tidemark.sources import keyed, scratch

    path = str(tmp_path / "t")
    df = spark.range(1000, numPartitions=1).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    made = []
    scratch._scopes.append(made)
    try:
        assert keyed.write_keyed(df, path, "k", buckets=16) == 1000
        few = df.filter("k IN ('1', '2')").withColumn("w", F.lit("x"))
        assert keyed.write_keyed(few, path, "k", buckets=8) == 2
    finally:
        scratch._scopes.remove(made)
    assert made == []  # no scratch table
    table = keyed.read_keyed(spark, path)
    assert sorted(table.collect()) == [("1", 1, "x"), ("2", 1, "x")]
    bad = df.withColumn("v", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        keyed.write_keyed(bad, path, "k", buckets=8)
    assert sorted(keyed.read_keyed(spark, path).collect()) == [("1", 1, "x"), ("2", 1, "x")]
    assert keyed.write_keyed(few.limit(0), path, "k", buckets=8) == 0
    assert keyed.read_keyed(spark, path).count() == 0 and keyed.read_keyed(spark, path).columns == ["k", "v", "w"]


def test_bronze_files_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "FILE_ROWS", 10)
    bronze.write_bronze(spark.range(25, numPartitions=1), str(tmp_path / "b"))
    assert len(spark.read.parquet(str(tmp_path / "b")).inputFiles()) == 3


def test_snapshots_keep_two_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        snapshot.write_snapshot(spark.range(n), path)
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.is_dir()) == ["version=00000003", "version=00000004"]


def test_scratch_scope_deletes_what_was_made_inside(spark):
    import os

    from tidemark.sources import scratch

    with scratch.scratch_scope(spark):
        table, _ = scratch.materialise(spark.range(3), "scoped")
        path = table.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_a_users_setting_comes_back_after_writes_of_several_threads(spark):
    from concurrent.futures import ThreadPoolExecutor
    from time import sleep

    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)

    def write(seconds):
        with bronze._setting(spark, name, "false"):
            sleep(seconds)
            return spark.conf.get(name)

    try:
        for own in ("true", "false"):
            spark.conf.set(name, own)
            with ThreadPoolExecutor(4) as pool:
                assert set(pool.map(write, [0.2, 0.05, 0.1, 0.0])) == {"false"}
            assert spark.conf.get(name) == own and not bronze._settings_held
    finally:
        spark.conf.set(name, before)


def test_keyed_write_keeps_a_file_open_for_every_bucket(spark, tmp_path, monkeypatch):
    """Rows are not sorted by bucket; more buckets than files may be open give the same table."""
    from tidemark.sources import keyed

    held = []
    real = keyed.setting
    monkeypatch.setattr(keyed, "setting", lambda session, name, value: held.append((name, value)) or real(session, name, value))
    df = spark.range(0, 3000, 1, 2).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("v"))
    for buckets in (16, 100):
        path = str(tmp_path / str(buckets))
        assert keyed.write_keyed(df, path, "k", buckets=buckets) == 3000
        assert rows(read_keyed(spark, path), "k", "v") == rows(df, "k", "v")
    assert held == [keyed.OPEN_FILES] * 2 and spark.conf.get(keyed.OPEN_FILES[0]) == "0"
