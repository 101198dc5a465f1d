import hashlib
import os
import time

import pytest
from evidence_rows import T0, T1
from pyspark.sql import functions as F

from claimweave.session import folder_names, scratch_removed, staged, staged_bytes
from claimweave.sources import versions


def frame(spark, rows):
    df = spark.createDataFrame(rows, "id long, v string")
    return df.withColumn("row_hash", F.sha2("v", 256))


def content(spark, path):
    return {r.id: r.v for r in versions.read_table(spark, path).collect()}


def files(path):
    return {os.path.join(d, n): os.stat(os.path.join(d, n)).st_mtime_ns for d, _, names in os.walk(path) for n in names if n[:5] == "part-"}


def test_upsert_changes_only_what_differs(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not versions.table_exists(spark, path)
    assert versions.upsert(frame(spark, [(1, "a"), (2, "b")]), path, "id", at=T0)["operation"] == "CREATE"
    second = versions.upsert(frame(spark, [(2, "B"), (3, "c"), (1, "a")]), path, "id", at=T1)
    assert (second["inserted"], second["updated"]) == (1, 1)
    assert content(spark, path) == {1: "a", 2: "B", 3: "c"}
    stamps = {r.id: r._silver_updated_at for r in versions.read_table(spark, path).collect()}
    assert stamps[1] < stamps[2] == stamps[3]
    # Keys missing from the source stay.
    versions.upsert(frame(spark, [(3, "C")]), path, "id")
    assert content(spark, path) == {1: "a", 2: "B", 3: "C"}


def test_a_rerun_writes_nothing_and_reads_are_plain_scans(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = frame(spark, [(i, str(i)) for i in range(500)])
    versions.upsert(rows, path, "id")
    before = files(path)
    again = versions.upsert(rows, path, "id")
    assert (again["inserted"], again["updated"]) == (0, 0) and files(path) == before
    versions.upsert(frame(spark, [(7, "x")]), path, "id")
    after = files(path)
    assert 0 < len(before.keys() - after.keys()) <= 2
    assert len(content(spark, path)) == 500
    plan = versions.read_table(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_a_new_column_is_kept(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.upsert(frame(spark, [(i, "a") for i in range(300)]), path, "id")
    wider = frame(spark, [(i, "b") for i in range(300)]).withColumn("more", F.lit(1))
    versions.upsert(wider, path, "id")
    assert versions.read_table(spark, path).agg(F.sum("more")).first()[0] == 300


def test_overwrite_replaces_content_and_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.overwrite(spark.range(3), path)
    versions.overwrite(versions.read_table(spark, path).select(F.col("id").alias("other")).limit(2), path)
    found = versions.read_table(spark, path)
    assert set(found.columns) == {"other", "_silver_updated_at"} and found.count() == 2
    with pytest.raises(ValueError, match="No table"):
        versions.read_table(spark, str(tmp_path / "none"))


def test_change_kinds(spark):
    old, new = frame(spark, [(1, "a"), (2, "b"), (3, "c")]), frame(spark, [(2, "b"), (3, "C"), (4, "d")])
    kinds = {r.id: r.change for r in versions.classify_changes(old, new, "id").collect()}
    assert kinds == {1: "kept", 2: "unchanged", 3: "update", 4: "insert"}


def test_a_large_bucket_is_several_tasks_and_files(spark, tmp_path):
    path = str(tmp_path / "t")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name, None)
    try:
        spark.conf.set(name, "64k")
        rows = spark.range(0, 120_000, 1, 8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v"))
        versions.upsert(rows.withColumn("row_hash", F.col("v")), path, "id")
        sizes = {d: len(part) for d, _, names in os.walk(path) if (part := [n for n in names if n[:5] == "part-"])}
        assert max(sizes.values()) > 1 and sum(sizes.values()) > 20
        versions.upsert(rows.where("id = 5").withColumn("row_hash", F.lit("x")), path, "id")
        assert versions.read_table(spark, path).count() == 120_000
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def test_small_buckets_share_a_task(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.upsert(frame(spark, [(i, str(i)) for i in range(500)]), path, "id")
    tasks = {n.split("-")[1] for d, _, names in os.walk(path) for n in names if n[:5] == "part-" and "=-1" not in d}
    assert len(tasks) == 1


def test_an_outgrown_table_gets_more_buckets(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.upsert(frame(spark, [(i, str(i)) for i in range(500)]), path, "id")
    monkeypatch.setattr(versions, "BUCKET_BYTES", 500)
    monkeypatch.setattr(versions, "LEAST_BUCKETS", 1)
    versions.upsert(frame(spark, [(i, f"new {i}") for i in range(700)]), path, "id")
    assert [d for d in os.listdir(path) if d.startswith("_of=")] != ["_of=8"]
    assert content(spark, path) == {i: f"new {i}" for i in range(700)}


def test_an_empty_table_has_a_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.create(frame(spark, []).withColumn(versions.UPDATED_AT, versions.stamp(T0)), path, "id")
    assert versions.read_table(spark, path).columns == ["id", "v", "row_hash", "_silver_updated_at"]
    assert versions.upsert(frame(spark, [(1, "a")]), path, "id")["inserted"] == 1
    assert content(spark, path) == {1: "a"}


def test_a_bucket_without_rows_goes(spark, tmp_path):
    path, folder = str(tmp_path / "t"), str(tmp_path / "staged")
    versions.create(frame(spark, [(1, "a"), (2, "b")]), path, "id")
    gone = spark.createDataFrame([(1,)], "id long")
    touched = versions.stage_buckets(frame(spark, []), path, "id", folder, gone)
    versions.publish_buckets(spark, folder, path, touched)
    assert content(spark, path) == {2: "b"}


def test_hashes_travel_as_bytes_and_come_back_as_they_were(spark):
    digest = hashlib.sha256(b"x").hexdigest()
    texts = [digest, digest.upper(), "abc", "zz", "", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, row_hash string")
    narrow = versions._narrowed(rows)
    assert [bytes(r[0]) for r in narrow.where("id = 0").select(f"{versions.AS_BYTES}row_hash").collect()] == [bytes.fromhex(digest)]
    assert [r.row_hash for r in narrow.where("id = 0").collect()] == [None]
    back = versions._widened(narrow)
    assert back.columns == rows.columns and {r.id: r.row_hash for r in back.collect()} == dict(enumerate(texts))


def test_a_staged_table_is_not_copied_before_it_is_dealt_out(spark, tmp_path, monkeypatch):
    rows = staged(spark.range(10).withColumn("row_hash", F.sha2(F.col("id").cast("string"), 256)), "rows")
    monkeypatch.setattr(versions, "scratch_dir", lambda *_: pytest.fail("copied"))
    path = f"{tmp_path}/t"
    assert versions.create(rows, path, "id", staged_bytes(rows)) == 10
    assert sorted(r.id for r in versions.read_table(spark, path).collect()) == list(range(10))


def test_intermediate_tables_go_at_the_end(spark):
    with scratch_removed(spark):
        table = staged(spark.range(3), "passing")
        folder = table.inputFiles()[0].rpartition("/")[0]
        assert table.count() == 3 and folder_names(spark, folder)
    assert not folder_names(spark, folder)
    assert staged(spark.range(3), "staying").count() == 3


def test_a_large_table_is_dealt_out_in_passes(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).select(F.when(F.col("id") > 0, F.col("id")).alias("id"), F.sha2(F.col("id").cast("string"), 256).alias("row_hash"))
    path, write, sizes = f"{tmp_path}/t", versions._write, []

    def counted(df, target, replace="static"):
        sizes.append(df.count())
        write(df, target, replace)

    monkeypatch.setattr(versions, "_write", counted)
    assert versions.create(rows.limit(10), path, "id") == 10 and len(sizes) == 1
    monkeypatch.setattr(versions, "LARGE_BYTES", 0)
    assert versions.create(rows, path, "id") == 1000
    assert len(sizes[1:]) == versions.PASSES and sum(sizes[1:]) == 1000 and max(sizes[1:]) < 600
    back = versions.read_table(spark, path)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, rows.collect()))


def test_shuffle_files_go_with_their_query(spark, tmp_path):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled() -> set[str]:
        found = disk.getAllFiles()
        names = (found.apply(i).getName() for i in range(found.size()))
        return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}

    before = shuffled()
    with scratch_removed(spark):
        staged(spark.range(1000).repartition(5, "id"), "dealt")
        for _ in range(50):
            if not (left := shuffled() - before):
                break
            time.sleep(0.1)
        assert not left
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
