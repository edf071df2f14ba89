"""Readers, writers, tables and the merge stream."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tests.conftest import DATA, rows
from tradewind import schemas
from tradewind.catalog import ENTRIES
from tradewind.operators import quality, scd
from tradewind.plans import cleaning
from tradewind.session import scratch_path, stage, staging_root
from tradewind.sources import files, tables
from tradewind.streaming import incremental

ODD = [(1, 'Frame 14 7/8""', 2.5), (2, "two\nlines, and a comma", 3.0), (3, '"quoted"', None),
       (4, " padded ", -1.0), (5, "back\\slash", 0.0)]


@pytest.mark.parametrize("schema", [None, "id int, name string, price double"])
def test_csv_fields_stay_in_their_column(spark, tmp_path, schema):
    df = spark.createDataFrame(ODD, "id int, name string, price double")
    files.write_csv(df, str(tmp_path / "odd"))
    got = files.read_csv(spark, str(tmp_path / "odd"), schema, multiline=True)
    assert rows(got) == rows(df)


def test_delivered_csv_with_doubled_quotes(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,name,price\n1,"Frame 14 7/8"", black",2.5\n2,plain,3\n')
    got = files.read_csv(spark, str(path))
    assert rows(got) == [(1, 'Frame 14 7/8", black', 2.5), (2, "plain", 3.0)]


def test_output_must_not_be_the_input(spark, tmp_path):
    path = str(tmp_path / "t")
    df = files.write_parquet(spark.range(5).toDF("id"), path)
    for write in (files.write_parquet, files.write_csv):
        with pytest.raises(ValueError, match="stage to a new path"):
            write(df.filter("id > 1"), path)
    assert files.read_parquet(spark, path).count() == 5


def test_export_is_one_file(spark, tmp_path):
    files.export_csv(spark.range(100).repartition(5), str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("*.csv"))) == 1


def test_metadata_and_copy(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    files.write_csv(spark.createDataFrame(ODD[:1], "id int, name string, price double"), a)
    (meta,) = files.source_metadata(spark, a, "csv", header=True).filter("row_count > 0").collect()
    assert meta.column_count == 3 and meta.row_count == 1 and meta.file_size > 0
    assert rows(files.copy_dataset(spark, a, b)) == [(1, 1, 3)]
    assert rows(files.read_csv(spark, b)) == ODD[:1]


def test_metadata_of_empty_files_and_absent_paths(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "full.csv").write_text("a,b\n1,2\n3,4\n")
    (folder / "header only.csv").write_text("a,b\n")
    (folder / "nothing.csv").write_text("")
    got = {r.file_path.rpartition("/")[2].replace("%20", " "): r for r in files.source_metadata(spark, str(folder), "csv", header=True).collect()}
    assert {n: (r.file_size, r.row_count, r.column_count, r.exists) for n, r in got.items()} == {
        "full.csv": (12, 2, 2, True), "header only.csv": (4, 0, 2, True), "nothing.csv": (0, 0, 2, True)}
    (only,) = files.source_metadata(spark, str(folder / "nothing.csv"), "csv", header=True).collect()
    assert only.file_size == 0 and only.row_count == 0 and only.exists
    (none,) = files.source_metadata(spark, str(tmp_path / "absent")).collect()
    assert not none.exists and none.file_size is None and none.row_count == 0


def test_own_input_is_found_by_its_root(spark, tmp_path):
    """Also below a join, in a subquery, and if a part of the input is to be overwritten."""
    path = str(tmp_path / "t")
    df = files.write_parquet(spark.range(5).withColumn("p", F.col("id") % 2), path)
    spark.range(3).write.parquet(f"{path}/part")
    other = spark.range(9)
    for bad in (other.join(df, "id", "left_semi"), other.filter(F.col("id") < df.agg(F.max("id")).scalar())):
        with pytest.raises(ValueError, match="stage to a new path"):
            files.write_parquet(bad, path)
    with pytest.raises(ValueError, match="stage to a new path"):
        files.write_parquet(df, f"{path}/part")
    files.write_parquet(df, str(tmp_path / "t2"))
    assert files.input_roots(df) == [f"file:{path}"]


def test_managed_table_and_runs_side_by_side(spark):
    entry = ENTRIES["save_table"]
    before = {t.name for t in spark.catalog.listTables()}
    with ThreadPoolExecutor(2) as pool:
        a, b = pool.map(lambda _: rows(entry.run(spark, DATA)), range(2))
    assert a == b and len(a) > 100
    assert {t.name for t in spark.catalog.listTables()} == before
    assert tables.fresh_name("x") != tables.fresh_name("x")


def test_table_can_replace_itself(spark):
    name = "replace_me"
    df = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    table = tables.save_table(df, name, scratch_path(spark, name))
    got = tables.replace_table(table.distinct(), name, scratch_path(spark, name))
    assert rows(got) == [(1,), (2,)]
    assert rows(tables.read_table(spark, name)) == [(1,), (2,)]


def test_load_rejects_broken_rows(spark, retail):
    done = cleaning.clean_ecommerce(retail.dirty, retail.as_of)
    loaded = tables.load_tables(done.tables(), scratch_path(spark, "ok"))
    assert quality.foreign_key_violations(
        loaded, schemas.FOREIGN_KEYS, schemas.PRIMARY_KEYS).isEmpty()
    with pytest.raises(ValueError, match="order_items breaks .*quantity"):
        tables.load_tables({"order_items": retail.dirty["order_items"]},
                           scratch_path(spark, "broken"))


def test_staging_uses_the_named_folder(spark):
    root = staging_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(3))
    assert staged.count() == 3 and all(root in f for f in staged.inputFiles())


def cities(df):
    return sorted((r.customer_id, r.city) for r in df.collect())


def test_new_stream_on_an_old_table(spark, tmp_path):
    """A stream with a new checkpoint goes on from the newest version; earlier versions stay as they are."""
    table = str(tmp_path / "table")

    def batch(*found):
        return spark.createDataFrame(
            [(i, "a", "a@b.co", city, "active", dt.date(2024, 1, 1)) for i, city in found], schemas.CUSTOMER_BATCH)

    def run(inbox, state):
        query = incremental.merge_stream(
            incremental.stream_batches(spark, str(tmp_path / inbox), schemas.CUSTOMER_BATCH), table, str(tmp_path / state),
            incremental.merge_scd1("customer_id"))
        query.awaitTermination()

    def forget():
        for name in ("0", ".0.crc"):
            (tmp_path / "new state" / "commits" / name).unlink(missing_ok=True)

    with pytest.raises(FileNotFoundError, match="no version"):
        incremental.newest(spark, table)
    incremental.first_load(batch((1, "Oslo"), (2, "Rome")), table)
    for found in ([(1, "Pisa")], [(2, "Bern")]):
        batch(*found).coalesce(1).write.mode("append").option("header", True).csv(str(tmp_path / "one"))
        run("one", "state")
    batch((2, "Graz")).coalesce(1).write.option("header", True).csv(str(tmp_path / "two"))
    run("two", "new state")
    assert cities(incremental.newest(spark, table)) == [(1, "Pisa"), (2, "Graz")]
    assert cities(incremental.version(spark, table, 1)) == [(1, "Pisa"), (2, "Rome")]
    # the batch once more, as after a failure between its version and its checkpoint
    forget()
    run("two", "new state")
    assert incremental.complete(spark, table) == [0, 1, 2, 3]
    # once more without its version: it starts anew from the newest one
    (tmp_path / "table" / "version=0000000003" / "_SUCCESS").unlink()
    forget()
    run("two", "new state")
    assert incremental.complete(spark, table) == [0, 1, 2, 4]
    assert incremental.expire(spark, table, 2) == [0, 1]
    assert cities(incremental.newest(spark, table)) == [(1, "Pisa"), (2, "Graz")]
    forget()
    incremental.expire(spark, table, 1)
    run("two", "new state")
    assert incremental.complete(spark, table) == [4]


def test_merge_stream(spark, tmp_path):
    inbox, table = str(tmp_path / "in"), str(tmp_path / "table")
    day = dt.date(2024, 1, 1)
    start = spark.createDataFrame(
        [(1, "a", "a@b.co", "Oslo", "active", day), (2, "b", "b@b.co", "Oslo", "active", day)],
        schemas.CUSTOMER_BATCH)
    incremental.first_load(scd.scd2_open(start, "updated_at"), table)
    for i, city in enumerate(["Rome", "Bonn"]):
        batch = spark.createDataFrame(
            [(1, "a", "a@b.co", city, "active", dt.date(2024, 2 + i, 1))], schemas.CUSTOMER_BATCH)
        batch.coalesce(1).write.mode("append").option("header", True).csv(inbox)
        query = incremental.merge_stream(
            incremental.stream_batches(spark, inbox, schemas.CUSTOMER_BATCH), table,
            str(tmp_path / "state"),
            incremental.merge_scd2("customer_id", ["city"], "updated_at"))
        query.awaitTermination()
    again = incremental.merge_stream(
        incremental.stream_batches(spark, inbox, schemas.CUSTOMER_BATCH), table,
        str(tmp_path / "state"), incremental.merge_scd2("customer_id", ["city"], "updated_at"))
    assert incremental.last_batch(again) == -1  # nothing new, and nothing lost
    got = incremental.newest(spark, table)
    assert sorted((r.customer_id, r.city, r.is_current) for r in got.collect()) == [
        (1, "Bonn", True), (1, "Oslo", False), (1, "Rome", False), (2, "Oslo", True)]
