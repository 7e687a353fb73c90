"""CSV / Parquet sources and sinks."""

import os

import pytest

from recoflow.schemas import GAMES_COLUMNS, USERS_SCHEMA
from recoflow.sinks.files import write_csv, write_processed
from recoflow.sources import files


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return path


def test_quoted_titles_and_newlines(spark, tmp):
    header = ",".join(GAMES_COLUMNS)
    row1 = '1,"He said ""hi"", ok",2020-01-01,true,false,false,Positive,90,100,9.99,9.99,0,true'
    row2 = '2,"two\nlines",2020-01-01,true,false,false,Positive,80,10,1.00,1.00,0,true'
    p = _write(os.path.join(tmp, "games.csv"), "\n".join([header, row1, row2]) + "\n")
    rows = {r["app_id"]: r for r in files.read_games_csv(spark, p).collect()}
    assert rows["1"]["title"] == 'He said "hi", ok'
    assert rows["1"]["price_original"] == "9.99"
    assert rows["2"]["title"] == "two\nlines"


def test_reordered_header_fails(spark, tmp):
    p = _write(os.path.join(tmp, "users.csv"), "products,user_id,reviews\n3,1,2\n")
    with pytest.raises(Exception):
        files.read_users_csv(spark, p).collect()


def test_short_row_is_null_filled(spark, tmp):
    p = _write(os.path.join(tmp, "users.csv"), "user_id,products,reviews\n1,2\n")
    row = files.read_users_csv(spark, p).first()
    assert (row.user_id, row.products, row.reviews) == ("1", "2", None)


def test_read_or_empty(spark, tmp):
    df = files.read_or_empty(spark, os.path.join(tmp, "missing.csv"), USERS_SCHEMA)
    assert df.count() == 0 and df.columns == list(USERS_SCHEMA.names)


def test_batches_skip_corrupt_files(spark, tmp):
    d = os.path.join(tmp, "batches")
    df = spark.createDataFrame([("1", "2", "true", "1.0", "2024-01-01")],
                               "app_id string, user_id string, is_recommended string, "
                               "hours string, date string")
    df.write.parquet(d)
    _write(os.path.join(d, "part-broken.parquet"), "not parquet")
    assert files.read_batches(spark, d).count() == 1


def test_sinks_roundtrip(spark, tmp):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_processed(df, os.path.join(tmp, "p"), partition_by=["k"])
    assert spark.read.parquet(os.path.join(tmp, "p")).count() == 2
    write_csv(df, os.path.join(tmp, "c"))
    back = spark.read.option("header", "true").csv(os.path.join(tmp, "c"))
    assert sorted(r["k"] for r in back.collect()) == ["a", "b"]


def test_skipped_files_are_named(spark, tmp):
    """Broken small and large files are listed with their size; sound ones, also without rows, are not."""
    from recoflow.sources import files

    path = os.path.join(tmp, "batch dir")
    spark.range(10).selectExpr(*(f"cast(id as string) {c}" for c in files.BATCH_SCHEMA.names)).repartition(2).write.parquet(f"{path}/batch_id=1")
    spark.createDataFrame([], files.BATCH_SCHEMA).write.parquet(f"{path}/batch_id=2")
    for name, size in (("a b%.parquet", 10), ("large.parquet", files.EMPTY_FILE_BYTES + 5), ("nothing.parquet", 0)):
        with open(os.path.join(path, "batch_id=1", name), "wb") as f:
            f.write(b"x" * size)
    got = {os.path.basename(r["path"]): r["length"] for r in files.skipped_files(spark, path).collect()}
    assert {k.replace("%20", " ").replace("%25", "%"): v for k, v in got.items()} == {"a b%.parquet": 10, "large.parquet": files.EMPTY_FILE_BYTES + 5}
    assert files.read_batches(spark, path).count() == 10
