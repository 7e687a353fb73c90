"""End-to-end jobs through the CLI: preprocess, prepare, train (idempotent), score,
recommend, and per-segment training (M6, M8, K1, K2, K5)."""

import json
import os

from pyspark.sql import functions as F

from recoflow.jobs import cli
from recoflow.plans import jobs
from recoflow.plans.queries import processed_reviews
from recoflow.sinks.files import write_csv
from recoflow.sources import tables as T
from tests.conftest import SF_SMALL


def _csvs(spark, tmp):
    paths = {}
    for name, df in (("reviews", T.reviews_raw(spark, SF_SMALL)),
                     ("users", T.users_raw(spark, SF_SMALL)),
                     ("games", T.games_raw(spark, SF_SMALL))):
        paths[name] = os.path.join(tmp, f"{name}_csv")
        write_csv(df.coalesce(1), paths[name])
    return paths


def test_prepare_from_csv_equals_query(spark, tmp):
    p = _csvs(spark, tmp)
    from recoflow.sources import files
    out = os.path.join(tmp, "processed")
    res = jobs.prepare(files.read_reviews_csv(spark, p["reviews"]),
                       files.read_users_csv(spark, p["users"]),
                       files.read_games_csv(spark, p["games"]), out)
    expected = processed_reviews(spark, SF_SMALL)
    got = spark.read.parquet(out)
    assert res["processed"] == expected.count() == got.count()
    assert got.select(*expected.columns).exceptAll(expected).count() == 0


def test_preprocess_outputs(spark, tmp):
    p = _csvs(spark, tmp)
    from recoflow.sources import files
    out = os.path.join(tmp, "pre")
    counts = jobs.preprocess(files.read_reviews_csv(spark, p["reviews"]),
                             files.read_games_csv(spark, p["games"]),
                             files.read_users_csv(spark, p["users"]), out, n=300)
    assert counts["recs"] == 300
    recs = spark.read.option("header", "true").csv(f"{out}/recs")
    games = spark.read.option("header", "true").csv(f"{out}/games_sampled")
    assert games.columns == ["app_id", "title", "price_final"]
    assert games.join(recs, "app_id", "left_anti").count() == 0


def test_train_score_recommend_cli(spark, tmp):
    processed = os.path.join(tmp, "processed")
    T.labelled(processed_reviews(spark, SF_SMALL)).write.parquet(processed)
    models = os.path.join(tmp, "models")
    assert cli.main(["train", "--processed", processed, "--models", models]) == 0
    for name in ("M1_LR", "M2_GBT", "M3_ALS"):
        assert os.path.isdir(os.path.join(models, name))
    assert jobs.model_status(models) == {"status": "healthy", "models": {
        "M1_LR": True, "M2_GBT": True, "M3_ALS": True}}
    assert jobs.model_status(os.path.join(tmp, "none"))["status"] == "degraded"
    # Second run reuses every model (M6).
    again = jobs.train_all(spark.read.parquet(processed), models)
    assert sorted(again.reused) == ["M1_LR", "M2_GBT", "M3_ALS"] and not again.trained
    req = os.path.join(tmp, "requests")
    T.requests(spark, SF_SMALL).write.parquet(req)
    assert cli.main(["score", "--model", f"{models}/M1_LR", "--requests", req,
                     "--out", os.path.join(tmp, "scores")]) == 0
    scores = spark.read.parquet(os.path.join(tmp, "scores"))
    assert scores.count() == spark.read.parquet(req).count()
    assert scores.filter(F.col("reason").isNotNull()).count() > 0


def test_train_segments(spark, tmp):
    data = T.labelled(processed_reviews(spark, SF_SMALL)).withColumn(
        "seg", (F.col("review_id").cast("int") % 2).cast("string"))
    reports = jobs.train_segments(data, "seg", os.path.join(tmp, "seg_models"))
    assert sorted(reports) == ["0", "1"]
    for rep in reports.values():
        assert json.loads(rep.to_json())["trained"]
    assert os.path.isdir(os.path.join(tmp, "seg_models", "seg=0", "M1_LR"))


def test_ingest_then_prepare_landed_cli(spark, tmp):
    """The two data paths connected: JSON-lines messages -> landed batches ->
    the same prepare chain (P6 casts, joins, filters) as the CSV path."""
    p = _csvs(spark, tmp)
    src = os.path.join(tmp, "msgs")
    T.messages_raw(spark, SF_SMALL).select("value").write.text(src)
    out = os.path.join(tmp, "ingest")
    assert cli.main(["ingest", "--source", src, "--out", out,
                     "--checkpoint", os.path.join(tmp, "ckpt"), "--drain"]) == 0
    processed = os.path.join(tmp, "processed_landed")
    assert cli.main(["prepare", "--landed", "--reviews", f"{out}/landed", "--users", p["users"],
                     "--games", p["games"], "--out", processed]) == 0
    from recoflow.plans.queries import processed_from_messages
    expected = processed_from_messages(spark, SF_SMALL)
    got = spark.read.parquet(processed)
    assert got.count() == expected.count() > 0
    cols = [c for c in expected.columns if c != "review_id"]
    assert got.select(*cols).exceptAll(expected.select(*cols)).count() == 0


def test_preprocess_cli_missing_games(spark, tmp):
    p = _csvs(spark, tmp)
    out = os.path.join(tmp, "pre")
    assert cli.main(["preprocess", "--reviews", p["reviews"], "--users", p["users"],
                     "--games", os.path.join(tmp, "nope.csv"), "--out", out, "--rows", "200"]) == 0
    games = spark.read.option("header", "true").csv(f"{out}/games_sampled")
    assert games.count() == 0


def test_prepare_partitioned_by_date(spark, tmp):
    p = _csvs(spark, tmp)
    out = os.path.join(tmp, "processed_by_date")
    assert cli.main(["prepare", "--reviews", p["reviews"], "--users", p["users"],
                     "--games", p["games"], "--out", out, "--partition-by", "date"]) == 0
    dates = [d for d in os.listdir(out) if d.startswith("date=")]
    assert len(dates) > 1
    one = dates[0].split("=", 1)[1]
    part = spark.read.parquet(out).filter(F.col("date") == one)
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan  # pruned to one folder
    assert part.count() == processed_reviews(spark, SF_SMALL).filter(F.col("date") == one).count()


def test_train_segments_keeps_the_null_segment(spark, tmp, monkeypatch):
    seen = {}
    monkeypatch.setattr(jobs, "train_all", lambda part, path, *a: seen.setdefault(path, part.count()))
    data = spark.createDataFrame([("a/b",), (None,), (None,)], "seg string")
    jobs.train_segments(data, "seg", "m")
    assert seen == {"m/seg=a%2Fb": 1, "m/seg=__HIVE_DEFAULT_PARTITION__": 2}


def test_prepare_with_rejects_counts_every_stage(spark, tmp):
    """One routed write: accepted and rejected rows together are the joined rows; training reads the accepted ones."""
    from recoflow.operators.aggregates import stage_counts
    from recoflow.sources import files

    p = _csvs(spark, tmp)
    out = os.path.join(tmp, "routed")
    assert cli.main(["prepare", "--reviews", p["reviews"], "--users", p["users"], "--games", p["games"], "--out", out,
                     "--rejects", "--partition-by", "date"]) == 0
    frames = files.read_reviews_csv(spark, p["reviews"]), files.read_users_csv(spark, p["users"]), files.read_games_csv(spark, p["games"])
    res = jobs.prepare(*frames, out, rejects=True, partition_by=["date"])
    stages = {r["stage"]: r["rows"] for r in stage_counts(*frames).collect()}
    assert res["stages"] == {k: stages[k] for k in ("after_joins", "after_null_filter", "final")}
    assert res["processed"] + sum(res["rejected"].values()) == stages["after_joins"] and len(res["rejected"]) > 2
    accepted = files.read_processed(spark, f"{out}/outcome=accepted")
    expected = processed_reviews(spark, SF_SMALL)
    assert dict(accepted.dtypes)["date"] == "string"
    assert accepted.select(expected.columns).exceptAll(expected).count() == 0 and accepted.count() == expected.count()


def test_partitioned_write_has_few_files(spark, tmp):
    """Rows of a day come together before they are written: files do not multiply with tasks."""
    from recoflow.sinks.files import write_processed

    df = processed_reviews(spark, SF_SMALL).repartition(16)
    write_processed(df, os.path.join(tmp, "p"), ["date"])
    days = df.select("date").distinct().count()
    files = sum(f.endswith(".parquet") for _, _, names in os.walk(os.path.join(tmp, "p")) for f in names)
    assert days <= files < 2 * days + 8


def test_trim_and_publish_cli(spark, tmp):
    p = _csvs(spark, tmp)
    out = os.path.join(tmp, "trimmed")
    assert cli.main(["trim", "--reviews", p["reviews"], "--out", out, "--lines", "101"]) == 0
    ids = [int(r["review_id"]) for r in spark.read.option("header", "true").csv(out).collect()]
    assert sorted(ids) == list(range(100))
    sent = os.path.join(tmp, "sent")
    assert cli.main(["publish", "--reviews", p["reviews"], "--checkpoint", os.path.join(tmp, "pub"), "--out", sent]) == 0
    from recoflow.plans.queries import review_messages
    expected = review_messages(spark, SF_SMALL).select("value")
    assert spark.read.text(sent).exceptAll(expected).count() == 0 and spark.read.text(sent).count() == expected.count()


def test_preprocess_counts_quoted_line_breaks_once(spark, tmp):
    df = spark.createDataFrame([(str(i), "1", "2\n3", "true", "1.5", "7") for i in range(5)], "review_id string, app_id string, date string, is_recommended string, hours string, user_id string")
    games = spark.createDataFrame([("1", 'a "b"\nc', "2")], "app_id string, title string, price_final string")
    users = spark.createDataFrame([("7", "1", "1")], "user_id string, products string, reviews string")
    assert jobs.preprocess(df, games, users, os.path.join(tmp, "o"), n=4) == {"recs": 4, "games_sampled": 1, "users_sampled": 1}
    head = spark.read.option("header", "true").csv(os.path.join(tmp, "o", "recs")).columns
    assert head == ["user_id", "app_id", "recommended", "hours", "timestamp"]


def test_model_versions(spark, tmp, monkeypatch):
    """A damaged model and other settings train anew, beside the old version; a storage failure is raised and nothing is lost."""
    import shutil

    import pytest

    from recoflow.operators import training as TR

    data = T.labelled(processed_reviews(spark, SF_SMALL))
    path, fits = os.path.join(tmp, "m", TR.LR_NAME), []

    def train():
        fits.append(1)
        return TR.train_lr(data, evaluate=False)

    assert TR.load_or_train(path, TR.LR_NAME, train, "f")[1] and not TR.load_or_train(path, TR.LR_NAME, train, "g")[1]
    assert TR.load_or_train(path, TR.LR_NAME, train, "g", same_input=True)[1] and len(fits) == 2
    newest = TR.versions(spark, path)[0]["version"]
    with monkeypatch.context() as m:
        m.setattr(TR, "load_model", lambda *a: (_ for _ in ()).throw(OSError("connection reset")))
        with pytest.raises(OSError):
            TR.load_or_train(path, TR.LR_NAME, train, "g")
    shutil.rmtree(os.path.join(path, "versions", newest, "model", "stages"))
    assert TR.load_or_train(path, TR.LR_NAME, train, "g")[1] and len(fits) == 3
    os.makedirs(os.path.join(path, "versions", "unfinished", "model"))  # no manifest: not there
    assert not TR.load_or_train(path, TR.LR_NAME, train, "g")[1] and len(TR.versions(spark, path)) == 3
    monkeypatch.setitem(TR.SETTINGS, TR.LR_NAME, {"maxIter": 1})
    assert TR.load_or_train(path, TR.LR_NAME, train, "g")[1]


def test_segments_run_side_by_side(spark, tmp, monkeypatch):
    """A hundred segments and NULL, never more than asked at a time; a failure is raised."""
    import threading
    import time

    import pytest

    lock, now, most, seen = threading.Lock(), [0], [0], []

    def fake(part, path, *a):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
            seen.append(path)
        time.sleep(0.01)
        with lock:
            now[0] -= 1
        return jobs.TrainReport()

    monkeypatch.setattr(jobs, "train_all", fake)
    data = spark.createDataFrame([(f"s{i}",) for i in range(100)] + [(None,)], "seg string")
    reports = jobs.train_segments(data, "seg", "m", concurrent=5)
    assert len(reports) == len(seen) == 101 and 1 < most[0] <= 5

    def broken(part, path, *a):
        raise ValueError(path)

    monkeypatch.setattr(jobs, "train_all", broken)
    with pytest.raises(ValueError):
        jobs.train_segments(data, "seg", "m", concurrent=2)
