"""End-to-end job plans: preprocess, prepare, train, score, recommend.

Each plan is a few DataFrame/MLlib steps with one action at the end (a write);
lineage is cut by writing tables, never by caching alone, so a lost executor
recomputes at most one stage from durable input.
"""

from __future__ import annotations

import json
import logging
from contextlib import contextmanager
from dataclasses import dataclass, field
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import request_features
from ..operators import clean as CL
from ..operators import joins as J
from ..operators import sampling as S
from ..operators import scoring as SC
from ..operators import training as TR
from ..operators.aggregates import outcome_stages, written_outcomes, written_rows
from ..sinks.files import write_csv, write_processed
from .prepare import processed_reviews, routed_reviews

log = logging.getLogger(__name__)

# Preprocessing sample size and seed.
SAMPLE_ROWS = 5_000_000
SAMPLE_SEED = 42
# Segments trained at a time (M8).
CONCURRENT_SEGMENTS = 4


def preprocess(reviews: DataFrame, games: DataFrame, users: DataFrame, out_dir: str,
               n: int = SAMPLE_ROWS, seed: int = SAMPLE_SEED, key: str = "review_id") -> dict:
    """Plan D: sample reviews -> rename -> write; keep games/users that occur.

    Outputs ``recs`` (CSV with header), ``games_sampled`` (app_id, title,
    price_final) and ``users_sampled`` (user_id, products, reviews).
    """
    sample = S.sample_fixed_size(reviews, n, key, seed)
    sample_path = f"{out_dir}/recs"
    write_csv(CL.reviews_renamed(sample), sample_path)
    # Re-read the written sample: the semi joins then do not recompute the sample.
    written = (reviews.sparkSession.read.option("header", "true").option("escape", '"').option("multiLine", "true")
               .csv(sample_path))
    write_csv(CL.games_projected(J.games_in_sample(games, written)), f"{out_dir}/games_sampled")
    write_csv(CL.users_projected(J.users_in_sample(users, written)), f"{out_dir}/users_sampled")
    spark = reviews.sparkSession
    return {name: written_rows(spark, f"{out_dir}/{name}", "csv")
            for name in ("recs", "games_sampled", "users_sampled")}


def prepare(reviews: DataFrame, users: DataFrame, games: DataFrame, out_path: str,
            users_unique: bool = False, partition_by: list[str] | None = None, rejects: bool = False) -> dict:
    """Plan A (load + features): write processed training rows; the row count
    is read back from the written files' footers (no second pass).

    With ``rejects`` one write routes every joined row to ``outcome=accepted`` or to ``outcome=<reason>``
    under ``out_path``, and the footers give the row count of every stage (A1) as well.
    """
    spark = reviews.sparkSession
    if not rejects:
        write_processed(processed_reviews(reviews, users, games, users_unique), out_path, partition_by)
        return {"processed": written_rows(spark, out_path)}
    write_processed(routed_reviews(reviews, users, games, users_unique), out_path, ["outcome", *(partition_by or [])])
    outcomes = {r["outcome"]: r["rows"] for r in written_outcomes(spark, out_path).collect()}  # one per rule at most
    return {"processed": outcomes.get(CL.ACCEPTED, 0), "stages": outcome_stages(outcomes),
            "rejected": {k: v for k, v in sorted(outcomes.items()) if k != CL.ACCEPTED}}


def trim(reviews: DataFrame, out_path: str, n_lines: int) -> dict:
    """L2 as a job: the first ``n_lines`` lines, header included, as CSV."""
    write_csv(S.trim_rows(reviews, n_lines), out_path)
    return {"rows": written_rows(reviews.sparkSession, out_path, "csv")}


@dataclass
class TrainReport:
    trained: list[str] = field(default_factory=list)
    reused: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    metrics: dict[str, dict] = field(default_factory=dict)

    def to_json(self) -> str:
        return json.dumps(self.__dict__, sort_keys=True)


def train_all(processed: DataFrame, model_dir: str, holdout: float = 0.0,
              als_blocks: int | None = None, parallel: bool = True, same_input: bool = False) -> TrainReport:
    """Plan A (models), M6: train only models that are missing or do not load (or, with ``same_input``, were
    trained on other files).

    With ``parallel`` the three fits run as concurrent Spark jobs from driver
    threads: LR and GBT train on capped sets and use few tasks, while ALS can
    use the whole cluster, so running them one after another would leave
    executors idle.
    """
    import threading
    from concurrent.futures import ThreadPoolExecutor

    report = TrainReport()
    # LR's rows (first 500k by key) are the first 500k of GBT's rows (first
    # 750k): select GBT's set once from the large input and LR's from that
    # small persisted set, instead of two selections over the whole input.
    # Selected only if a model actually needs training.
    selected: dict[str, tuple[DataFrame, int]] = {}
    lock = threading.Lock()

    def gbt_rows():
        with lock:
            if "gbt" not in selected:
                selected["gbt"] = TR.select_training_rows(processed, TR.GBT_ROWS)
            return selected["gbt"]

    def lr_rows():
        base = gbt_rows()[0]
        with lock:
            if "lr" not in selected:
                selected["lr"] = TR.select_training_rows(base, TR.LR_ROWS)
            return selected["lr"]

    jobs = {
        TR.LR_NAME: lambda: TR.train_lr(processed, holdout=holdout, selected=lr_rows()),
        TR.GBT_NAME: lambda: TR.train_gbt(processed, holdout=holdout, selected=gbt_rows()),
        TR.ALS_NAME: lambda: TR.train_als_from_processed(processed, als_blocks, count_rows=True),
    }
    fingerprint = TR.input_fingerprint(processed)
    try:
        if parallel:
            with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
                futures = {name: pool.submit(_train_one, name, train, model_dir, fingerprint, same_input)
                           for name, train in jobs.items()}
                outcomes = {name: f.result() for name, f in futures.items()}
        else:
            outcomes = {name: _train_one(name, train, model_dir, fingerprint, same_input) for name, train in jobs.items()}
    finally:
        for rows, _ in selected.values():
            rows.unpersist()
    for name in jobs:  # report in a fixed order
        _record(report, name, *outcomes[name])
    return report


def _train_one(name: str, train, model_dir: str, fingerprint: str = "", same_input: bool = False) -> tuple[str, dict]:
    """Load or train one model; returns (outcome, metrics)."""
    result: dict = {}

    def run():
        res = train()
        result.update(rows=res.rows, train_auc=res.train_auc, test_auc=res.test_auc,
                      passed=res.passed)
        return res

    try:
        _, trained = TR.load_or_train(f"{model_dir}/{name}", name, run, fingerprint, same_input)
    except TR.NotEnoughData:
        return "skipped", {}
    return ("trained" if trained else "reused"), result


def _record(report: TrainReport, name: str, outcome: str, result: dict) -> None:
    getattr(report, outcome).append(name)
    if result:
        report.metrics[name] = result
        if result.get("passed") is False:
            log.warning("%s AUC %.4f is below the target %.2f", name,
                        result["train_auc"], TR.AUC_TARGET)


def train_segments(processed: DataFrame, segment_col: str, model_dir: str,
                   holdout: float = 0.0, als_blocks: int | None = None, concurrent: int = CONCURRENT_SEGMENTS) -> dict[str, TrainReport]:
    """M8: one model set per data segment (e.g. landing date).

    Segment values come from a distributed ``distinct``; NULL is a segment of its
    own; each segment is trained from its own slice, saved under ``<dir>/<col>=<value>``.
    Written partitioned by the segment column, each slice reads one partition.

    Segments are small beside the cluster, so ``concurrent`` of them train at a time, each in a
    scheduler pool of its own (with ``spark.scheduler.mode=FAIR`` they share the slots evenly). The next
    value is fetched when a segment is done: neither values nor jobs queue up in the driver.
    A segment that fails is raised after those that run have ended.
    """
    import threading
    from concurrent.futures import ThreadPoolExecutor

    spark = processed.sparkSession
    free = threading.BoundedSemaphore(concurrent)

    def train(value) -> TrainReport:
        try:
            name = "__HIVE_DEFAULT_PARTITION__" if value is None else quote(str(value), safe=" -_.")
            with _scheduler_pool(spark, f"segment-{threading.get_ident()}"):
                part = processed.filter(F.col(segment_col).eqNullSafe(F.lit(value)))
                # The three fits of a segment run one after another; other segments fill the slots.
                return train_all(part, f"{model_dir}/{segment_col}={name}", holdout, als_blocks, False)
        finally:
            free.release()

    # Values are fetched partition by partition; the driver holds one partition's at a time.
    values = processed.select(segment_col).distinct().orderBy(F.col(segment_col).asc_nulls_last())
    futures = {}
    with ThreadPoolExecutor(max_workers=concurrent) as pool:
        for (v,) in values.toLocalIterator():
            free.acquire()
            if any(f.done() and f.exception() for f in futures.values()):
                free.release()
                break
            futures[str(v)] = pool.submit(train, v)
    return {v: f.result() for v, f in futures.items()}


@contextmanager
def _scheduler_pool(spark: SparkSession, name: str):
    """Jobs that this thread starts go to a pool of this name (classic sessions only)."""
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: pools are the server's
        yield
        return
    sc.setLocalProperty("spark.scheduler.pool", name)
    try:
        yield
    finally:
        sc.setLocalProperty("spark.scheduler.pool", None)


def score(model_path: str, requests: DataFrame, out_path: str) -> None:
    """M4 as a batch job: requests table in, probabilities (with reasons) out."""
    from ..schemas import REQUEST_SCHEMA

    # The declared request types (text id, double features), bad values -> NULL.
    # Keys a request leaves out are NULL.
    requests = requests.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in requests.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in REQUEST_SCHEMA.fields])
    ok = F.col("hours").isNotNull() & ~F.isnan("hours")
    features = request_features(requests.filter(ok))
    scored = SC.score_requests(TR.load_model(model_path, TR.LR_NAME), features)
    rejected = requests.filter(~ok | F.col("hours").isNull()).select(
        "request_id", F.lit(None).cast("double").alias("probability"),
        F.lit("missing 'hours' in features").alias("reason"))
    scored.unionByName(rejected).write.mode("overwrite").parquet(out_path)


def recommend(model_path: str, users: DataFrame, out_path: str, n: int = SC.TOP_N, seen: DataFrame | None = None) -> None:
    """M5 as a batch job: user ids in, ranked items (unknown users flagged) out; ``seen`` (user, item) pairs are left out."""
    SC.recommend_for(TR.load_model(model_path, TR.ALS_NAME), users, n, seen).write.mode("overwrite").parquet(out_path)


def model_status(model_dir: str) -> dict:
    """Which saved models load (the health check, without a server):
    ``{"status": "healthy" | "degraded", "models": {name: bool}}``."""
    loaded = {}
    for name in (TR.LR_NAME, TR.GBT_NAME, TR.ALS_NAME):
        try:
            TR.load_model(f"{model_dir}/{name}", name)
            loaded[name] = True
        except Exception:
            loaded[name] = False
    return {"status": "healthy" if all(loaded.values()) else "degraded", "models": loaded}


def session_for_jobs(app: str) -> SparkSession:
    from ..session import build_cluster_session
    return build_cluster_session(app)
