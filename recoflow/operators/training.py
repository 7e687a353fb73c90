"""Model training (M1-M3, M6-M8) with the size check, quality gate and metrics (A4-A5).

Differences from the reference, on purpose:

* every estimator has a fixed seed (PySpark's default seed changes per process);
* the training rows are the first n by the stable review key, not by a
  partition-dependent row id, and are persisted so fit and evaluation see the
  same rows without recomputing the joins;
* a failing fit raises instead of being logged and swallowed;
* AUC is exact (no 1000-bin approximation) and also measured on a hold-out
  when ``holdout > 0``.
"""

from __future__ import annotations

import hashlib
import json
import logging
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import FEATURE_COLUMNS, KEY_COLUMN, LABEL_COLUMN
from ..session import checkpoint_dir, default_parallelism
from .aggregates import exact_auc
from .clean import als_triples
from .sampling import first_n_with_count

log = logging.getLogger(__name__)

# Model names, training sizes, hyper-parameters and gates.
LR_NAME, GBT_NAME, ALS_NAME = "M1_LR", "M2_GBT", "M3_ALS"
LR_ROWS, GBT_ROWS = 500_000, 750_000
LR_MAX_ITER = 20
GBT_MAX_ITER, GBT_MAX_DEPTH = 15, 5
ALS_MAX_ITER, ALS_REG_PARAM = 5, 0.01
# Ratings of a user or item block, on average. MLlib builds and solves a block in one task's heap, unseen by Spark's
# memory manager: about 50 bytes a rating while it is built, less 2**24 ratings, beyond which its buffers double.
ALS_BLOCK_RATINGS = 12_000_000
MIN_TRAINING_ROWS = 100
AUC_TARGET = 0.70
SEED = 42
# Rows per partition of a (small, capped) classifier training set.
TRAIN_ROWS_PER_PARTITION = 50_000


class NotEnoughData(Exception):
    """Fewer than ``MIN_TRAINING_ROWS`` rows: the model is skipped."""


@dataclass
class TrainResult:
    name: str
    model: object
    rows: int
    train_auc: float | None = None
    test_auc: float | None = None

    @property
    def passed(self) -> bool | None:
        """A5: strict ``auc > 0.70`` on the training rows (None for ALS)."""
        return None if self.train_auc is None else self.train_auc > AUC_TARGET


def assembler(handle_invalid: str = "skip") -> VectorAssembler:
    """The 5-feature vector; 'skip' drops rows with NULL/NaN features."""
    return VectorAssembler(inputCols=list(FEATURE_COLUMNS), outputCol="features",
                           handleInvalid=handle_invalid)


def lr_pipeline(label: str = LABEL_COLUMN) -> Pipeline:
    """M1: assembler + logistic regression, maxIter 20."""
    lr = LogisticRegression(featuresCol="features", labelCol=label, maxIter=LR_MAX_ITER)
    return Pipeline(stages=[assembler(), lr])


def gbt_pipeline(label: str = LABEL_COLUMN, seed: int = SEED) -> Pipeline:
    """M2: assembler + gradient-boosted trees, maxIter 15, depth 5."""
    gbt = GBTClassifier(featuresCol="features", labelCol=label, maxIter=GBT_MAX_ITER,
                        maxDepth=GBT_MAX_DEPTH, seed=seed)
    return Pipeline(stages=[assembler(), gbt])


def als_estimator(seed: int = SEED, blocks: int | None = None) -> ALS:
    """M3: explicit ALS on hours; rank 10 (default), nonnegative, cold-start drop. Rating blocks are kept on disk:
    cached ones fill the heap that the tasks need for theirs."""
    als = ALS(maxIter=ALS_MAX_ITER, regParam=ALS_REG_PARAM, userCol="user", itemCol="item",
              ratingCol="rating", coldStartStrategy="drop", nonnegative=True, seed=seed,
              checkpointInterval=2, intermediateStorageLevel="DISK_ONLY")
    if blocks:
        als = als.setNumUserBlocks(blocks).setNumItemBlocks(blocks)
    return als


def has_min_rows(df: DataFrame, n: int = MIN_TRAINING_ROWS) -> bool:
    """A4: at least ``n`` rows, counted with a bounded ``limit(n)`` (no full count)."""
    return df.limit(n).count() >= n


def holdout_flag(key: str = KEY_COLUMN, fraction: float = 0.2):
    """Deterministic hold-out membership from md5 of the key (partition independent)."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return bucket < F.lit(int(fraction * (1 << 32)))


def class_one_score(predictions: DataFrame, col: str = "rawPrediction") -> DataFrame:
    """Element 1 of a vector column as a double."""
    return predictions.withColumn("score", vector_to_array(col)[1])


def _auc(model: PipelineModel, rows: DataFrame, label: str) -> float:
    scored = class_one_score(model.transform(rows))
    return exact_auc(scored, "score", label).first()["auc"]


def select_training_rows(processed: DataFrame, n_rows: int) -> tuple[DataFrame, int]:
    """The first ``n_rows`` rows by key, persisted, and their count.

    When the cap is hit the rows came out of a filter over a larger input and
    are spread thinly over every input partition; they are gathered into a few
    partitions (a shuffle of at most ``n_rows`` rows; the scan keeps its
    parallelism) so each fit iteration schedules a few tasks, not 10^5. Below
    the cap the set is the whole input, already partitioned by size.
    """
    rows, count = first_n_with_count(processed, n_rows)
    if count >= n_rows:
        slots = default_parallelism(processed.sparkSession)
        parts = max(1, min(slots, -(-count // TRAIN_ROWS_PER_PARTITION)))
        rows = rows.repartition(parts)
    return rows.persist(StorageLevel.MEMORY_AND_DISK), count


def train_classifier(processed: DataFrame, name: str, pipeline: Pipeline, n_rows: int,
                     label: str = LABEL_COLUMN, holdout: float = 0.0,
                     evaluate: bool = True, selected: tuple[DataFrame, int] | None = None
                     ) -> TrainResult:
    """M1/M2: first ``n_rows`` by key -> (hold-out split) -> fit -> exact AUC.

    ``evaluate=False`` skips the AUC passes (a scoring run that only needs the
    model). ``selected`` passes rows already chosen by
    :func:`select_training_rows` (the caller unpersists them).
    """
    rows, count = selected if selected is not None else select_training_rows(processed, n_rows)
    try:
        if count < MIN_TRAINING_ROWS:
            raise NotEnoughData(f"not enough data for {name}")
        if holdout > 0:
            test = rows.filter(holdout_flag(fraction=holdout))
            train = rows.filter(~holdout_flag(fraction=holdout))
        else:
            test, train = None, rows
        model = pipeline.fit(train)
        result = TrainResult(name, model, train.count() if holdout > 0 else count)
        if evaluate:
            result.train_auc = _auc(model, train, label)
            if test is not None and has_min_rows(test, 1):
                result.test_auc = _auc(model, test, label)
            log.info("%s trained on %d rows, train AUC %.4f", name, result.rows, result.train_auc)
        return result
    finally:
        if selected is None:
            rows.unpersist()


def train_lr(processed: DataFrame, label: str = LABEL_COLUMN, holdout: float = 0.0,
             evaluate: bool = True, selected: tuple[DataFrame, int] | None = None) -> TrainResult:
    return train_classifier(processed, LR_NAME, lr_pipeline(label), LR_ROWS, label, holdout,
                            evaluate, selected)


def train_gbt(processed: DataFrame, label: str = LABEL_COLUMN, holdout: float = 0.0,
              evaluate: bool = True, selected: tuple[DataFrame, int] | None = None) -> TrainResult:
    return train_classifier(processed, GBT_NAME, gbt_pipeline(label), GBT_ROWS, label, holdout,
                            evaluate, selected)


def train_als(triples: DataFrame, blocks: int | None = None, count_rows: bool = False) -> TrainResult:
    """M3 on ``(user, item, rating)``; all rows are used (and counted for the report with ``count_rows``; -1 otherwise).

    ALS iterates; its lineage is cut every 2 iterations in the shared
    checkpoint folder, so a lost executor does not replay every iteration.
    User and item blocks scale with the cluster (MLlib's default is 10 blocks,
    which would put a 100 TB rating table into 10 tasks per iteration) and, where
    the rows are counted, with the ratings (``ALS_BLOCK_RATINGS``).
    """
    spark = triples.sparkSession
    checkpoint_dir(spark)
    rows = triples.count() if count_rows else -1
    if (rows < MIN_TRAINING_ROWS) if count_rows else not has_min_rows(triples):
        raise NotEnoughData(f"not enough data for {ALS_NAME}")
    blocks = blocks or max(10, default_parallelism(spark), -(-rows // ALS_BLOCK_RATINGS))
    model = als_estimator(blocks=blocks).fit(triples)
    return TrainResult(ALS_NAME, model, rows)


def train_als_from_processed(processed: DataFrame, blocks: int | None = None, count_rows: bool = False) -> TrainResult:
    return train_als(als_triples(processed), blocks, count_rows)


SETTINGS = {
    LR_NAME: {"rows": LR_ROWS, "maxIter": LR_MAX_ITER, "features": list(FEATURE_COLUMNS)},
    GBT_NAME: {"rows": GBT_ROWS, "maxIter": GBT_MAX_ITER, "maxDepth": GBT_MAX_DEPTH, "seed": SEED, "features": list(FEATURE_COLUMNS)},
    ALS_NAME: {"maxIter": ALS_MAX_ITER, "regParam": ALS_REG_PARAM, "seed": SEED},
}


def input_fingerprint(df: DataFrame) -> str:
    """What a model was trained on, told without reading it: the columns, and names of the files behind them.
    Spark gives every file it writes a new name, so a rewritten table has another fingerprint."""
    digest = hashlib.sha256(df.schema.json().encode())
    for name in sorted(df.inputFiles()):
        digest.update(name.encode() + b"\n")
    return digest.hexdigest()


def _is_damage(error: Exception) -> bool:
    """Whether a model does not load because its files are missing or are no model, rather than because
    storage could not be reached."""
    text = str(error)
    return any(sign in text for sign in ("PATH_NOT_FOUND", "FileNotFoundException", "Input path does not exist", "InvalidInputException",
                                         "UNABLE_TO_INFER_SCHEMA", "CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE", "is not a Parquet file",
                                         "ParseException", "JsonParseException", "MappingException", "empty collection",
                                         "requirement failed", "UNRESOLVED_COLUMN", "Expected class name"))


def versions(spark: SparkSession, path: str) -> list[dict]:
    """Published versions of a model, newest first. A version's manifest is written after its model, and Spark
    shows a file only once its write is committed, so a version without one does not exist."""
    try:
        found = spark.read.schema("version string, created string, settings string, fingerprint string").json(f"{path}/versions/*/manifest").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return []
    return sorted((r.asDict() for r in found), key=lambda r: (r["created"], r["version"]), reverse=True)


def load_model(path: str, name: str):
    """Load a saved model of the given kind: the newest published version under ``path``, or the model
    that ``path`` itself holds."""
    spark = SparkSession.active()
    published = versions(spark, path)
    if published:
        path = f"{path}/versions/{published[0]['version']}/model"
    return ALSModel.load(path) if name == ALS_NAME else PipelineModel.load(path)


def save_model(model, path: str) -> None:
    """K5: save, overwriting."""
    model.write().overwrite().save(path)


def publish_model(model, path: str, name: str, fingerprint: str = "") -> str:
    """K5 + M6: save as a new version; earlier ones stay. The manifest comes last and makes it visible, at once."""
    spark = SparkSession.active()
    version = uuid.uuid4().hex[:12]
    save_model(model, f"{path}/versions/{version}/model")
    manifest = [(version, datetime.now(timezone.utc).isoformat(), json.dumps(SETTINGS.get(name, {}), sort_keys=True), fingerprint)]
    rows = spark.createDataFrame(manifest, "version string, created string, settings string, fingerprint string")
    rows.coalesce(1).write.json(f"{path}/versions/{version}/manifest")
    return version


def load_or_train(path: str, name: str, train, fingerprint: str = "", same_input: bool = False) -> tuple[object, bool]:
    """M6: reuse a model that loads; otherwise train, publish and return it.

    Only a model that is missing, damaged or trained with other settings (or, with
    ``same_input``, on other data) is trained anew; any other failure to read it, such as storage that does not
    answer, is raised, and nothing is ever overwritten. Returns ``(model, trained)``.
    """
    published = versions(SparkSession.active(), path)
    wanted = json.dumps(SETTINGS.get(name, {}), sort_keys=True)
    stale = published and (published[0]["settings"] != wanted or (same_input and published[0]["fingerprint"] != fingerprint))
    if not stale:
        try:
            return load_model(path, name), False
        except Exception as e:
            if not _is_damage(e):
                raise
    log.info("model %s is missing, damaged or out of date at %s; training", name, path)
    result = train()
    publish_model(result.model, path, name, fingerprint)
    return result.model, True
