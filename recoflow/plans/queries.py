"""Registered queries: one per operator row (or tight group) of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
driver tables (or tables Spark derives from them). Column names equal those of
the oracle SQL of the same name in :mod:`recoflow.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import casts as C
from ..functions.features import price_category as _price_category
from ..functions.features import quality_score as _quality_score
from ..functions.features import request_features as _request_features
from ..functions.json_codec import decode_messages, encode_message, landable, quarantined
from ..operators import aggregates as A
from ..operators import clean as CL
from ..operators import joins as J
from ..operators import sampling as S
from ..operators import scoring as SC
from ..operators import training as TR
from ..schemas import FEATURE_COLUMNS, MESSAGE_COLUMNS
from ..sinks.files import write_csv, write_processed
from ..sources import files as SF
from ..sources import tables as T
from ..streaming import ingest as IN
from .prepare import joined_reviews
from .prepare import processed_reviews as _processed
from .prepare import routed_reviews

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def wrap(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return wrap


def raw(spark: SparkSession, sf_dir: str):
    return T.reviews_raw(spark, sf_dir), T.users_raw(spark, sf_dir), T.games_raw(spark, sf_dir)


@register("processed_reviews")
def processed_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship (J1-F2): usable training rows with features."""
    return _processed(*raw(spark, sf_dir))


# Parameters of the registered checks. The LR size (TR.LR_ROWS), the trim size
# and the sample seed are the reference's; the registered sample draws 5,000
# rows so that sampling and the semi joins behind it select a strict subset at
# the test scales.
TRIM_LINES = 5_000_000
SAMPLE_ROWS = 5_000
SAMPLE_SEED = 42


# ---------------------------------------------------------------- projections


@register("reviews_column_subset")
def reviews_column_subset(spark, sf_dir):
    """Five columns of the reviews; the scan reads only what they need."""
    return T.reviews_raw(spark, sf_dir).select("user_id", "app_id", "is_recommended", "hours", "date")


@register("reviews_renamed")
def reviews_renamed(spark, sf_dir):
    """P2 + P7 + P10: preprocessing projection (rename, 0/1 label, hours or 0)."""
    return CL.reviews_renamed(T.reviews_raw(spark, sf_dir))


@register("games_projected")
def games_projected(spark, sf_dir):
    """P4 (games)."""
    return CL.games_projected(T.games_raw(spark, sf_dir))


@register("users_projected")
def users_projected(spark, sf_dir):
    """P4 (users)."""
    return CL.users_projected(T.users_raw(spark, sf_dir))


@register("ids_typed")
def ids_typed(spark, sf_dir):
    """P5: ID strings -> int, bad -> NULL."""
    r = T.reviews_raw(spark, sf_dir)
    return r.select("review_id", "app_id", "user_id",
                    C.to_int_id("app_id").alias("app_id_int"),
                    C.to_int_id("user_id").alias("user_id_int"))


@register("label_typed")
def label_typed(spark, sf_dir):
    """P6 (and P8, kept only to show what the direct double cast loses)."""
    r = T.reviews_raw(spark, sf_dir)
    return r.select("review_id", "is_recommended",
                    C.to_label("is_recommended").alias("is_recommended_label"),
                    C.to_double("is_recommended").alias("label_direct_double"))


@register("numerics_typed")
def numerics_typed(spark, sf_dir):
    """Numeric strings of games -> double, bad -> NULL."""
    g = T.games_raw(spark, sf_dir)
    return g.select("app_id",
                    C.to_double("price_original").alias("price_numeric"),
                    C.to_double("positive_ratio").alias("positive_ratio_numeric"),
                    C.to_double("user_reviews").alias("user_reviews_numeric"))


@register("hours_coerced")
def hours_coerced(spark, sf_dir):
    """P9 vs P10 on hours: NULL on bad input vs 0 on bad input."""
    r = T.reviews_raw(spark, sf_dir)
    return r.select("review_id", "hours",
                    C.to_double("hours").alias("hours_numeric"),
                    C.to_hours_or_zero("hours").alias("hours_or_zero"))


@register("price_category")
def price_category(spark, sf_dir):
    """P11 over every game, including NULL and unparseable prices."""
    g = T.games_raw(spark, sf_dir).select("app_id", C.to_double("price_original").alias("price_numeric"))
    return g.withColumn("price_category", _price_category(F.col("price_numeric")))


@register("quality_score")
def quality_score(spark, sf_dir):
    """P12 over every game."""
    g = T.games_raw(spark, sf_dir).select(
        "app_id",
        C.to_double("positive_ratio").alias("positive_ratio_numeric"),
        C.to_double("user_reviews").alias("user_reviews_numeric"))
    return g.withColumn("quality_score",
                        _quality_score(F.col("positive_ratio_numeric"), F.col("user_reviews_numeric")))


# ---------------------------------------------------------------- joins
@register("join_users")
def join_users(spark, sf_dir):
    """Reviews x users (inner, on the raw user_id text)."""
    return J.join_users(T.reviews_raw(spark, sf_dir), T.users_raw(spark, sf_dir))


@register("join_games")
def join_games(spark, sf_dir):
    """J1 then J2: reviews x users x games."""
    return joined_reviews(*raw(spark, sf_dir))


@register("model_columns")
def model_columns(spark, sf_dir):
    """The 9 model columns (+ review key) after both joins."""
    return CL.model_columns(joined_reviews(*raw(spark, sf_dir)))


# ---------------------------------------------------------------- filters
@register("drop_nulls")
def drop_nulls(spark, sf_dir):
    """F1 only: typed rows with app, user, label and hours present."""
    return CL.drop_incomplete(CL.typed_with_features(joined_reviews(*raw(spark, sf_dir))))


@register("range_filtered")
def range_filtered(spark, sf_dir):
    """F2 only: plausibility bounds on hours, price and ratio."""
    return CL.in_plausible_range(CL.typed_with_features(joined_reviews(*raw(spark, sf_dir))))


@register("feature_complete_keys")
def feature_complete_keys(spark, sf_dir):
    """keys that survive the assembler's handleInvalid='skip'."""
    return TR.assembler().transform(processed_reviews(spark, sf_dir)).select("review_id")


# ---------------------------------------------------------------- sampling
def _sample(spark, sf_dir, n=SAMPLE_ROWS):
    return S.sample_fixed_size(T.reviews_raw(spark, sf_dir), n, "review_id", SAMPLE_SEED)


@register("sample_fixed_size")
def sample_fixed_size(spark, sf_dir):
    """L3 + P2: a seeded uniform sample of exactly 5,000 reviews, renamed."""
    return CL.reviews_renamed(_sample(spark, sf_dir), keep=("review_id",))


@register("preprocess_sample")
def preprocess_sample(spark, sf_dir):
    """L3 + P2 with the reference's own size (5,000,000 rows, seed 42): all rows
    when the table is smaller, as the reference's sampling step does."""
    from .jobs import SAMPLE_ROWS as REFERENCE_SAMPLE_ROWS
    sample = S.sample_fixed_size(T.reviews_raw(spark, sf_dir), REFERENCE_SAMPLE_ROWS, "review_id",
                                 SAMPLE_SEED)
    return CL.reviews_renamed(sample, keep=("review_id",))


@register("games_in_sample")
def games_in_sample(spark, sf_dir):
    """J3 + P4: games that occur in the reviews."""
    return CL.games_projected(J.games_in_sample(T.games_raw(spark, sf_dir), T.reviews_raw(spark, sf_dir)))


@register("users_in_sample")
def users_in_sample(spark, sf_dir):
    """J4 + P4: users who occur in the reviews."""
    return CL.users_projected(J.users_in_sample(T.users_raw(spark, sf_dir), T.reviews_raw(spark, sf_dir)))


@register("distinct_ids")
def distinct_ids(spark, sf_dir):
    """A2: distinct app and user IDs of all reviews."""
    return A.distinct_ids(T.reviews_raw(spark, sf_dir))


@register("first_n_reviews")
def first_n_reviews(spark, sf_dir):
    """L1: the LR training rows: first 500,000 processed rows by review key."""
    return S.first_n_by_key(processed_reviews(spark, sf_dir), TR.LR_ROWS)


@register("trimmed_rows")
def trimmed_rows(spark, sf_dir):
    """L2: a 5,000,000-line trim (header included) of the reviews file."""
    return S.trim_rows(T.reviews_raw(spark, sf_dir), TRIM_LINES)


@register("first_tenth_reviews")
def first_tenth_reviews(spark, sf_dir):
    """L1 with a cut: the first tenth of the processed rows by review key."""
    rows = processed_reviews(spark, sf_dir)
    return S.first_n_by_key(rows, rows.count() // 10)


@register("trimmed_half")
def trimmed_half(spark, sf_dir):
    """L2 with a cut: a trim to half of the reviews file (header included)."""
    rows = T.reviews_raw(spark, sf_dir)
    return S.trim_rows(rows, rows.count() // 2 + 1)


@register("sample_third")
def sample_third(spark, sf_dir):
    """L3 with a cut that grows with the table: a third of the reviews, renamed."""
    rows = T.reviews_raw(spark, sf_dir)
    return CL.reviews_renamed(S.sample_fixed_size(rows, rows.count() // 3, "review_id", SAMPLE_SEED), keep=("review_id",))


@register("first_n_text_keys")
def first_n_text_keys(spark, sf_dir):
    """L1 over keys that are no numbers (as landed messages have them), and tie: two thirds of the reviews by the
    md5 of the user, then by the review."""
    rows = T.reviews_raw(spark, sf_dir)
    terms = {"user": (F.md5("user_id"), "text"), "review": (F.col("review_id").cast("bigint"), "long")}
    return S.exact_first_n(rows, rows.count() * 2 // 3, terms)[0]


# ---------------------------------------------------------------- aggregates
@register("stage_counts")
def stage_counts(spark, sf_dir):
    """A1: rows per input and per prepare stage."""
    return A.stage_counts(*raw(spark, sf_dir))


@register("als_triples")
def als_triples(spark, sf_dir):
    """P3 + F3: ALS input from processed reviews."""
    return CL.als_triples(processed_reviews(spark, sf_dir))


@register("auc_exact")
def auc_exact(spark, sf_dir):
    """A3: exact AUC of extended price as a score for the 'R' return flag."""
    li = T.table(spark, sf_dir, "lineitem").select(
        "l_extendedprice", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return A.exact_auc(li, "l_extendedprice", "label")


@register("als_triples_unfiltered")
def als_triples_unfiltered(spark, sf_dir):
    """F3 with rows to drop: ALS input from typed rows before F1 and F2."""
    return CL.als_triples(CL.typed_with_features(joined_reviews(*raw(spark, sf_dir))))


@register("auc_by_levels")
def auc_by_levels(spark, sf_dir):
    """A3 where prefix sums take several levels: windows of 1,000 scores at most."""
    li = T.table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") - 30000.0).alias("score"), (F.col("l_returnflag") == "R").cast("int").alias("label"))
    return A.exact_auc(li, "score", "label", window_rows=1000)


@register("rejected_reviews")
def rejected_reviews(spark, sf_dir):
    """F1 + F2 as a routing: every joined review that is dropped, with the reason."""
    return routed_reviews(*raw(spark, sf_dir)).where(F.col("outcome") != CL.ACCEPTED).select("review_id", F.col("outcome").alias("reason"))


@register("routed_stage_counts")
def routed_stage_counts(spark, sf_dir):
    """K1 + A1: one routed write of all joined rows, by outcome and date; the rows per outcome from its footers."""
    path = IN.scratch_dir(spark, "routed")
    write_processed(routed_reviews(*raw(spark, sf_dir)), path, ["outcome", "date"])
    return A.written_outcomes(spark, path)


@register("processed_by_date")
def processed_by_date(spark, sf_dir):
    """K1: processed rows written partitioned by date and read back, dates as text."""
    path = IN.scratch_dir(spark, "processed")
    write_processed(processed_reviews(spark, sf_dir), path, ["date"])
    return SF.read_processed(spark, path)


@register("csv_round_trip")
def csv_round_trip(spark, sf_dir):
    """Reviews, users and games written as CSV files, read by the fixed schemas, prepared."""
    path = IN.scratch_dir(spark, "csv")
    for name, df in zip(("reviews", "users", "games"), raw(spark, sf_dir)):
        write_csv(df, f"{path}/{name}")
    return _processed(SF.read_reviews_csv(spark, f"{path}/reviews"), SF.read_users_csv(spark, f"{path}/users"),
                      SF.read_games_csv(spark, f"{path}/games"))


@register("landed_with_skipped_files")
def landed_with_skipped_files(spark, sf_dir):
    """S4 + S5: landed batches with files among them that are no Parquet: rows that are read, and files that are
    skipped, with their size. There is one broken file for each event type, and a sound one without rows."""
    path = IN.scratch_dir(spark, "batches")
    reviews = T.reviews_raw(spark, sf_dir).select(*MESSAGE_COLUMNS)
    reviews.write.parquet(f"{path}/batch_id=1")
    kinds = T.table(spark, sf_dir, "events").select("event_type").distinct()
    kinds = kinds.select(F.concat(F.lit("no Parquet: "), "event_type").alias("value"), (F.crc32("event_type") + 2).alias("batch_id"))
    kinds.write.mode("append").partitionBy("batch_id").text(path)
    reviews.limit(0).write.parquet(f"{path}/batch_id=2")
    read = SF.read_batches(spark, path).agg(F.count(F.lit(1)).alias("rows"))
    skipped = SF.skipped_files(spark, path).agg(F.count(F.lit(1)).alias("skipped"), F.sum("length").alias("skipped_bytes"))
    return read.join(skipped, F.lit(True))


@register("rmse")
def rmse(spark, sf_dir):
    """RMSE of extended price / 1000 as a prediction of quantity."""
    li = T.table(spark, sf_dir, "lineitem").select(
        (F.col("l_extendedprice") / 1000.0).alias("prediction"), F.col("l_quantity").alias("label"))
    return A.rmse(li, "prediction", "label")


# ---------------------------------------------------------------- messages
@register("review_messages")
def review_messages(spark, sf_dir):
    """K3 + P16: the JSON payload published for each review."""
    r = T.reviews_raw(spark, sf_dir)
    return r.select("review_id", encode_message().alias("value"))


@register("message_decoded")
def message_decoded(spark, sf_dir):
    """P17 + F5 + P15: landable messages, aligned to the five fields."""
    return landable(decode_messages(T.messages_raw(spark, sf_dir)), keep=("msg_id",))


@register("messages_quarantined")
def messages_quarantined(spark, sf_dir):
    """messages that are not JSON objects, with a reason."""
    return quarantined(decode_messages(T.messages_raw(spark, sf_dir)), keep=("msg_id",))


# ---------------------------------------------------------------- requests
def _requests_split(spark, sf_dir):
    req = T.requests(spark, sf_dir)
    ok = F.col("hours").isNotNull() & ~F.isnan("hours")
    return req.filter(ok), req.filter(~ok | F.col("hours").isNull())


@register("request_features")
def request_features(spark, sf_dir):
    """P13 + P14: serving features with defaults, for valid requests."""
    return _request_features(_requests_split(spark, sf_dir)[0])


@register("requests_rejected")
def requests_rejected(spark, sf_dir):
    """requests without hours, with the reason."""
    return _requests_split(spark, sf_dir)[1].select(
        "request_id", F.lit("missing 'hours' in features").alias("reason"))


# ---------------------------------------------------------------- models (rows-only checks)


def _labelled(spark, sf_dir):
    return T.labelled(processed_reviews(spark, sf_dir))


@register("lr_scores")
def lr_scores(spark, sf_dir):
    """M1 + M7 + M4 + P19: LR on the first 500k labelled rows, scoring every valid request."""
    model = TR.train_lr(_labelled(spark, sf_dir), evaluate=False).model
    return SC.score_requests(model, request_features(spark, sf_dir))


@register("gbt_scores")
def gbt_scores(spark, sf_dir):
    """M2 + M7 + M4 + P19: GBT on the first 750k labelled rows, scoring every valid request."""
    model = TR.train_gbt(_labelled(spark, sf_dir), evaluate=False).model
    return SC.score_requests(model, request_features(spark, sf_dir))


@register("train_metrics")
def train_metrics(spark, sf_dir):
    """A3 + A5: exact train / hold-out AUC and the > 0.70 gate for LR and GBT."""
    labelled = _labelled(spark, sf_dir)
    gbt_sel = TR.select_training_rows(labelled, TR.GBT_ROWS)
    lr_sel = TR.select_training_rows(gbt_sel[0], TR.LR_ROWS)  # first 500k of the first 750k
    from concurrent.futures import ThreadPoolExecutor

    try:
        with ThreadPoolExecutor(max_workers=2) as pool:  # two concurrent Spark jobs
            lr = pool.submit(TR.train_lr, labelled, holdout=0.2, selected=lr_sel)
            gbt = pool.submit(TR.train_gbt, labelled, holdout=0.2, selected=gbt_sel)
            results = (lr.result(), gbt.result())
    finally:
        lr_sel[0].unpersist()
        gbt_sel[0].unpersist()
    rows = [(r.name, r.rows, r.train_auc, r.test_auc, r.passed) for r in results]
    return spark.createDataFrame(
        rows, "model string, train_rows long, train_auc double, test_auc double, passed boolean")


@register("request_scores_checked")
def request_scores_checked(spark, sf_dir):
    """M1, M2, M4, P19, F4 as facts per request: scored or not, and why; each model's scores are probabilities."""
    labelled, requests = _labelled(spark, sf_dir), request_features(spark, sf_dir)
    # Requests whose features are not all there: the ratio is taken out again for ids ending in 3.
    broken = F.when(F.col("request_id").try_cast("bigint") % 10 == 3, F.lit(None).cast("double")).otherwise(F.col("positive_ratio_numeric"))
    requests = requests.withColumn("positive_ratio_numeric", broken)
    scores = [SC.score_requests(train(labelled, evaluate=False).model, requests).withColumn("model", F.lit(name))
              for name, train in ((TR.LR_NAME, TR.train_lr), (TR.GBT_NAME, TR.train_gbt))]
    p = F.col("probability")
    return scores[0].unionByName(scores[1]).select(
        "model", "request_id", p.isNotNull().alias("scored"), F.coalesce((p >= 0) & (p <= 1), F.lit(True)).alias("is_probability"), "reason")


@register("train_split_checked")
def train_split_checked(spark, sf_dir):
    """A4, A5 and the hold-out split as facts: rows trained on, rows held out, AUCs that pass the gate."""
    labelled = _labelled(spark, sf_dir)
    held = labelled.select(TR.holdout_flag(fraction=0.2).alias("held")).agg(F.count_if("held").alias("n")).first()["n"]
    rows = []
    for r in (TR.train_lr(labelled, holdout=0.2), TR.train_gbt(labelled, holdout=0.2)):
        rows.append((r.name, r.rows, held, r.passed, TR.AUC_TARGET < r.test_auc <= 1.0))
    return spark.createDataFrame(rows, "model string, train_rows long, held_out long, passed boolean, passed_held_out boolean")


@register("feature_vectors")
def feature_vectors(spark, sf_dir):
    """M7: the assembled vector, element by element."""
    v = TR.assembler().transform(processed_reviews(spark, sf_dir)).select("review_id", vector_to_array("features").alias("v"))
    return v.select("review_id", F.size("v").alias("n"), *[F.col("v")[i].alias(c) for i, c in enumerate(FEATURE_COLUMNS)])


@register("class_one_scores")
def class_one_scores(spark, sf_dir):
    """Element 1 of a vector, here (quantity, price, tax) of each order line."""
    li = T.table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", array_to_vector(F.array("l_quantity", "l_extendedprice", "l_tax")).alias("rawPrediction"))
    return TR.class_one_score(li).select("l_orderkey", "l_linenumber", "score")


@register("flattened_tops")
def flattened_tops(spark, sf_dir):
    """P20: lists of items and scores as ranked rows, here each customer's order lines of the highest price; customers
    without orders are one row without a rank."""
    lines = T.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    lines = lines.join(T.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey")
    best = F.sort_array(F.collect_list(F.struct("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey")), asc=False)
    tops = lines.groupBy("o_custkey").agg(F.slice(best, 1, SC.TOP_N).alias("b"))
    tops = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey")).join(tops, "o_custkey", "left")
    return SC.ranked(tops.select(F.col("o_custkey").alias("user"), F.col("b").isNotNull().alias("known"),
                                 F.col("b.l_partkey").alias("items"), F.col("b.l_extendedprice").alias("scores")))


def _asked_users(spark, sf_dir):
    """Every customer, and for each hundredth an id that is too large for the model and must stay apart."""
    ids = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("user"))
    return ids.unionByName(ids.where(F.col("user").cast("int") % 100 == 0).select(F.concat(F.lit("9999999999"), "user").alias("user")))


def _interactions(spark, sf_dir):
    """The interactions, joined once and written: the size check, the fit, ``exclude`` and the checks each read them,
    and would each shuffle orders and lineitem again. Their rows are counted from the footers."""
    triples, path = T.interactions(spark, sf_dir), IN.scratch_dir(spark, "interactions")
    triples.write.parquet(path)
    return spark.read.schema(triples.schema).parquet(path)


def _per_user(recs, seen):
    """Facts of an answer that hold for any model: per user its ranks, their order, and items seen before.

    Answers are shuffled once, by user; seen items are compared as one list a user (at most the catalogue, as in
    ``recommend_for``), merged before their shuffle."""
    w = Window.partitionBy("user").orderBy("rank")
    steps = recs.withColumn("rises", F.col("score") > F.lag("score").over(w))
    facts = steps.groupBy("user").agg(
        F.max("known").alias("known"), F.count("rank").alias("items"), F.countDistinct("app_id").alias("distinct_items"), F.max("rank").alias("last_rank"),
        F.count_if("rises").alias("rises"), F.collect_list("app_id").alias("app_ids"))
    had = seen.groupBy(F.col("user").cast("string").alias("user")).agg(F.collect_set("item").alias("had"))
    again = F.size(F.filter("app_ids", lambda item: F.array_contains("had", item))).cast("bigint")
    return facts.join(had, "user", "left").withColumn("seen_again", again).drop("app_ids", "had")


@register("recommendations_checked")
def recommendations_checked(spark, sf_dir):
    """M3, M5, L5, P20, F7 as facts per requested user: one answer for each id, known or not, min(10, items) ranked items."""
    triples = _interactions(spark, sf_dir)
    recs = SC.recommend_for(TR.train_als(triples, count_rows=True).model, _asked_users(spark, sf_dir))
    return _per_user(recs, triples.limit(0)).drop("seen_again")


@register("unseen_recommendations_checked")
def unseen_recommendations_checked(spark, sf_dir):
    """M5 with ``exclude``: the same, and no item that the user has had, min(10, unseen items) in all."""
    triples = _interactions(spark, sf_dir)
    recs = SC.recommend_for(TR.train_als(triples, count_rows=True).model, _asked_users(spark, sf_dir), exclude=triples)
    return _per_user(recs, triples)


@register("als_review_recommendations")
def als_review_recommendations(spark, sf_dir):
    """M3 + L5 + P20: ALS on (user, app, hours) of processed reviews; top 10 per user."""
    model = TR.train_als_from_processed(processed_reviews(spark, sf_dir)).model
    return SC.recommend_all(model)


@register("als_recommendations")
def als_recommendations(spark, sf_dir):
    """M3 + L5 + P20 at scale: ALS on orders x lineitem interactions; top 10 per user."""
    model = TR.train_als(_interactions(spark, sf_dir), count_rows=True).model
    return SC.recommend_all(model)


@register("recommend_requests")
def recommend_requests(spark, sf_dir):
    """M5 + F7: top 10 for every customer; customers without orders are flagged unknown."""
    model = TR.train_als(_interactions(spark, sf_dir), count_rows=True).model
    users = T.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user"))
    return SC.recommend_for(model, users)


# ---------------------------------------------------------------- streaming


@register("ingest_stream")
def ingest_stream(spark, sf_dir):
    """T1 + T3 + K4: the review messages written as JSON-lines files, landed by
    a checkpointed stream (availableNow), read back from the landed batches."""
    base = IN.scratch_dir(spark, "ingest")
    T.messages_raw(spark, sf_dir).select("value").write.text(f"{base}/in")
    query = IN.start_ingest(IN.read_json_lines(spark, f"{base}/in", files_per_trigger=4),
                            f"{base}/landed", f"{base}/quarantine", f"{base}/checkpoint",
                            trigger={"availableNow": True})
    query.awaitTermination()
    return IN.read_landed(spark, f"{base}/landed").select("msg_key", *MESSAGE_COLUMNS)


@register("als_train_rmse")
def als_train_rmse(spark, sf_dir):
    """A6 on the model: RMSE of ALS (reviews) predictions on its training triples."""
    triples = CL.als_triples(processed_reviews(spark, sf_dir))
    model = TR.train_als(triples).model
    return A.rmse(model.transform(triples), "prediction", "rating")


@register("join_users_semi")
def join_users_semi(spark, sf_dir):
    """J1 with the user key declared unique: a semi join (no repeats, no user columns)."""
    return J.join_users(T.reviews_raw(spark, sf_dir), T.users_raw(spark, sf_dir), users_unique=True)


@register("processed_from_messages")
def processed_from_messages(spark, sf_dir):
    """The two data paths joined: landable review messages go through the same
    casts, joins and filters as the CSV path (the message position is the key)."""
    landed = landable(decode_messages(T.messages_raw(spark, sf_dir)), keep=("msg_id",))
    reviews = IN.reviews_from_landed(landed.withColumn("msg_key", F.col("msg_id").cast("string")))
    return _processed(reviews, T.users_raw(spark, sf_dir), T.games_raw(spark, sf_dir))
