"""Named queries: each takes (spark, sf_dir) and returns a DataFrame.

Every query derives its rows from the input tables (through the
``transactions`` view), so its work grows with the data.  Raw timestamps
are not emitted; dates are strings and hours are ints.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.operators import crossfit, encode, evaluate as ev, explore, features as feat, split, tiers
from ledgerlens.plans import datasets as ds
from ledgerlens.sources import sinks

LAB = config.TARGET_COL
Query = Callable[[SparkSession, str], DataFrame]

CLEAN_OUT = ["From_Bank", "From_Account", "To_Bank", "To_Account", "Amount_Received", "Receiving_Currency",
             "Amount_Paid", "Payment_Currency", "Payment_Format", LAB, "Hour", "Day_of_Week",
             "Is_Currency_Conversion"]


def _date_str() -> F.Column:
    return F.to_date("Timestamp").cast("string").alias("tx_date")


# ---------------------------------------------------------------- ingest / split
def q_ingest_clean(spark, sf):
    from ledgerlens.sources import raw_csv
    return raw_csv.ingest_roundtrip(spark, sf, ds.tx(spark, sf)).select(_date_str(), F.date_format("Timestamp", "HH:mm").alias("tx_time"),
                                                      *CLEAN_OUT)


def q_split_counts(spark, sf):
    return split.split_counts(ds.tx_split(spark, sf))


def _balanced_labels(spark, sf):
    """Key and label of the balanced training rows: which rows they are needs no features."""
    train = ds.tx_split(spark, sf).where(F.col("split") == "train").select("tx_key", LAB)
    return split.downsample(train, fraction_source=train)


def q_downsample_counts(spark, sf):
    bal = _balanced_labels(spark, sf)
    return bal.groupBy(LAB).agg(F.count(F.lit(1)).alias("n"))


def q_split_exact(spark, sf):
    return split.exact_split(ds.tx(spark, sf).select("tx_key", LAB)).select("tx_key", "split")


def q_split_exact_counts(spark, sf):
    return split.split_counts(split.exact_split(ds.tx(spark, sf).select("tx_key", LAB)))


def q_downsample_exact(spark, sf):
    train = ds.tx_split(spark, sf).where(F.col("split") == "train").select("tx_key", LAB)
    return split.exact_downsample(train)


# ---------------------------------------------------------------- features
def _side_features(spark, sf, side):
    """The velocity table is unique by (account, day): the rows meet it in one join."""
    s = ds.tx_split(spark, sf)
    fact = feat._attach(feat.with_date(s), feat.velocity_24h(s.where(F.col("split") == "train"), side), side)
    cols = [side.count_24h, side.amount_24h]
    return fact.select("tx_key", "split", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in cols])


def q_velocity_sender(spark, sf):
    return _side_features(spark, sf, feat.SENDER)


def q_velocity_receiver(spark, sf):
    return _side_features(spark, sf, feat.RECEIVER)


def q_sender_profile(spark, sf):
    train = ds.tx_split(spark, sf).where(F.col("split") == "train")
    return feat.account_profile(train, feat.SENDER)


def q_receiver_profile(spark, sf):
    train = ds.tx_split(spark, sf).where(F.col("split") == "train")
    return feat.account_profile(train, feat.RECEIVER)


def q_feature_table(spark, sf):
    f = ds.features(spark, sf)
    return f.select("tx_key", "split", _date_str(), *CLEAN_OUT, *feat.FEATURE_COLUMNS)


def q_feature_table_excluding_self(spark, sf):
    rows = ds.tx_split(spark, sf).select("tx_key", "split", "Timestamp", *[c for s in (feat.SENDER, feat.RECEIVER) for c in (s.account, s.amount)])
    f = feat.build_features_excluding_self(rows, ds.cut(spark, sf, "excluding_self"))
    return f.select("tx_key", "split", *feat.FEATURE_COLUMNS)


def q_ordinal_map(spark, sf):
    return ds.encoder_mapping(spark, sf)


def q_ordinal_encode(spark, sf):
    s = ds.tx_split(spark, sf)
    train = s.where(F.col("split") == "train")
    rows = split.downsample(train, fraction_source=train).unionByName(s.where(F.col("split") == "test"))
    enc = encode.transform_ordinal(rows.select("tx_key", "split", *config.CATEGORICAL_COLS), ds.encoder_mapping(spark, sf))
    return enc


# ---------------------------------------------------------------- exploration
def _on_tx(fn):
    return lambda spark, sf: fn(ds.tx(spark, sf))


def _on_test(fn):
    return lambda spark, sf: fn(ds.test_rows(spark, sf))


def q_correlation(spark, sf):
    return explore.correlation(ds.train_balanced(spark, sf))


def q_class_weight(spark, sf):
    return explore.class_weight(_balanced_labels(spark, sf))


# ---------------------------------------------------------------- evaluation
def _pred(spark, sf):
    return ds.fixture_predictions(spark, sf)


def q_confusion_default(spark, sf):
    return ev.confusion(_pred(spark, sf), ev.predict_at(config.DEFAULT_THRESHOLD))


def q_threshold_sweep(spark, sf):
    return ev.sweep(_pred(spark, sf)).select("threshold", "precision", "recall", "f1_score", "accuracy",
                                             "true_positives", "false_positives")


def q_best_static_threshold(spark, sf):
    return ev.best_static_threshold(ev.sweep(_pred(spark, sf)))


def q_confusion_tuned(spark, sf):
    p = _pred(spark, sf)
    t = ev.best_static_threshold(ev.sweep(p)).select("threshold").scalar()
    c = ev.confusion(p, ev.predict_at(t))
    return c.select(t.alias("threshold"), "*",
                    (F.col("true_positives") + F.col("false_positives")).alias("alerts"))


def q_metrics_default(spark, sf):
    return ev.with_metrics(ev.confusion(_pred(spark, sf), ev.predict_at(config.DEFAULT_THRESHOLD)))


def q_metrics_tuned(spark, sf):
    p = _pred(spark, sf)
    t = ev.best_static_threshold(ev.sweep(p)).select("threshold").scalar()
    return ev.with_metrics(ev.confusion(p, ev.predict_at(t))).select(t.alias("threshold"), "*")


def q_pr_baseline(spark, sf):
    return ev.positive_rate(_pred(spark, sf))


def _curve_points(spark, sf):
    """Curve table of the fixture scores (one row per distinct score), staged once."""
    return ds.stage(spark, sf, "curve_points", lambda: ev.curve_points(_pred(spark, sf)))


def _areas(spark, sf):
    return ds.small_table(spark, sf, "curve_areas", lambda: ev.curve_areas_from(_curve_points(spark, sf)))


def q_pr_curve(spark, sf):
    return ev.pr_curve_from(_curve_points(spark, sf))


def q_roc_curve(spark, sf):
    return ev.roc_curve_from(_curve_points(spark, sf))


def q_pr_auc(spark, sf):
    return _areas(spark, sf).select(F.round("pr_auc", 10).alias("pr_auc"))


def q_roc_auc(spark, sf):
    return _areas(spark, sf).select(F.round("roc_auc", 10).alias("roc_auc"))


# ---------------------------------------------------------------- risk tiers
# The bucket table (exact cut points over every transaction), the boundaries and the
# per-tier thresholds are small stage outputs: each is computed once and reused.
def _buckets(spark, sf):
    return ds.small_table(spark, sf, "amount_buckets", lambda: tiers.amount_buckets(ds.tx(spark, sf)))


def _boundaries(spark, sf):
    return ds.small_table(spark, sf, "rba_boundaries", lambda: tiers.tier_boundaries(_buckets(spark, sf)))


def _tiered_pred(spark, sf):
    return tiers.with_tier(_pred(spark, sf), _boundaries(spark, sf))


def _tier_table(spark, sf):
    return ds.small_table(spark, sf, "rba_tier_config", lambda: tiers.tier_thresholds(_tiered_pred(spark, sf)))


def q_amount_buckets(spark, sf):
    return _buckets(spark, sf)


def q_rba_boundaries(spark, sf):
    return _boundaries(spark, sf)


def q_bucket_tiers(spark, sf):
    return tiers.bucket_tiers(_buckets(spark, sf), _boundaries(spark, sf))


def q_rba_tier_thresholds(spark, sf):
    return _tier_table(spark, sf)


def q_rba_apply(spark, sf):
    return tiers.apply_tiers(_tiered_pred(spark, sf), _tier_table(spark, sf)).select("tx_key", "tier",
                                                                                     "y_pred_dynamic")


def q_rba_metrics(spark, sf):
    applied = tiers.apply_tiers(_tiered_pred(spark, sf), _tier_table(spark, sf))
    return ev.with_metrics(ev.confusion(applied, F.col("y_pred_dynamic")))


def q_tier_segmentation(spark, sf):
    return tiers.segmentation(ds.tx(spark, sf), _boundaries(spark, sf))


def q_model_comparison(spark, sf):
    from ledgerlens.operators import report
    return report.model_comparison(_pred(spark, sf), "fixture_score", tier_table=_tier_table(spark, sf),
                                   boundaries=_boundaries(spark, sf), areas=_areas(spark, sf))


def q_model_comparison_long(spark, sf):
    from ledgerlens.operators import report
    return report.comparison_long(q_model_comparison(spark, sf))


# thresholds tuned apart from the rows they judge
def _fold_pred(spark, sf):
    return crossfit.with_fold(_tiered_pred(spark, sf))


def _fold_table(spark, sf):
    return ds.small_table(spark, sf, "crossfit_thresholds", lambda: crossfit.tier_thresholds(_fold_pred(spark, sf)))


def q_crossfit_static_thresholds(spark, sf):
    return crossfit.static_thresholds(crossfit.with_fold(_pred(spark, sf)))


def q_crossfit_tier_thresholds(spark, sf):
    return _fold_table(spark, sf)


def q_crossfit_apply(spark, sf):
    return crossfit.apply_tiers(_fold_pred(spark, sf), _fold_table(spark, sf)).select("tx_key", "fold", "tier", "y_pred_dynamic")


def q_crossfit_metrics(spark, sf):
    return ev.with_metrics(ev.confusion(crossfit.apply_tiers(_fold_pred(spark, sf), _fold_table(spark, sf)), F.col("y_pred_dynamic")))


# ---------------------------------------------------------------- account state
def _account_state(spark, sf):
    """The state after three merges: training rows of early, middle and late days."""
    from ledgerlens.operators.account_state import AccountState
    from ledgerlens.session import scratch_dir

    def build():
        train = feat.with_date(ds.tx_split(spark, sf).where(F.col("split") == "train"))
        a, b = train.agg(F.min("Date"), F.max("Date")).first()
        state = AccountState(spark, scratch_dir(spark, "account-state"))
        third = (b - a) / 3
        day = F.col("Date")
        for i, rows in enumerate([day <= a + third, (day > a + third) & (day <= a + 2 * third), (day > a + 2 * third) | day.isNull()]):
            state.merge(i, train.where(rows).drop("Date"))
        return state
    return ds.kept(spark, sf, "account_state", build)


def _state_profile(name):
    return lambda spark, sf: _account_state(spark, sf).profile(name)


def _state_velocity(name):
    """The velocity tables joined to all rows, as in ``velocity_sender`` and ``velocity_receiver``."""
    def run(spark, sf):
        from ledgerlens.operators.account_state import SIDES
        side, fact = SIDES[name], feat.with_date(ds.tx_split(spark, sf))
        fact = feat._attach(fact, _account_state(spark, sf).velocity(name), side)
        return fact.select("tx_key", "split", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in (side.count_24h, side.amount_24h)])
    return run


# ---------------------------------------------------------------- sinks, read back
def _sink_path(spark, name):
    from ledgerlens.session import scratch_dir
    return scratch_dir(spark, f"sink-{name}")


def q_sink_parquet(spark, sf):
    """The feature table as the pipeline writes it, by split."""
    table = q_feature_table(spark, sf)
    path = sinks.write_parquet(table, _sink_path(spark, "features"), ["split"])
    return spark.read.parquet(path).select(*[F.col(f.name).cast(f.dataType) for f in table.schema])


def q_sink_predictions(spark, sf):
    """Scored rows with tier and decision as the pipeline writes them, by model."""
    path = sinks.write_parquet(q_rba_apply(spark, sf).withColumn("model", F.lit("fixture_score")), _sink_path(spark, "predictions"), ["model"])
    return spark.read.parquet(path).where(F.col("model") == "fixture_score").drop("model")


def q_sink_json(spark, sf):
    table = explore.daily_timeline(ds.tx(spark, sf))
    path = _sink_path(spark, "timeline")
    sinks.write_json(table, path)
    return spark.read.schema(table.schema).json(path)


def q_sink_csv(spark, sf):
    table = q_model_comparison(spark, sf)
    path = _sink_path(spark, "comparison")
    sinks.write_csv(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


def q_sink_encoder(spark, sf):
    """The stored encoder, as scoring reads it."""
    return spark.read.parquet(sinks.write_parquet(ds.encoder_mapping(spark, sf), _sink_path(spark, "encoder")))


# ---------------------------------------------------------------- models
def _encoded_sets(spark, sf):
    """Encoded training and test rows, stored once for every model."""
    def build():
        rows = ds.balanced_rows(spark, sf).unionByName(ds.test_rows(spark, sf))
        rows = rows.select("tx_key", "split", LAB, "Timestamp", *[c for c in rows.columns if c in config.MODEL_FEATURES and c != LAB],
                           *[s.account for s in (feat.SENDER, feat.RECEIVER) if s.account not in config.MODEL_FEATURES])
        needed = ds.features_of(spark, sf, rows, "encoded").select("tx_key", "split", LAB, *config.MODEL_FEATURES)
        return encode.transform_ordinal(needed, ds.encoder_mapping(spark, sf))
    both = ds.stage(spark, sf, "encoded", build)
    return both.where(F.col("split") == "train"), both.where(F.col("split") == "test")


def q_assemble_features(spark, sf):
    """The assembled vector, one column for each model input."""
    from pyspark.ml.functions import vector_to_array

    from ledgerlens.operators import models
    train, test = _encoded_sets(spark, sf)
    rows = models.assembler().transform(train.unionByName(test)).select("tx_key", "split", LAB, vector_to_array("features").alias("v"))
    out = rows.select("tx_key", "split", LAB, *[F.col("v")[i].alias(c) for i, c in enumerate(config.MODEL_FEATURES)])
    return out


def _model(spark, sf, estimator_factory):
    """A model on the full settings; the second-order booster follows PR-AUC on the test rows by round."""
    from ledgerlens.operators import models
    train, test = _encoded_sets(spark, sf)
    valid = test if estimator_factory == "boosted_b" else None
    return ds.fitted_model(spark, sf, estimator_factory,
                           lambda: models.fit(train, getattr(models, estimator_factory)(), valid))


def _side_by_side(of, factories):
    """``of`` each factory's name; fits do not depend on each other, so they run at once."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(len(factories)) as pool:
        return list(pool.map(of, factories))


def _predictions(spark, sf, estimator_factory):
    """A model's scored test rows, stored: the reports read them several times."""
    from ledgerlens.operators import models
    _, test = _encoded_sets(spark, sf)
    return ds.stage(spark, sf, f"predictions_{estimator_factory}",
                    lambda: models.score(_model(spark, sf, estimator_factory), test))


def _model_scores(estimator_factory):
    return lambda spark, sf: _predictions(spark, sf, estimator_factory)


def _score_rows(estimator_factory):
    """What SQL can check of a score table: one row a test key, its label, a probability within [0, 1]."""
    def run(spark, sf):
        return _predictions(spark, sf, estimator_factory).select("tx_key", "y_true", F.col("y_prob").between(0, 1).alias("in_bounds"))
    return run


def q_feature_importance(spark, sf):
    """Total gain by feature of both boosters, all features, largest first; summed while the trees were grown."""
    from ledgerlens.operators import models
    _encoded_sets(spark, sf)
    fitted = _side_by_side(lambda f: _model(spark, sf, f), ["boosted_a", "boosted_b"])
    both = [models.feature_importance(m, top=None).withColumn("Model", F.lit(name)) for name, m in zip(("gbt_a", "gbt_b"), fitted)]
    return both[0].unionByName(both[1])


def _rounds(estimator_factory):
    """The ledger of a booster's rounds: leaves, rows in them, training loss, PR-AUC on validation rows."""
    return lambda spark, sf: _model(spark, sf, estimator_factory).stages[-1].ledger(spark)


def _round_checks(spark, sf, estimator_factory, max_leaves, row_share):
    """What SQL can know of the rounds: rows in leaves, limits, and the loss of the model without trees."""
    rounds = _rounds(estimator_factory)(spark, sf)
    before = F.lag("loss").over(Window.orderBy("round"))  # 301 rows
    n = rounds.join(F.broadcast(_encoded_sets(spark, sf)[0].agg(F.count(F.lit(1)).alias("n_train"))))  # one row
    held = (F.col("n_rows") == F.col("n_train")) if row_share == 1 else (F.abs(F.col("n_rows") / F.col("n_train") - row_share) < 0.05)
    return n.select("round", "n_train", ((F.col("round") == 0) | held).alias("rows_in_leaves"),
                    (F.col("n_leaves") <= max_leaves).alias("leaves_in_limit"),
                    F.coalesce(F.col("loss") < before, F.lit(True)).alias("loss_falls"),
                    F.when(F.col("round") == 0, F.round("loss", 4)).alias("first_loss"))


def q_gbt_a_round_checks(spark, sf):
    return _round_checks(spark, sf, "boosted_a", config.GBT_A_LEAVES, 1)


def q_gbt_b_round_checks(spark, sf):
    return _round_checks(spark, sf, "boosted_b", 1 << config.GBT_B_MAX_DEPTH, config.GBT_B_SUBSAMPLE)


def q_model_comparison_trained(spark, sf):
    """Comparison over the trained models, as the source pipeline reports it: tiers are tuned on
    the leaf-wise booster's test scores and reused for the depth-wise one; the forest gets none."""
    from functools import reduce

    from ledgerlens.operators import report
    bounds = _boundaries(spark, sf)
    factories = {"random_forest": "random_forest", "gbt_a": "boosted_a", "gbt_b": "boosted_b"}
    _encoded_sets(spark, sf)  # stored before the fits, which do not depend on each other, run side by side
    preds = dict(zip(factories, _side_by_side(lambda f: _predictions(spark, sf, f), list(factories.values()))))
    tier_table = tiers.tier_thresholds(tiers.with_tier(preds["gbt_a"], bounds))
    rows = [report.model_comparison(preds["random_forest"], "random_forest"),
            report.model_comparison(preds["gbt_a"], "gbt_a", tier_table, bounds),
            report.model_comparison(preds["gbt_b"], "gbt_b", tier_table, bounds)]
    return reduce(DataFrame.unionByName, rows)


def _sql(name):
    def run(spark, sf):
        from ledgerlens.plans import sql_views
        return sql_views.run(spark, ds.tx(spark, sf), name)
    return run


QUERIES: dict[str, Query] = {
    "ingest_clean": q_ingest_clean,
    "class_distribution": _on_tx(explore.class_distribution),
    "amount_stats": _on_tx(explore.amount_stats),
    "payment_format_mix": _on_tx(explore.payment_format_mix),
    "daily_timeline": _on_tx(explore.daily_timeline),
    "top_senders": _on_tx(explore.top_senders),
    "hourly_distribution": _on_tx(explore.hourly_distribution),
    "fraud_daily": _on_tx(explore.fraud_daily),
    "fraud_hourly": _on_tx(explore.fraud_hourly),
    "fraud_peak_hour": _on_tx(explore.fraud_peak_hour),
    "amount_buckets": q_amount_buckets,
    "format_share": _on_test(explore.format_share),
    "class_median": _on_test(explore.class_median),
    "amount_log_box": _on_test(explore.amount_log_box),
    "split_counts": q_split_counts,
    "downsample_counts": q_downsample_counts,
    "split_exact": q_split_exact,
    "split_exact_counts": q_split_exact_counts,
    "downsample_exact": q_downsample_exact,
    "velocity_sender": q_velocity_sender,
    "velocity_receiver": q_velocity_receiver,
    "sender_profile": q_sender_profile,
    "receiver_profile": q_receiver_profile,
    "feature_table": q_feature_table,
    "feature_table_excluding_self": q_feature_table_excluding_self,
    "correlation": q_correlation,
    "class_weight": q_class_weight,
    "ordinal_map": q_ordinal_map,
    "ordinal_encode": q_ordinal_encode,
    "confusion_default": q_confusion_default,
    "threshold_sweep": q_threshold_sweep,
    "best_static_threshold": q_best_static_threshold,
    "confusion_tuned": q_confusion_tuned,
    "metrics_default": q_metrics_default,
    "metrics_tuned": q_metrics_tuned,
    "pr_baseline": q_pr_baseline,
    "pr_curve": q_pr_curve,
    "roc_curve": q_roc_curve,
    "pr_auc": q_pr_auc,
    "roc_auc": q_roc_auc,
    "rba_boundaries": q_rba_boundaries,
    "bucket_tiers": q_bucket_tiers,
    "rba_tier_thresholds": q_rba_tier_thresholds,
    "rba_apply": q_rba_apply,
    "rba_metrics": q_rba_metrics,
    "tier_segmentation": q_tier_segmentation,
    "model_comparison": q_model_comparison,
    "model_comparison_long": q_model_comparison_long,
    "crossfit_static_thresholds": q_crossfit_static_thresholds,
    "crossfit_tier_thresholds": q_crossfit_tier_thresholds,
    "crossfit_apply": q_crossfit_apply,
    "crossfit_metrics": q_crossfit_metrics,
    "state_sender_profile": _state_profile("sender"),
    "state_receiver_profile": _state_profile("receiver"),
    "state_velocity_sender": _state_velocity("sender"),
    "state_velocity_receiver": _state_velocity("receiver"),
    "sink_parquet": q_sink_parquet,
    "sink_predictions": q_sink_predictions,
    "sink_json": q_sink_json,
    "sink_csv": q_sink_csv,
    "sink_encoder": q_sink_encoder,
    "assemble_features": q_assemble_features,
    "rf_scores": _model_scores("random_forest"),
    "gbt_a_scores": _model_scores("boosted_a"),
    "gbt_b_scores": _model_scores("boosted_b"),
    "rf_score_rows": _score_rows("random_forest"),
    "gbt_a_score_rows": _score_rows("boosted_a"),
    "gbt_b_score_rows": _score_rows("boosted_b"),
    "gbt_a_rounds": _rounds("boosted_a"),
    "gbt_b_rounds": _rounds("boosted_b"),
    "gbt_a_round_checks": q_gbt_a_round_checks,
    "gbt_b_round_checks": q_gbt_b_round_checks,
    "feature_importance": q_feature_importance,
    "model_comparison_trained": q_model_comparison_trained,
    "sql_class_distribution": _sql("class_distribution"),
    "sql_amount_stats": _sql("amount_stats"),
    "sql_payment_format_mix": _sql("payment_format_mix"),
    "sql_daily_timeline": _sql("daily_timeline"),
    "sql_top_senders": _sql("top_senders"),
    "sql_hourly_distribution": _sql("hourly_distribution"),
}
