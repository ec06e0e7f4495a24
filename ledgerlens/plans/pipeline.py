"""The staged batch job: raw CSV -> cleaned -> features -> encoded -> models -> evaluation.

Every stage writes its output (Parquet, or JSON/CSV for small result
tables) and is skipped when that output already has a ``_SUCCESS`` marker,
so a re-run after a failure resumes at the first unfinished stage.
Stage outputs also cut lineage: later stages scan them instead of
recomputing joins.

    python -m ledgerlens.plans.pipeline --raw <csv path or dir> --out <dir>
"""

from __future__ import annotations

import argparse
import hashlib
import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.operators import crossfit, encode, evaluate as ev, explore, models, report, split, tiers
from ledgerlens.operators.features import build_features_from, lookup_tables
from ledgerlens.sources import ingest, sinks

EDA_TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {
    "class_distribution": explore.class_distribution,
    "amount_stats": explore.amount_stats,
    "payment_format_eda": explore.payment_format_mix,
    "daily_fraud_timeline": explore.daily_timeline,
    "top_accounts": explore.top_senders,
    "hourly_distribution": explore.hourly_distribution,
    "fraud_rate_by_bucket": tiers.amount_buckets,
}


CHARTS_ALL: dict[str, Callable[[DataFrame], DataFrame]] = {
    "fraud_daily": explore.fraud_daily,
    "fraud_hourly": explore.fraud_hourly,
    "fraud_peak_hour": explore.fraud_peak_hour,
}
CHARTS_TEST: dict[str, Callable[[DataFrame], DataFrame]] = {
    "format_share": explore.format_share,
    "class_median": explore.class_median,
    "amount_log_box": explore.amount_log_box,
}


def with_row_key(df: DataFrame) -> DataFrame:
    """Content hash of the cleaned columns: a stable key for split and sampling."""
    return df.withColumn("tx_key", F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(""))
                                                             for c in df.columns]), 256))


class Pipeline:
    def __init__(self, spark: SparkSession, out_dir: str, estimators: dict | None = None,
                 tuning_model: str = "gbt_a", untiered: tuple[str, ...] = ("random_forest",)):
        self.spark, self.out = spark, out_dir.rstrip("/")
        self.estimators = estimators or {"random_forest": models.random_forest(), "gbt_a": models.boosted_a(),
                                         "gbt_b": models.boosted_b()}
        self.tuning_model, self.untiered = tuning_model, untiered
        self.inputs: str | None = None  # digest of the raw files, settings and code: known once the raw path is

    def digest(self, of_models: bool = False) -> str:
        """What a stage is made from: another digest builds it again."""
        parts = [self.inputs or "", *([models.describe(e) for e in self.estimators.values()] + [repr((self.tuning_model, self.untiered))] if of_models else [])]
        return hashlib.sha256("\n".join(parts).encode()).hexdigest()

    def _built(self, path: str, build: Callable[[], None], of_models: bool = False, marker: str = "_SUCCESS") -> None:
        """Run ``build`` unless ``path`` holds a finished write made from the same inputs."""
        if not sinks.stage_done(self.spark, path, self.digest(of_models), marker):
            build()
            sinks.write_manifest(self.spark, path, self.digest(of_models))

    def path(self, *parts: str) -> str:
        return "/".join([self.out, *parts])

    def _parquet_stage(self, name: str, build: Callable[[], DataFrame], partition_by=None, of_models: bool = False) -> DataFrame:
        p = self.path(name)
        self._built(p, lambda: sinks.write_parquet(build(), p, partition_by), of_models)
        return self.spark.read.parquet(p)

    # S1-S3, P1-P6
    def cleaned(self, raw_path: str) -> DataFrame:
        settings = repr(sorted((k, v) for k, v in vars(config).items() if k.isupper()))
        self.inputs = "\n".join([sinks.files_digest(self.spark, raw_path), sinks.code_digest(), settings])
        return self._parquet_stage("cleaned", lambda: with_row_key(ingest.ingest(self.spark, raw_path)))

    # M1, J1-J6, A1-A6, M2
    def features(self, cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
        s = split.with_split(cleaned)
        lookups = self.lookups(s.where(F.col("split") == "train"))
        feat = self._parquet_stage("features", lambda: build_features_from(s, lookups), ["split"])
        train = feat.where(F.col("split") == "train")
        balanced = self._parquet_stage(
            "train_balanced_raw", lambda: split.downsample(train, fraction_source=train.select(config.TARGET_COL)))
        return balanced, feat.where(F.col("split") == "test")

    def lookups(self, train: DataFrame) -> dict[str, DataFrame]:
        """The fitted per-account lookup tables, staged once: the batch features and every
        streaming micro-batch join against them instead of re-aggregating the train rows."""
        tables = lookup_tables(train)
        return {name: self._parquet_stage(f"lookups/{name}", lambda df=df: df) for name, df in tables.items()}

    # M3-M5
    def encoded(self, balanced: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame]:
        mapping = self._parquet_stage("encoder", lambda: encode.fit_ordinal(balanced))
        train_e = self._parquet_stage("train_balanced", lambda: encode.transform_ordinal(balanced, mapping))
        test_e = self._parquet_stage("test_features", lambda: encode.transform_ordinal(test, mapping))
        return train_e, test_e

    # S7, A7-A16
    def eda(self, cleaned: DataFrame, balanced: DataFrame) -> None:
        for name, fn in EDA_TABLES.items():
            self._json(f"eda/{name}", lambda fn=fn: fn(cleaned))
        self._json("eda/correlation_matrix", lambda: explore.correlation(balanced))

    # T2-T6, S9
    def predictions(self, train_e: DataFrame, test_e: DataFrame) -> DataFrame:
        def build():
            from functools import reduce
            parts = []
            for name, est in self.estimators.items():
                mp = self.path("models", name)
                self._built(mp, lambda: models.fit(train_e, est).write().overwrite().save(mp), True, "metadata/_SUCCESS")
                from pyspark.ml import PipelineModel
                parts.append(models.score(PipelineModel.load(mp), test_e).withColumn("model", F.lit(name)))
            return reduce(DataFrame.unionByName, parts)
        return self._parquet_stage("predictions", build, ["model"], True)

    def _json(self, name: str, build: Callable[[], DataFrame], of_models: bool = False) -> None:
        p = self.path(name)
        self._built(p, lambda: sinks.write_json(build(), p), of_models)

    # E7-E11: thresholds with the boundaries and the base rate they were tuned under
    def tier_config(self, preds: DataFrame) -> DataFrame:
        def build() -> DataFrame:
            bounds = tiers.tier_boundaries(self.spark.read.json(self.path("eda", "fraud_rate_by_bucket")))
            tune = tiers.with_tier(preds.where(F.col("model") == self.tuning_model), bounds)
            b = bounds.first()  # one row
            return tiers.tier_thresholds(tune).withColumns({c: F.lit(b[c]) for c in ("low_boundary", "high_boundary", "baseline_rate")})
        return self._parquet_stage("rba_tier_config", build, of_models=True)

    # E3, E8-E12 with thresholds tuned apart from the rows they judge
    def crossfit(self, preds: DataFrame, tier_table: DataFrame) -> DataFrame:
        def judged() -> DataFrame:
            tuned = crossfit.with_fold(tiers.with_tier(preds.where(F.col("model") == self.tuning_model), tiers.boundaries_of(tier_table)))
            table = self._parquet_stage("crossfit_thresholds", lambda: crossfit.tier_thresholds(tuned), of_models=True)
            return crossfit.apply_tiers(tuned, table)
        return self._parquet_stage("crossfit_metrics", lambda: ev.with_metrics(ev.confusion(judged(), F.col("y_pred_dynamic"))), of_models=True)

    # S9, E12: scores with the tier and its decision (null for models without tiers)
    def decisions(self, preds: DataFrame, tier_table: DataFrame) -> DataFrame:
        def build() -> DataFrame:
            tiered = tiers.apply_tiers(tiers.with_tier(preds, tiers.boundaries_of(tier_table)), tier_table)
            plain = F.col("model").isin(list(self.untiered))
            return tiered.withColumns({c: F.when(~plain, F.col(c)) for c in ("tier", "y_pred_dynamic")})
        return self._parquet_stage("predictions_with_tiers", build, ["model"], True)

    # E1-E14, S8, T7
    def evaluate(self, cleaned: DataFrame, preds: DataFrame) -> DataFrame:
        from functools import reduce

        from pyspark.ml import PipelineModel
        tier_table = self.tier_config(preds)
        bounds = tiers.boundaries_of(tier_table)
        decided = self.decisions(preds, tier_table)
        rows = []
        for name in self.estimators:
            p = preds.where(F.col("model") == name)
            with_rba = name not in self.untiered
            points = self._parquet_stage(f"curves/{name}", lambda p=p: ev.curve_points(p), of_models=True)
            areas = ev.curve_areas_from(points)
            rows.append(report.model_comparison(p, name, tier_table if with_rba else None,
                                                bounds if with_rba else None, areas=areas))
            self._json(f"threshold_evaluation/{name}", lambda p=p: ev.sweep(p), True)
            self._json(f"metrics_summary/{name}", lambda p=p, a=areas, r=with_rba, n=name: report.metrics_summary(
                p, a, decided.where(F.col("model") == n) if r else None), True)
            self._json(f"charts/pr_curve/{name}", lambda q=points: ev.pr_curve_from(q), True)
            self._json(f"charts/roc_curve/{name}", lambda q=points: ev.roc_curve_from(q), True)
            model = PipelineModel.load(self.path("models", name))
            if hasattr(model.stages[-1], "featureImportances"):
                self._json(f"feature_importance/{name}", lambda m=model: models.feature_importance(m, top=None), True)
        comparison = reduce(DataFrame.unionByName, rows)
        self.crossfit(preds, tier_table)
        cp = self.path("model_comparison")
        self._built(cp, lambda: sinks.write_csv(comparison, cp), True)
        return self.spark.read.option("header", True).option("inferSchema", True).csv(cp)

    # chart tables over the user's own data
    def charts(self, cleaned: DataFrame, test: DataFrame) -> None:
        for name, fn in CHARTS_ALL.items():
            self._json(f"charts/{name}", lambda fn=fn: fn(cleaned))
        for name, fn in CHARTS_TEST.items():
            self._json(f"charts/{name}", lambda fn=fn: fn(test))
        bounds = tiers.boundaries_of(self.spark.read.parquet(self.path("rba_tier_config")))
        self._json("charts/tier_segmentation", lambda: tiers.segmentation(cleaned, bounds))
        self._json("charts/bucket_tiers", lambda: tiers.bucket_tiers(self.spark.read.json(self.path("eda", "fraud_rate_by_bucket")), bounds))

    def run(self, raw_path: str) -> DataFrame:
        cleaned = self.cleaned(raw_path)
        balanced, test = self.features(cleaned)
        train_e, test_e = self.encoded(balanced, test)
        self.eda(cleaned, balanced)
        preds = self.predictions(train_e, test_e)
        comparison = self.evaluate(cleaned, preds)
        self.charts(cleaned, test)
        return comparison


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--raw", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--input-tb", type=float, default=0, help="size of the raw input: sets partition sizes for a cluster")
    args = ap.parse_args(argv)
    from ledgerlens.session import cluster_conf, ensure_checkpoint_dir
    builder = SparkSession.builder
    if args.input_tb:
        for k, v in cluster_conf(int(args.input_tb * (1 << 40))).items():
            builder = builder.config(k, v)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    Pipeline(spark, args.out).run(args.raw).show(truncate=False)


if __name__ == "__main__":
    main()
