"""End-to-end staged job on the smallest tables, rendered as raw CSV; small model settings."""

import os

from pyspark.sql import functions as F

from ledgerlens.operators import models
from ledgerlens.plans.pipeline import Pipeline
from ledgerlens.sources import raw_csv
from ledgerlens.sources.fixtures import transactions

SF = "/root/testdata/sf0.001"


def test_pipeline_runs_and_resumes(spark, tmp_path):
    raw = raw_csv.write_raw_csv(transactions(spark, SF), str(tmp_path / "raw"))
    est = {"random_forest": models.random_forest(n_trees=5, max_depth=4),
           "gbt_a": models.boosted_a(rounds=3, max_depth=3)}
    pipe = Pipeline(spark, str(tmp_path / "out"), estimators=est, tuning_model="gbt_a")
    comp = pipe.run(raw).collect()
    assert {r["Model"] for r in comp} == {"random_forest", "gbt_a"}
    assert len(comp) == 2 + 3
    preds = spark.read.parquet(str(tmp_path / "out" / "predictions"))
    assert preds.where(F.col("y_prob").isNull()).count() == 0
    assert preds.select("model").distinct().count() == 2
    out = str(tmp_path / "out")
    decided = spark.read.parquet(out + "/predictions_with_tiers")
    assert decided.where("model = 'gbt_a' and y_pred_dynamic is null").count() == 0
    assert decided.where("model = 'random_forest' and y_pred_dynamic is not null").count() == 0
    config = spark.read.parquet(out + "/rba_tier_config")
    assert {"tier", "threshold", "low_boundary", "high_boundary", "baseline_rate"} <= set(config.columns) and config.count() == 3
    for name, kinds in (("gbt_a", 3), ("random_forest", 2)):
        summary = spark.read.json(f"{out}/metrics_summary/{name}")
        assert summary.count() == kinds and {"pr_auc", "roc_auc", "accuracy"} <= set(summary.columns)
        assert spark.read.json(f"{out}/feature_importance/{name}").count() == 20
        assert spark.read.json(f"{out}/charts/pr_curve/{name}").count() > 1
    for chart in ("fraud_daily", "fraud_hourly", "fraud_peak_hour", "format_share", "class_median", "amount_log_box",
                  "tier_segmentation", "bucket_tiers"):
        assert spark.read.json(f"{out}/charts/{chart}").count() > 0
    # second run reuses every stage output
    before = os.path.getmtime(str(tmp_path / "out" / "cleaned" / "_SUCCESS"))
    pipe.run(raw)
    assert os.path.getmtime(str(tmp_path / "out" / "cleaned" / "_SUCCESS")) == before


def test_stream_scores_new_files_with_batch_artifacts(spark, tmp_path):
    from ledgerlens.streaming import scoring
    raw = raw_csv.write_raw_csv(transactions(spark, SF), str(tmp_path / "raw"))
    est = {"gbt_a": models.boosted_a(rounds=2, max_depth=3)}
    out = str(tmp_path / "out")
    Pipeline(spark, out, estimators=est, tuning_model="gbt_a").run(raw)
    q = scoring.start(spark, raw, out, str(tmp_path / "alerts"), str(tmp_path / "ckpt"), model="gbt_a")
    q.awaitTermination(300)
    alerts = spark.read.parquet(str(tmp_path / "alerts"))
    assert alerts.count() == spark.read.parquet(out + "/cleaned").count()
    assert set(alerts.columns) >= {"tx_key", "y_prob", "tier", "y_pred_dynamic"}


def _folders(path):
    return sum(len(d) for _, d, _ in os.walk(path))


def test_stream_checks_every_header_and_leaves_nothing_behind(spark, tmp_path):
    from ledgerlens.session import ensure_checkpoint_dir
    from ledgerlens.sources.ingest import RawSchemaError
    from ledgerlens.streaming import scoring
    raw = raw_csv.write_raw_csv(transactions(spark, SF), str(tmp_path / "raw"))
    out = str(tmp_path / "out")
    Pipeline(spark, out, estimators={"gbt_a": models.boosted_a(rounds=2, max_depth=3)}, tuning_model="gbt_a").run(raw)
    files = sorted(f for f in os.listdir(raw) if f.endswith(".csv"))
    lines = open(os.path.join(raw, files[0])).read().splitlines()
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    for k in range(3):
        (incoming / f"part{k}.csv").write_text("\n".join([lines[0], *lines[1 + 50 * k:51 + 50 * k]]) + "\n")
    scratch = ensure_checkpoint_dir(spark).replace("file:", "")
    before = _folders(scratch)
    raw_stream = scoring.read_raw_stream
    try:
        scoring.read_raw_stream = lambda s, d: raw_stream(s, d, max_files_per_trigger=1)
        q = scoring.start(spark, str(incoming), out, str(tmp_path / "alerts"), str(tmp_path / "ckpt"), model="gbt_a")
        q.awaitTermination(300)
    finally:
        scoring.read_raw_stream = raw_stream
    alerts = spark.read.parquet(str(tmp_path / "alerts"))
    assert alerts.count() == 150 and alerts.select("batch_id").distinct().count() == 3
    assert _folders(scratch) == before
    swapped = lines[0].replace("Amount Received", "x").replace("Amount Paid", "Amount Received").replace("x,", "Amount Paid,")
    (incoming / "bad.csv").write_text("\n".join([swapped, lines[1]]) + "\n")
    q = scoring.start(spark, str(incoming), out, str(tmp_path / "alerts"), str(tmp_path / "ckpt"), model="gbt_a")
    try:
        q.awaitTermination(300)
        raise AssertionError("the swapped header was accepted")
    except Exception as e:  # the stream reports the batch's error
        assert "bad.csv" in str(e) and RawSchemaError.__name__ in str(e)
