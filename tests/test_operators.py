"""Edge cases on hand-made rows, checked against brute force in Python."""

import datetime as dt
import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.operators import encode, evaluate as ev, explore, split, tiers
from ledgerlens.operators.features import build_features
from ledgerlens.operators.quantiles import bucketize, exact_percentiles
from ledgerlens.sources import ingest

TX_SCHEMA = ("tx_key string, Timestamp timestamp_ntz, From_Account string, To_Account string, "
             "Amount_Paid double, Amount_Received double, Is_Laundering int, split string")


def _ts(d, h=0):
    return dt.datetime(2022, 9, d, h, 0)


# ------------------------------------------------------------------ ingest
def test_ingest_nulls_bad_values_and_duplicate_header(spark, tmp_path):
    header = ",".join(config.RAW_HEADER)
    lines = [header,
             "2022/09/01 05:30,010,A1,020,B1,10.5,US Dollar,10.5,Euro,Wire,0",
             "not a date,010,A2,020,B2,abc,US Dollar,7,US Dollar,ACH,1",
             "2022/09/02 23:59,011,A3,021,B3,1,,2,Euro,ACH,x"]
    p = tmp_path / "raw.csv"
    p.write_text("\n".join(lines) + "\n")
    rows = {r["From_Account"]: r for r in ingest.ingest(spark, str(p)).collect()}
    assert rows["A1"]["Hour"] == 5 and rows["A1"]["Day_of_Week"] == 5          # Thursday, 1 = Sunday
    assert rows["A1"]["From_Bank"] == "010" and rows["A1"]["Is_Currency_Conversion"] == 1
    assert rows["A2"]["Timestamp"] is None and rows["A2"]["Hour"] is None      # malformed date -> null
    assert rows["A2"]["Amount_Received"] is None and rows["A2"]["Is_Currency_Conversion"] == 0
    assert rows["A3"]["Is_Laundering"] is None                                   # malformed label -> null
    assert rows["A3"]["Is_Currency_Conversion"] == 0                             # null currency -> 0


def test_ingest_rejects_missing_column(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("Timestamp,From Bank,Account\n2022/09/01 05:30,1,A\n")
    with pytest.raises(ingest.RawSchemaError):
        ingest.read_raw(spark, str(p))


# ------------------------------------------------------------------ features
def _brute_features(rows):
    train = [r for r in rows if r[7] == "train"]
    out = {}
    for r in rows:
        key, ts, fa, ta = r[0], r[1], r[2], r[3]
        d = ts.date() if ts else None

        def day_of(x):
            return x[1].date() if x[1] else None
        s24 = [x for x in train if x[2] == fa and fa is not None and d is not None and day_of(x) in (d, d - dt.timedelta(days=1))]
        r24 = [x for x in train if x[3] == ta and ta is not None and d is not None and day_of(x) in (d, d - dt.timedelta(days=1))]
        sp = [x for x in train if x[2] == fa and fa is not None]
        rp = [x for x in train if x[3] == ta and ta is not None]
        out[key] = dict(
            sender_tx_count_24h=sum(1 for x in s24 if x[1]), sender_amount_sum_24h=round(sum(x[4] for x in s24), 2),
            receiver_tx_count_24h=sum(1 for x in r24 if x[1]), receiver_amount_sum_24h=round(sum(x[5] for x in r24), 2),
            sender_tx_count=sum(1 for x in sp if x[1]),
            sender_avg_amount=round(sum(x[4] for x in sp) / len(sp), 6) if sp else 0.0,
            out_degree=len({x[3] for x in sp if x[3] is not None}),
            in_degree=len({x[2] for x in rp if x[2] is not None}))
    return out


def test_features_match_brute_force(spark):
    rows = [
        ("t1", _ts(1, 10), "A", "X", 100.0, 99.0, 0, "train"),
        ("t2", _ts(1, 11), "A", "Y", 50.0, 49.0, 1, "train"),
        ("t3", _ts(2, 9), "A", "X", 10.0, 9.0, 0, "test"),      # yesterday's activity only
        ("t4", _ts(3, 9), "A", "X", 10.0, 9.0, 0, "test"),      # nothing today or yesterday
        ("t5", _ts(2, 9), "B", "X", 5.0, 5.0, 0, "test"),       # account seen only in test
        ("t6", None, "A", "X", 7.0, 7.0, 0, "test"),            # null timestamp: no velocity, profile kept
        ("t7", _ts(2, 9), None, "X", 7.0, 7.0, 0, "train"),     # null sender
    ] + [(f"h{i}", _ts(5, i % 24), "H", "Z", 1.25, 1.0, 0, "train") for i in range(1000)]   # hot account
    df = spark.createDataFrame(rows, TX_SCHEMA)
    got = {r["tx_key"]: r.asDict() for r in build_features(df).collect()}
    want = _brute_features(rows)
    for k, w in want.items():
        for c, v in w.items():
            g = got[k][c]
            assert (round(g, 6) if isinstance(g, float) else g) == v, (k, c, g, v)
    assert got["t3"]["sender_tx_count_24h"] == 2 and got["t4"]["sender_tx_count_24h"] == 0
    assert got["t6"]["sender_tx_count"] == 2 and got["t6"]["sender_tx_count_24h"] == 0
    assert got["h0"]["sender_tx_count_24h"] == 1000


# ------------------------------------------------------------------ split / downsample
def test_split_is_disjoint_complete_and_partition_independent(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("tx_key"), (F.col("id") % 7 == 0).cast("int")
                                  .alias("Is_Laundering"))
    a = {r["tx_key"]: r["split"] for r in split.with_split(df).collect()}
    b = {r["tx_key"]: r["split"] for r in split.with_split(df.repartition(13)).collect()}
    assert a == b and len(a) == 5000
    share = sum(1 for v in a.values() if v == "train") / 5000
    assert 0.77 < share < 0.83


def test_downsample_keeps_positives_and_handles_no_negatives(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("tx_key"),
                                   (F.col("id") % 100 == 0).cast("int").alias("Is_Laundering"))
    out = split.downsample(df).groupBy("Is_Laundering").count().collect()
    c = {r[0]: r[1] for r in out}
    assert c[1] == 200 and 3400 < c[0] < 4600
    only_pos = df.where("Is_Laundering = 1")
    assert split.downsample(only_pos).count() == 200


# ------------------------------------------------------------------ quantiles
def test_exact_percentiles_match_numpy_both_paths(spark):
    rnd = random.Random(7)
    vals = [(i % 3, rnd.lognormvariate(3, 2)) for i in range(30000)] + [(3, 5.0)] * 50
    df = spark.createDataFrame(vals, "g int, v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    for acc in (1_000_000, 1000):          # whole-group band, then sketch band
        got = {(r["g"], r["p"]): r["value"] for r in exact_percentiles(df, "v", probs, ["g"], accuracy=acc).collect()}
        for g in range(4):
            arr = np.array([v for gg, v in vals if gg == g])
            for p in probs:
                assert got[(g, p)] == pytest.approx(np.percentile(arr, p * 100), rel=1e-12), (acc, g, p)


def test_bucketize_merges_equal_cuts_and_nulls(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (float("nan"),), (None,)], "a double")
    out = [r["b"] for r in bucketize(df, "a", [1.0, 1.0, 1.0], "b").orderBy("a").collect()]
    assert sorted(x for x in out if x is not None) == [1, 1, 1] and out.count(None) == 2
    tx = spark.createDataFrame([(5.0, 0)] * 10 + [(5.0, 1)], "Amount_Paid double, Is_Laundering int")
    b = tiers.amount_buckets(tx).collect()
    assert len(b) == 1 and b[0]["total_tx"] == 11


# ------------------------------------------------------------------ encoding
def test_ordinal_codes_sorted_null_last_unseen_minus_one(spark):
    train = spark.createDataFrame([("b",), ("a",), (None,), ("c",), ("a",)], "Payment_Format string")
    mapping = encode.fit_ordinal(train, ["Payment_Format"])
    codes = {r["value"]: r["code"] for r in mapping.collect()}
    assert codes == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0}
    test = spark.createDataFrame([("a",), ("z",), (None,)], "Payment_Format string")
    got = [r[0] for r in encode.transform_ordinal(test, mapping, ["Payment_Format"]).collect()]
    assert sorted(got) == [-1.0, 0.0, 3.0]


# ------------------------------------------------------------------ evaluation
def _pred(spark, ys, ps, amounts=None):
    amounts = amounts or [100.0] * len(ys)
    return spark.createDataFrame(list(zip(ys, ps, amounts)), "y_true int, y_prob double, Amount_Paid double")


def _brute_auc(ys, ps):
    pts_pr, pts_roc = [(0.0, 1.0)], [(0.0, 0.0)]
    P, N = sum(ys), len(ys) - sum(ys)
    for t in sorted(set(ps), reverse=True):
        tp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 1)
        fp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 0)
        pts_pr.append((tp / P, tp / (tp + fp)))
        pts_roc.append((fp / N, tp / P))

    def trap(pts):
        return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(pts, pts[1:]))
    return trap(pts_pr), trap(pts_roc)


def test_curves_and_areas_match_brute_force_with_ties(spark):
    rnd = random.Random(3)
    ys = [1 if rnd.random() < 0.2 else 0 for _ in range(3000)]
    ps = [round(min(1.0, max(0.0, 0.3 * y + rnd.random() * 0.7)), 2) for y in ys]   # many tied scores
    a = ev.curve_areas(_pred(spark, ys, ps)).first()
    pr, roc = _brute_auc(ys, ps)
    assert a["pr_auc"] == pytest.approx(pr, abs=1e-12) and a["roc_auc"] == pytest.approx(roc, abs=1e-12)


def test_sweep_matches_brute_force_and_best_threshold_rules(spark):
    ys = [1, 1, 0, 0, 1, 0, 0, 0]
    ps = [0.95, 0.6, 0.6, 0.2, 0.35, 0.1, 0.99, 0.5]
    rows = {r["threshold"]: r for r in ev.sweep(_pred(spark, ys, ps)).collect()}
    for t in config.EVAL_THRESHOLDS:
        tp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 1)
        fp = sum(1 for y, p in zip(ys, ps) if p >= t and y == 0)
        assert rows[t]["true_positives"] == tp and rows[t]["false_positives"] == fp
        assert rows[t]["true_positives"] + rows[t]["false_positives"] + rows[t]["false_negatives"] + \
            rows[t]["true_negatives"] == len(ys)
    best = max(config.EVAL_THRESHOLDS, key=lambda t: (rows[t]["f1_score"], -t))
    assert ev.best_static_threshold(ev.sweep(_pred(spark, ys, ps))).first()["threshold"] == best
    none = ev.best_static_threshold(ev.sweep(_pred(spark, [0, 0], [0.9, 0.1]))).first()
    assert none["threshold"] == 0.5 and none["f1_score"] == 0.0       # no positives -> default


def test_tier_thresholds_rules_and_defaults(spark):
    # Low tier: no threshold reaches precision 0.35 -> best precision; High: no fraud -> 0.5
    ys = [1, 0, 0, 0, 0, 1, 0, 0, 0, 0]
    ps = [0.3, 0.9, 0.8, 0.25, 0.2, 0.5, 0.4, 0.45, 0.1, 0.05]
    amounts = [10.0] * 5 + [1000.0] * 5
    pred = _pred(spark, ys, ps, amounts)
    bounds = spark.createDataFrame([(100.0, 100000.0, 0.2)], "low_boundary double, high_boundary double, baseline_rate double")
    tt = {r["tier"]: r for r in tiers.tier_thresholds(tiers.with_tier(pred, bounds)).collect()}
    assert tt["High"]["threshold"] == 0.5 and tt["High"]["sample_count"] == 0
    low = [(y, p) for y, p, a in zip(ys, ps, amounts) if a < 100]
    precs = {}
    for t in config.EVAL_THRESHOLDS:
        tp = sum(1 for y, p in low if p >= t and y == 1)
        fp = sum(1 for y, p in low if p >= t and y == 0)
        precs[t] = tp / (tp + fp) if tp + fp else 0.0
    if max(precs.values()) < 0.35:
        assert tt["Low"]["threshold"] == max(config.EVAL_THRESHOLDS, key=lambda t: (precs[t], -t))


def test_boundaries_fallbacks(spark):
    b = spark.createDataFrame([(1, 0.0, 10.0, 100, 0), (2, 10.0, 20.0, 100, 50)],
                              "bucket_id int, bucket_min double, bucket_max double, total_tx long, fraud_tx long")
    r = tiers.tier_boundaries(b).first()          # low = 10 (bucket 1), high = 10 (bucket 2): overlap -> fallback
    assert (r["low_boundary"], r["high_boundary"]) == (config.FALLBACK_LOW_BOUNDARY, config.FALLBACK_HIGH_BOUNDARY)
    empty = spark.createDataFrame([], "bucket_id int, bucket_min double, bucket_max double, total_tx long, fraud_tx long")
    r = tiers.tier_boundaries(empty).first()
    assert r["baseline_rate"] == config.BASELINE_FALLBACK_RATE
    assert (r["low_boundary"], r["high_boundary"]) == (config.DEFAULT_LOW_BOUNDARY, config.DEFAULT_HIGH_BOUNDARY)


def test_nan_amount_has_no_tier_and_no_alert(spark):
    pred = _pred(spark, [1, 1], [0.99, 0.99], [float("nan"), 50.0])
    bounds = spark.createDataFrame([(10.0, 100.0, 0.1)], "low_boundary double, high_boundary double, baseline_rate double")
    tp = tiers.with_tier(pred, bounds)
    tt = tiers.tier_thresholds(tp)
    out = {r["Amount_Paid"] if r["Amount_Paid"] == r["Amount_Paid"] else "nan": r
           for r in tiers.apply_tiers(tp, tt).collect()}
    assert out["nan"]["tier"] is None and out["nan"]["y_pred_dynamic"] == 0
    assert out[50.0]["tier"] == "Medium" and out[50.0]["y_pred_dynamic"] == 1


# ------------------------------------------------------------------ exploration
def test_correlation_constant_column_is_null(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + 1, 3.0) for i in range(50)], "a double, b double, c double")
    cells = {(r[0], r[1]): r[2] for r in explore.correlation(df, ["a", "b", "c"]).collect()}
    assert cells[("a", "b")] == pytest.approx(1.0) and cells[("a", "a")] == 1.0
    assert cells[("a", "c")] is None and cells[("c", "c")] is None


def test_class_weight_without_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "Is_Laundering int")
    r = explore.class_weight(df).first()
    assert r["positives"] == 0 and r["scale_pos_weight"] is None


def test_lookup_from_staged_tables_with_key_reduction_matches_plain(spark):
    """A small batch joined to fitted lookup tables (semi-join reduced) gets the same features."""
    from ledgerlens.operators.features import build_features_from, lookup_tables
    from ledgerlens.plans import datasets as ds
    s = ds.tx_split(spark, "/root/testdata/sf0.001")
    train = s.where(F.col("split") == "train")
    batch = s.where(F.col("split") == "test")
    tables = {k: v.checkpoint(eager=True) for k, v in lookup_tables(train).items()}
    plain = build_features(batch, train=train)
    reduced = build_features_from(batch, tables, max_keys=100_000)
    cols = sorted(plain.columns)
    assert sorted(reduced.columns) == cols
    assert plain.select(cols).exceptAll(reduced.select(cols)).count() == 0
    assert reduced.select(cols).exceptAll(plain.select(cols)).count() == 0


def test_exact_quantiles_disc_brute_force_with_hot_value_and_signs(spark):
    """Inverse-CDF quantiles (rank ceil(p*n)) against sorting; a third of the rows share one value."""
    import math

    from ledgerlens.operators.quantiles import exact_quantiles_disc
    rnd = random.Random(11)
    vals = [(1, rnd.uniform(-1e6, 1e6)) for _ in range(6000)] + [(1, 42.0)] * 3000 + [(1, 0.0)] * 10
    vals += [(2, rnd.lognormvariate(0, 4)) for _ in range(500)] + [(2, -0.0), (2, float("inf")), (2, -1e-300)]
    vals += [(None, 7.0), (None, 3.0), (3, 5.5)]
    df = spark.createDataFrame(vals, "g int, v double")
    probs = [0.0, 0.05, 0.25, 0.5, 0.55, 0.75, 0.95, 1.0]
    got = {(r["g"], r["p"]): r["value"] for r in exact_quantiles_disc(df, "v", probs, ["g"]).collect()}
    for g in (1, 2, None, 3):
        arr = sorted(v for gg, v in vals if gg == g)
        for p in probs:
            rank = max(1, math.ceil(p * len(arr) - 1e-9))
            assert got[(g, p)] == arr[rank - 1], (g, p)


def test_exact_quantiles_third_pass_for_packed_values(spark):
    """Distinct values packed into one sub-bucket (spacing far below bucket width / 65536)."""
    import math

    from ledgerlens.operators.quantiles import exact_quantiles_disc
    vals = [1000.0 + i * 1e-9 for i in range(800)] + [1020.0] * 5 + [1000.0] * 7
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    probs = [0.1, 0.33, 0.5, 0.9, 0.999]
    got = {r["p"]: r["value"] for r in exact_quantiles_disc(df, "v", probs).collect()}
    arr = sorted(vals)
    for p in probs:
        assert got[p] == arr[max(1, math.ceil(p * len(arr) - 1e-9)) - 1], p
    pct = {r["p"]: r["value"] for r in exact_percentiles(df, "v", probs).collect()}
    for p in probs:
        assert pct[p] == pytest.approx(float(np.percentile(np.array(arr), p * 100)), rel=1e-15), p


def test_fact_join_is_never_a_broadcast_of_the_line_items(spark):
    """Line items x orders stays a sort-merge join (the static size estimate would broadcast the scan)."""
    from ledgerlens.sources.fixtures import transactions
    plan = transactions(spark, "/root/testdata/sf0.001")._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [l_orderkey" in plan
    assert "BroadcastHashJoin [l_orderkey" not in plan


def test_money_sums_lose_nothing(spark):
    from ledgerlens.functions.columns import exact_mean, exact_sum
    from ledgerlens.operators import features as ft
    nan = float("nan")
    rows = ([("cents", 0.004)] * 1000 + [("nan", 10.0), ("nan", 20.0), ("nan", nan), ("big", 1e19), ("big", 2.5), ("inf", float("inf")),
            ("tiny", 1e-11), ("tiny", 3e-11), ("none", None), ("neg", -0.005), ("neg", 0.001)])
    got = {r.k: (r.s, r.m) for r in spark.createDataFrame(rows, "k string, x double").groupBy("k").agg(
        exact_sum("x").alias("s"), exact_mean("x").alias("m")).collect()}
    assert got["cents"] == (4.0, 0.004)
    assert all(math.isnan(v) for v in got["nan"])
    assert got["big"] == (1e19 + 2.5, (1e19 + 2.5) / 2) and got["inf"][0] == float("inf")
    assert got["tiny"][0] == pytest.approx(4e-11) and got["none"] == (None, None) and got["neg"][0] == pytest.approx(-0.004)
    tx = spark.sql("select 'a' From_Account, 'b' To_Account, timestamp'2022-09-01 10:00:00' Timestamp, 0.004D Amount_Paid, "
                   "0.004D Amount_Received from range(1000)")
    assert ft.velocity_24h(tx, ft.SENDER).where("Date = date'2022-09-02'").first()["sender_amount_sum_24h"] == 4.0
    assert ft.account_profile(tx, ft.RECEIVER).first()["receiver_avg_amount"] == 0.004


def test_every_file_header_is_checked(spark, tmp_path):
    from ledgerlens import config
    from ledgerlens.sources import ingest
    head, row = list(config.RAW_HEADER), "2022/09/01 00:20,10,A,20,B,1.5,USD,2.5,EUR,Wire,0"
    (tmp_path / "a.csv").write_text(",".join(head) + "\n" + row + "\n")
    (tmp_path / "c.csv").write_text(",".join(head[:4] + ["Account.1"] + head[5:]) + "\n" + row + "\n")
    (tmp_path / "d.csv").write_text(",".join(head[:4] + ["Account_1"] + head[5:]) + "\n" + row + "\n")
    got = ingest.ingest(spark, str(tmp_path)).collect()
    assert len(got) == 3 and {(r.Amount_Received, r.Amount_Paid, r.To_Account) for r in got} == {(1.5, 2.5, "B")}
    swapped = list(head)
    swapped[5], swapped[7] = head[7], head[5]
    (tmp_path / "b.csv").write_text(",".join(swapped) + "\n" + row + "\n")
    with pytest.raises(ingest.RawSchemaError, match="b.csv"):
        ingest.ingest(spark, str(tmp_path))


def test_rows_without_a_score_never_alert(spark):
    from ledgerlens.operators import evaluate as ev
    pred = spark.createDataFrame([(1, 0.9), (0, 0.2), (1, float("nan")), (0, None)], "y_true int, y_prob double")
    sweep = {r.threshold: (r.true_positives, r.false_positives) for r in ev.sweep(pred).collect()}
    assert sweep[0.5] == (1, 0) and sweep[0.1] == (1, 1)
    assert ev.confusion(pred, ev.predict_at(0.5)).first()["true_positives"] == 1
    assert ev.pr_curve(pred).where("threshold is not null").count() == 2


def test_curves_with_one_score_a_row(spark, monkeypatch):
    from ledgerlens.operators import evaluate as ev
    monkeypatch.setattr(ev, "BLOCK_SCORES", 300)
    pred = spark.range(3000).selectExpr("cast(id % 7 = 0 as int) y_true", "(id * 7919 % 3001) / 3001D y_prob")
    rows = sorted(((r.y_prob, r.y_true) for r in pred.collect()), reverse=True)
    tp = fp = 0
    want = {}
    for p, y in rows:
        tp, fp = tp + y, fp + 1 - y
        want[p] = (tp, fp)
    assert {r.threshold: (r.tp, r.fp) for r in ev.curve_points(pred).collect()} == want


def test_training_needs_both_classes(spark):
    from ledgerlens.operators import models
    one = spark.createDataFrame([(0, 1.0)], "Is_Laundering int, x double")
    with pytest.raises(ValueError):
        models.fit(one, models.boosted_a(rounds=1))


def test_intermediate_data_needs_a_shared_folder():
    from types import SimpleNamespace

    from ledgerlens import session
    conf = SimpleNamespace(get=lambda k, d=None: d)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
