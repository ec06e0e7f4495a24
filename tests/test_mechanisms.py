"""Co-moments, exact quotas, features without the row itself, account state, cross-fitted thresholds, manifests."""

import datetime as dt
import os
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.operators import comoments, crossfit, evaluate as ev, features as feat, models, split
from ledgerlens.operators.account_state import AccountState
from ledgerlens.sources import sinks

LAB = config.TARGET_COL


# ---------------------------------------------------------------- co-moments
def test_correlations_equal_numpy(spark):
    """Pairwise-complete, large means, a constant column, columns that never meet; any partitioning."""
    r = np.random.default_rng(1)
    n = 500
    x = r.normal(size=(n, 6)) + np.array([0, 1e8, -1e6, 0, 0, 0])
    x[:, 1] += x[:, 0]
    x[:, 3] = 7.0
    rows = [[None if r.random() < .2 else float(v) for v in row] for row in x]
    for i, row in enumerate(rows):
        row[4 if i % 2 else 5] = None
    cols = list("abcdef")
    df = spark.createDataFrame([tuple(v) for v in rows], ", ".join(f"{c} double" for c in cols))
    for parts in (1, 13):
        got = {(a, b): v for a, b, v in comoments.correlations(df.repartition(parts), cols)}
        for i, a in enumerate(cols):
            for j, b in enumerate(cols):
                both = np.array([(row[i], row[j]) for row in rows if row[i] is not None and row[j] is not None])
                if len(both) < 2 or "d" in (a, b):
                    assert got[a, b] is None
                else:
                    want = 1.0 if i == j else np.corrcoef(both.T)[0, 1]
                    assert got[a, b] == pytest.approx(want, abs=1e-7)
    assert all(v is None for _, _, v in comoments.correlations(df.limit(0), cols))


# ---------------------------------------------------------------- exact quotas
@pytest.mark.parametrize("parts", [1, 7])
def test_exact_quotas(spark, parts):
    rows = [(f"k{i}", 1 if i % 9 == 0 else 0 if i % 50 else None) for i in range(997)]
    df = spark.createDataFrame(rows, f"tx_key string, {LAB} int").repartition(parts)
    got = split.exact_split(df)
    counts = Counter((r["split"], r[LAB]) for r in got.collect())
    size = Counter(y for _, y in rows if y is not None)
    assert {y: counts["train", y] for y in (0, 1)} == {y: size[y] * 80 // 100 for y in (0, 1)}
    assert sum(counts.values()) == sum(size.values())
    # the rows themselves: the smallest hashes of each class
    hashed = {r[0]: r[1] for r in df.select("tx_key", split.hash_u32("tx_key")).collect()}
    want = {k for y in (0, 1) for k in sorted((k for k, v in rows if v == y), key=lambda k: (hashed[k], k))[:size[y] * 80 // 100]}
    assert {r["tx_key"] for r in got.where("split = 'train'").collect()} == want
    small = split.exact_downsample(df, ratio=2)
    assert Counter(r[LAB] for r in small.collect()) == {1: size[1], 0: 2 * size[1]}
    assert split.exact_downsample(df, ratio=100).count() == size[0] + size[1]
    assert split.exact_downsample(df.where(f"{LAB} = 0")).count() == 0
    assert split.exact_split(df.limit(0)).count() == 0


def test_quota_with_equal_hashes(spark, monkeypatch):
    """Rows with one hash are taken in the order of their keys."""
    monkeypatch.setattr(split, "hash_u32", lambda key, salt=None: F.length(F.col(key)).cast("bigint"))
    df = spark.createDataFrame([(f"{i:03d}" + "x" * (i % 3), 0) for i in range(100)], f"tx_key string, {LAB} int")
    got = {r["tx_key"] for r in split.exact_split(df, 50).where("split = 'train'").collect()}
    keys = sorted((r["tx_key"] for r in df.collect()), key=lambda k: (len(k), k))
    assert got == set(keys[:50])


def test_sample_by_label(spark):
    df = spark.createDataFrame([(f"k{i}", int(i < 20)) for i in range(4000)], f"tx_key string, {LAB} int").repartition(4)
    a, b = (sorted(r["tx_key"] for r in split.sample_by_label(df, 20, 7).collect()) for _ in range(2))
    assert a == b and {f"k{i}" for i in range(20)} <= set(a) and 300 < len(a) - 20 < 500


# ---------------------------------------------------------------- accounts
def transactions(spark, n=160, seed=3):
    r, day = random.Random(seed), dt.datetime(2022, 9, 1, 8)
    rows = []
    for i in range(n):
        amount = r.choice([None, 1.1, 2.25, 1000000.01, 0.1])
        rows.append((f"k{i}", None if r.random() < .04 else day + dt.timedelta(days=r.randint(0, 4), minutes=r.randint(0, 900)),
                     None if r.random() < .05 else r.choice("ABC"), None if r.random() < .05 else r.choice("XYZAB"),
                     amount, None if amount is None else amount * 2, r.choice(["train", "train", "test"])))
    return spark.createDataFrame(rows, "tx_key string, Timestamp timestamp, From_Account string, To_Account string, "
                                       "Amount_Paid double, Amount_Received double, split string").repartition(3)


def test_features_excluding_self(spark):
    """Each training row against features that are fitted on the other training rows."""
    tx = transactions(spark, 60)
    got = {r["tx_key"]: r for r in feat.build_features_excluding_self(tx).collect()}
    train = tx.where("split = 'train'")
    for key in sorted(got)[::4]:
        want = feat.build_features(tx.where(F.col("tx_key") == key), train.where(F.col("tx_key") != key)).first()
        for c in feat.FEATURE_COLUMNS:
            assert got[key][c] == pytest.approx(want[c], rel=1e-12), (key, c)


def test_account_state_equals_rebuild(spark, tmp_path):
    rows = transactions(spark)
    day = F.dayofmonth("Timestamp")
    state = AccountState(spark, str(tmp_path / "state"))
    batches = [rows.where(day <= 2), rows.where(day == 3), rows.where((day > 3) | day.isNull())]
    for i, b in enumerate(batches):
        state.merge(i, b)
    state.merge(2, batches[2])  # sent twice
    assert state.batches() == [0, 1, 2]
    for name, table in feat.lookup_tables(rows).items():
        got = state.lookup_tables()[name]
        assert sorted(map(str, got.select(table.columns).collect())) == sorted(map(str, table.collect())), name
    since = state.velocity("sender", "2022-09-03")
    full = state.velocity("sender").where("Date >= '2022-09-03'")
    assert sorted(map(str, since.collect())) == sorted(map(str, full.collect()))
    with pytest.raises(ValueError):
        state.merge(1, batches[1])


def test_interrupted_merge_does_not_count(spark, tmp_path):
    rows = transactions(spark, 40)
    state = AccountState(spark, str(tmp_path / "state"))
    state.merge(0, rows.limit(20))
    sinks.write_parquet(rows.limit(5), str(tmp_path / "state/profile/sender/batch=0000000001"))  # the receiver's is missing
    assert state.batches() == [0]


# ---------------------------------------------------------------- cross-fitted thresholds
def test_crossfit_thresholds(spark):
    r = random.Random(2)
    rows = [(f"k{i}", int(r.random() < .2), r.choice(["Low", "Medium", "High", None])) for i in range(800)]
    rows = [(k, y, round(min(1.0, max(0.0, .4 * y + .6 * r.random())), 3), t) for k, y, t in rows]
    pred = crossfit.with_fold(spark.createDataFrame(rows, "tx_key string, y_true int, y_prob double, tier string"))
    assert {x["fold"] for x in pred.select("fold").distinct().collect()} == set(range(crossfit.FOLDS))
    static = {x["fold"]: x["threshold"] for x in crossfit.static_thresholds(pred).collect()}
    table = crossfit.tier_thresholds(pred)
    from ledgerlens.operators import tiers
    for fold in range(crossfit.FOLDS):
        outside = pred.where(F.col("fold") != fold)
        assert static[fold] == ev.best_static_threshold(ev.sweep(outside)).first()["threshold"]
        want = sorted(map(str, tiers.tier_thresholds(outside).collect()))
        assert sorted(map(str, table.where(F.col("fold") == fold).drop("fold").collect())) == want
    limits = {(x["fold"], x["tier"]): x["threshold"] for x in table.collect()}
    for x in crossfit.apply_tiers(pred, table).collect():
        assert x["y_pred_dynamic"] == int(x["tier"] is not None and x["y_prob"] >= limits[x["fold"], x["tier"]])


# ---------------------------------------------------------------- manifests
def test_stages_know_their_input(spark, tmp_path):
    from ledgerlens.plans.pipeline import Pipeline
    from ledgerlens.sources import raw_csv
    from ledgerlens.sources.fixtures import transactions as table
    rows = table(spark, "/root/testdata/sf0.001")
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    raw_csv.write_raw_csv(rows.limit(400), raw)

    def pipe(depth):
        return Pipeline(spark, out, estimators={"gbt_a": models.boosted_a(rounds=1, max_depth=depth)}, tuning_model="gbt_a")

    def written(name):
        return os.path.getmtime(os.path.join(out, name, "_SUCCESS"))
    assert pipe(2).cleaned(raw).count() == 400
    first = written("cleaned")
    assert pipe(2).cleaned(raw).count() == 400 and written("cleaned") == first  # nothing changed
    raw_csv.write_raw_csv(rows.limit(500), raw)
    assert pipe(2).cleaned(raw).count() == 500  # the raw files changed
    digests = []
    for depth in (2, 2, 3):  # a setting of a model changes what depends on models, and no more
        p = pipe(depth)
        p.cleaned(raw)
        digests.append((p.digest(), p.digest(of_models=True)))
    assert digests[0] == digests[1] and digests[0][0] == digests[2][0] and digests[0][1] != digests[2][1]
    os.remove(os.path.join(out, "cleaned", sinks.MANIFEST))
    assert not sinks.stage_done(spark, out + "/cleaned", digests[0][0]) and sinks.stage_done(spark, out + "/cleaned")


# ---------------------------------------------------------------- clean-up
def test_clear_removes_stored_tables_alone(spark, tmp_path, monkeypatch):
    from ledgerlens.plans import datasets
    for held in ("_STAGES", "_SMALL", "_MODELS", "_KEPT"):
        monkeypatch.setattr(datasets, held, {})
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    try:
        folder = spark.sparkContext.getCheckpointDir().removeprefix("file:")
        other = tmp_path / "other-0123456789ab"  # beside the session's own folder
        other.mkdir()
        checkpointed = spark.range(3).checkpoint()

        def build():
            return datasets.stage(spark, "/root/testdata/sf0.001", "numbers", lambda: spark.range(5))
        assert build().count() == 5 and sum(n.startswith("stage-numbers-") for n in os.listdir(folder)) == 1
        assert datasets.clear(spark) == 1 and not any(n.startswith("stage-") for n in os.listdir(folder))
        assert other.exists() and checkpointed.count() == 3
        assert build().count() == 5 and datasets.clear(spark) == 1 and datasets.clear(spark) == 0
    finally:
        spark.sparkContext.setCheckpointDir(os.path.dirname(before))


# ---------------------------------------------------------------- what moves
def test_tables_are_written_without_an_exchange(spark, tmp_path):
    from pyspark.sql import functions as F
    rows = spark.range(1000, numPartitions=4).withColumn("part", F.spark_partition_id())
    written = spark.read.parquet(sinks.write_parquet(rows, str(tmp_path / "t"))).withColumn("file", F.input_file_name())
    per_file = written.groupBy("file").agg(F.countDistinct("part").alias("n")).collect()
    assert written.count() == 1000 and len(per_file) == 4 and all(r["n"] == 1 for r in per_file)


def test_correlation_moves_its_own_columns_alone(spark):
    from ledgerlens.plans import datasets
    rows = datasets.train_balanced(spark, "/root/testdata/sf0.001").select("Amount_Paid", "sender_tx_count_24h", "in_degree")
    scans = [x for x in rows._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation [" in x]
    exchanged = rows._jdf.queryExecution().executedPlan().toString()
    assert scans and "Payment_Format" not in exchanged and "Receiving_Currency" not in exchanged


def test_class_quartiles_are_broadcast(spark):
    from ledgerlens.plans import sql_views
    rows = [(i % 2, float(i), "2022-09-01", "a", "b", 1, "x") for i in range(40)]
    tx = spark.createDataFrame(rows, f"{LAB} int, Amount_Paid double, Timestamp string, From_Account string, To_Account string, Hour int, Payment_Format string")
    out = sql_views.run(spark, tx, "amount_stats")
    assert {r[LAB]: r["median_amount"] for r in out.collect()} == {0: 18.0, 1: 19.0}
    assert "ResolvedHint (strategy=broadcast)" in spark.table("class_quartiles")._jdf.queryExecution().analyzed().toString()


def test_feature_queries_keep_one_step_of_shuffles(spark):
    """What a feature query leaves to its last plan is the join of one side: the shuffles before it belong to stored steps."""
    from ledgerlens.plans import queries

    for name in ("feature_table", "feature_table_excluding_self"):
        plan = queries.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        initial = plan.split("Initial Plan")[-1]
        assert initial.count("Exchange hashpartitioning") <= 2, name


def test_feature_steps_can_be_stored(spark):
    """A hook gets each step once, and what it gives back is built on."""
    from ledgerlens.plans import datasets
    rows = datasets.tx_split(spark, "/root/testdata/sf0.001").limit(500)
    for build in (feat.build_features, feat.build_features_excluding_self):
        seen = []

        def cut(step, df):
            seen.append(step)
            return df.localCheckpoint()
        stored, plain = build(rows, cut=cut), build(rows)
        assert seen == (["linked_rows"] if build is feat.build_features_excluding_self else []) + ["sender_lookup", "sender_rows", "receiver_lookup"]
        assert stored.columns == plain.columns
        assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
