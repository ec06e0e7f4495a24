"""Shared derived frames for the query registry and the pipeline.

The cleaned ``transactions`` table (a six-table join) is a stage output: on
first use in a session it is written as Parquet into the shared checkpoint
folder and every later plan scans that table (with column pruning and filter
pushdown) instead of re-running the joins.  A written table also survives
executor loss, unlike a cache.  The feature table is built over it in stored
steps (lookups, sender's side, receiver's side), each of which lets go of the
shuffles before it; a query that needs some of its rows and columns shuffles
only those.  Set
``ledgerlens.materialize=false`` to keep everything as one lazy plan.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens import config
from ledgerlens.operators import encode, split
from ledgerlens.operators.features import build_features
from ledgerlens.sources import sinks
from ledgerlens.sources.fixtures import transactions

LAB = config.TARGET_COL
# tables that the derived transactions come from
STATE_TABLES = ("lineitem", "orders", "customer", "supplier", "nation", "region")
_STAGES: dict[tuple, str] = {}


def input_state(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """(folder, digest of its tables' file names, sizes and times): a stage holds for this state only."""
    import hashlib

    conf, files = spark.sparkContext._jsc.hadoopConfiguration(), []
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf_dir)
    fs = root.getFileSystem(conf)
    for name in STATE_TABLES:
        table = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"{name}.parquet")
        if fs.exists(table):
            status = fs.getFileStatus(table)
            parts = fs.listStatus(table) if status.isDirectory() else [status]
            files += sorted((p.getPath().getName(), p.getLen(), p.getModificationTime()) for p in parts)
    return sf_dir.rstrip("/"), hashlib.sha256(repr(files).encode()).hexdigest()[:16]


def forget_stages() -> None:
    """Drop what this process remembers of stages and models, so they are built again."""
    for held in (_STAGES, _SMALL, _MODELS, _KEPT):
        held.clear()


def clear(spark: SparkSession) -> int:
    """Remove this session's stored tables from the shared folder; stages are built again when next asked for."""
    from ledgerlens.session import clear_scratch

    forget_stages()
    return clear_scratch(spark)


def _materialize_enabled(spark: SparkSession) -> bool:
    return str(spark.conf.get("ledgerlens.materialize", "true")).lower() != "false"


def stage(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Write ``build()`` once per session/input as a Parquet stage and scan it afterwards."""
    if not _materialize_enabled(spark):
        return build()
    from ledgerlens.session import release, scratch_dir
    key = (spark.sparkContext.applicationId, *input_state(spark, sf_dir), name)
    path = _STAGES.get(key)
    if path is None:
        path = scratch_dir(spark, f"stage-{name}")
        sinks.write_parquet(build(), path)
        _STAGES[key] = path
        release(spark.sparkContext)
    return spark.read.parquet(path)


def cut(spark: SparkSession, sf_dir: str, name: str) -> Callable[[str, DataFrame], DataFrame]:
    """Stores the steps of a feature build as stages of that name: the disk holds one step's shuffles at a time."""
    return lambda step, df: stage(spark, sf_dir, f"{name}_{step}", lambda: df)


_SMALL: dict[tuple, DataFrame] = {}


def small_table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A small derived table (bucket rates, tier boundaries, tier thresholds) computed once per
    session/input: reliable ``checkpoint()`` into the shared folder, reused by every later plan.

    These tables are a few rows, but each one costs one pass or more over a large input; recomputing them for every report would repeat that pass.
    """
    if not _materialize_enabled(spark):
        return build()
    from ledgerlens.session import ensure_checkpoint_dir
    key = (spark.sparkContext.applicationId, *input_state(spark, sf_dir), name)
    df = _SMALL.get(key)
    if df is None:
        ensure_checkpoint_dir(spark)
        df = build().checkpoint(eager=True)
        _SMALL[key] = df
    return df


_KEPT: dict[tuple, object] = {}


def kept(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], object]):
    """What ``build`` left in the shared folder, once per session and input."""
    key = (spark.sparkContext.applicationId, *input_state(spark, sf_dir), name)
    if key not in _KEPT:
        _KEPT[key] = build()
    return _KEPT[key]


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned transactions with their split assignment stored as a column: the md5 per row is
    computed once at staging, and ``split = 'train'`` reaches the Parquet scan as a pushed filter
    instead of a hash recomputed by every scan."""
    return stage(spark, sf_dir, "transactions", lambda: split.assign_split(transactions(spark, sf_dir)))


def tx_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.labelled(tx(spark, sf_dir))


def train_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx_split(spark, sf_dir).where(F.col("split") == "train")


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table of all rows; the lookups and the rows with the sender's features are stages."""
    rows = tx_split(spark, sf_dir)
    return build_features(rows.drop("score"), cut=cut(spark, sf_dir, "features"))


def features_of(spark: SparkSession, sf_dir: str, rows: DataFrame, name: str | None = None) -> DataFrame:
    """The features of some rows alone; the lookups are fitted on all training rows.  With ``name``, the steps are stages."""
    return build_features(rows, train_rows(spark, sf_dir), **({"cut": cut(spark, sf_dir, name)} if name else {}))


def balanced_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The balanced training rows (which rows they are needs no features)."""
    train = train_rows(spark, sf_dir)
    return split.downsample(train, fraction_source=train)


def train_balanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features_of(spark, sf_dir, balanced_rows(spark, sf_dir))


def encoder_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encoder fitted on the balanced train rows (row choice needs only key and label); a stage
    output, fitted once per session."""
    return small_table(spark, sf_dir, "encoder", lambda: encode.fit_ordinal(balanced_rows(spark, sf_dir)))


def test_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tx_split(spark, sf_dir).where(F.col("split") == "test")


def fixture_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the table's deterministic score (no model needed)."""
    return test_rows(spark, sf_dir).select("tx_key", F.col(LAB).alias("y_true"), F.col("score").alias("y_prob"),
                                           "Amount_Paid")


_MODELS: dict[tuple[str, str, str], object] = {}


def fitted_model(spark: SparkSession, sf_dir: str, name: str, fit: Callable[[], object]):
    """Fit once per session and input, and save; the fitted model itself is used from then on.

    Where ``ledgerlens.model.dir`` names a shared folder, models are saved there under the state of
    the input (file sizes and times) and a later session loads them instead of fitting again.
    """
    from pyspark.ml import PipelineModel

    from ledgerlens.session import scratch_dir
    key = (spark.sparkContext.applicationId, *input_state(spark, sf_dir), name)
    if key not in _MODELS:
        shared = spark.conf.get("ledgerlens.model.dir", None)
        path = f"{shared.rstrip('/')}/{name}-{input_state(spark, sf_dir)[1]}" if shared else scratch_dir(spark, f"model-{name}")
        if shared and sinks.stage_done(spark, f"{path}/metadata"):
            _MODELS[key] = PipelineModel.load(path)
        else:
            _MODELS[key] = fit()
            _MODELS[key].write().overwrite().save(path)
    return _MODELS[key]
