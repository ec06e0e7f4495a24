"""Account lookups kept up to date: a new batch of rows is merged into what earlier batches left.

Three tables for each side, in a folder with one sub-folder a batch:

* ``daily``: (account, day) counts and exact sums of the batch alone.  Days are added up when a
  velocity is asked for, so late rows of an old day need no rewrite.
* ``edges``: the counterparties an account meets for the first time in the batch (an anti-join of the
  batch's own pairs with the earlier ones, which are only looked up).
* ``profile``: lifetime sums and degree after the batch: the last profile plus the batch's own sums.

A merge reads the batch, the known edges and the last profile, never the rows of earlier batches.  A
batch counts once its profile of both sides is written; merging it again replaces it, so a merge
that was interrupted or sent twice leaves no double counts.  Batches are merged in the order of their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.columns import money_parts, money_total
from ledgerlens.operators.features import RECEIVER, SENDER, Side, with_date
from ledgerlens.sources import sinks

SIDES = {"sender": SENDER, "receiver": RECEIVER}


def _sums(amount: str) -> list:
    dec, rest = money_parts(amount)
    return [F.count("Timestamp").alias("n"), F.count(amount).alias("k"), F.sum(dec).alias("amt"), F.sum(rest).alias("amt_rest")]


def _added(table: DataFrame, keys: list[str], more: tuple[str, ...] = ()) -> DataFrame:
    return table.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "k", "amt", "amt_rest", *more)])


class AccountState:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _path(self, table: str, side: str, batch: int) -> str:
        return f"{self.folder}/{table}/{side}/batch={batch:010d}"

    def batches(self) -> list[int]:
        """Ids of the merged batches, ascending."""
        names = sinks.folder_names(self.spark, f"{self.folder}/profile/{list(SIDES)[-1]}")
        ids = sorted(int(n.removeprefix("batch=")) for n in names if n.startswith("batch="))
        return [i for i in ids if all(sinks.stage_done(self.spark, self._path("profile", s, i)) for s in SIDES)]

    def _all(self, table: str, side: str, batches: list[int]) -> DataFrame | None:
        return self.spark.read.parquet(*[self._path(table, side, i) for i in batches]) if batches else None

    def merge(self, batch: int, rows: DataFrame) -> None:
        """Merge a batch of training rows; a batch behind the last one is an error."""
        done = self.batches()
        if any(i > batch for i in done):
            raise ValueError(f"batch {batch} comes before merged batch {done[-1]}")
        earlier = [i for i in done if i < batch]
        for name, side in SIDES.items():
            known = with_date(rows).where(F.col(side.account).isNotNull())
            sinks.write_parquet(known.groupBy(side.account, "Date").agg(*_sums(side.amount)), self._path("daily", name, batch))
            pairs = known.where(F.col(side.counterparty).isNotNull()).select(side.account, side.counterparty).distinct()
            met = self._all("edges", name, earlier)
            sinks.write_parquet(pairs if met is None else pairs.join(met, [side.account, side.counterparty], "left_anti"), self._path("edges", name, batch))
        for name, side in SIDES.items():
            own = self.spark.read.parquet(self._path("daily", name, batch)).drop("Date").withColumn("degree", F.lit(0).cast("long"))
            fresh = self.spark.read.parquet(self._path("edges", name, batch)).groupBy(side.account).agg(F.count(F.lit(1)).alias("degree"))
            parts = own.unionByName(fresh, allowMissingColumns=True)
            if earlier:
                parts = parts.unionByName(self.spark.read.parquet(self._path("profile", name, earlier[-1])))
            sinks.write_parquet(_added(parts, [side.account], ("degree",)), self._path("profile", name, batch))

    def profile(self, name: str) -> DataFrame:
        """account -> lifetime count, mean amount, degree: as ``features.account_profile`` over all merged rows."""
        side, table = SIDES[name], self.spark.read.parquet(self._path("profile", name, self.batches()[-1]))
        return table.select(side.account, F.col("n").alias(side.count_all), (money_total("amt", "amt_rest") / F.when(F.col("k") > 0, F.col("k"))).alias(side.mean_all),
                            F.coalesce("degree", F.lit(0)).alias(side.degree))

    def velocity(self, name: str, since: str | None = None) -> DataFrame:
        """(account, day) -> activity of the day and the day before, for days from ``since`` on: as ``features.velocity_24h``."""
        side, daily = SIDES[name], self._all("daily", name, self.batches()).where(F.col("Date").isNotNull())
        if since is not None:
            daily = daily.where(F.col("Date") >= F.date_sub(F.lit(since).cast("date"), 1))
        both = daily.withColumn("Date", F.explode(F.array("Date", F.date_add("Date", 1))))
        out = (_added(both, [side.account, "Date"])
               .select(side.account, "Date", F.col("n").alias(side.count_24h), money_total("amt", "amt_rest").alias(side.amount_24h)))
        return out if since is None else out.where(F.col("Date") >= F.lit(since).cast("date"))

    def lookup_tables(self) -> dict[str, DataFrame]:
        """The four tables of ``features.lookup_tables``, for ``features.build_features_from``."""
        return {f"{name}_{kind}": getattr(self, kind)(name) for name in SIDES for kind in ("velocity", "profile")}
