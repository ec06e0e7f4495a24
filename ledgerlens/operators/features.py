"""Account features, computed from training rows only and joined to every row.

* 24h velocity = calendar today + calendar yesterday, per account: daily
  counts/sums are exploded to (day, day + 1) and re-aggregated, so an account
  active yesterday but not today still matches today.
* Lifetime profile = count, mean amount and distinct counterparties.

Plan shape (per side): the distinct (account, day) keys of the fact table are
joined to the velocity table and the profile table, producing one narrow
lookup row per key; the fact table then meets that lookup in a single join.
The wide fact table is therefore shuffled once per side (twice in total)
instead of once per lookup (four or eight times).  All aggregations have a
map-side partial step, so an account holding a third of the rows collapses
to one row per task before any shuffle; the remaining per-key join skew on
the fact side is split by AQE's skew-join handling.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import exact_mean, money_parts, money_total

FEATURE_COLUMNS = [
    "sender_tx_count_24h", "sender_amount_sum_24h", "receiver_tx_count_24h",
    "receiver_amount_sum_24h", "sender_tx_count", "sender_avg_amount",
    "receiver_tx_count", "receiver_avg_amount", "out_degree", "in_degree",
]


@dataclass(frozen=True)
class Side:
    account: str          # key column in the fact table
    counterparty: str     # the other account column (for the degree)
    amount: str           # amount column summed for this side
    count_24h: str
    amount_24h: str
    count_all: str
    mean_all: str
    degree: str


SENDER = Side("From_Account", "To_Account", "Amount_Paid", "sender_tx_count_24h",
              "sender_amount_sum_24h", "sender_tx_count", "sender_avg_amount", "out_degree")
RECEIVER = Side("To_Account", "From_Account", "Amount_Received", "receiver_tx_count_24h",
                "receiver_amount_sum_24h", "receiver_tx_count", "receiver_avg_amount", "in_degree")


def with_date(df: DataFrame) -> DataFrame:
    return df.withColumn("Date", F.to_date("Timestamp"))


def daily_activity(train: DataFrame, side: Side) -> DataFrame:
    """(account, day) -> transaction count and exact amount sum (decimal part, double rest)."""
    dec, rest = money_parts(side.amount)
    return (with_date(train)
            .where(F.col(side.account).isNotNull() & F.col("Date").isNotNull())
            .groupBy(side.account, "Date")
            .agg(F.count("Timestamp").alias("n"), F.sum(dec).alias("amt"), F.sum(rest).alias("amt_rest")))


def velocity_24h(train: DataFrame, side: Side) -> DataFrame:
    """(account, day) -> activity on that day plus the day before."""
    daily = daily_activity(train, side)
    shifted = daily.select(side.account, F.explode(F.array("Date", F.date_add("Date", 1))).alias("Date"),
                           "n", "amt", "amt_rest")
    return (shifted.groupBy(side.account, "Date")
            .agg(F.sum("n").alias(side.count_24h),
                 money_total(F.sum("amt"), F.sum("amt_rest")).alias(side.amount_24h)))


def account_profile(train: DataFrame, side: Side) -> DataFrame:
    """account -> lifetime count, mean amount and number of distinct counterparties."""
    return (train.where(F.col(side.account).isNotNull())
            .groupBy(side.account)
            .agg(F.count("Timestamp").alias(side.count_all),
                 exact_mean(side.amount).alias(side.mean_all),
                 F.count_distinct(side.counterparty).alias(side.degree)))


def side_lookup(fact: DataFrame, train: DataFrame, side: Side) -> DataFrame:
    """One row per distinct (account, day) of ``fact`` with all features of the side."""
    return side_lookup_from(fact, velocity_24h(train, side), account_profile(train, side), side)


def _keys(fact: DataFrame, side: Side) -> DataFrame:
    return (with_date(fact).select(side.account, "Date")
            .where(F.col(side.account).isNotNull()).distinct())


def side_lookup_from(fact: DataFrame, vel: DataFrame, prof: DataFrame, side: Side,
                     max_keys: int | None = None) -> DataFrame:
    """``side_lookup`` over already-built velocity and profile tables (e.g. staged ones).

    With ``max_keys`` (a small fact frame such as a micro-batch), the fact's keys are counted
    and, when there are at most ``max_keys`` of them, broadcast into semi-joins that cut
    the large lookup tables down to the batch's accounts without shuffling them.
    """
    keys = _keys(fact, side)
    if max_keys is not None:
        # counted from the batch itself (cached by the caller): nothing is left in the checkpoint folder
        if keys.limit(max_keys + 1).count() <= max_keys:
            keys = F.broadcast(keys)
            vel = vel.join(keys, [side.account, "Date"], "left_semi")
            prof = prof.join(F.broadcast(keys.select(side.account).distinct()), side.account, "left_semi")
    return (keys.join(vel, [side.account, "Date"], "left")
                .join(prof, side.account, "left"))


def lookup_tables(train: DataFrame) -> dict[str, DataFrame]:
    """The four fitted lookup tables, by name (``sender_velocity``, ``sender_profile``, ...)."""
    out = {}
    for name, side in (("sender", SENDER), ("receiver", RECEIVER)):
        out[f"{name}_velocity"] = velocity_24h(train, side)
        out[f"{name}_profile"] = account_profile(train, side)
    return out


def _attach(fact: DataFrame, lookup: DataFrame, side: Side) -> DataFrame:
    lk = lookup.withColumnRenamed(side.account, "_lk_acct").withColumnRenamed("Date", "_lk_date")
    cond = (fact[side.account] == lk["_lk_acct"]) & fact["Date"].eqNullSafe(lk["_lk_date"])
    return fact.join(lk, cond, "left").drop("_lk_acct", "_lk_date")


#: Stores a step under a name, so that its shuffles can go before the next step's; a plan without stored steps keeps all of them until its end.
Cut = Callable[[str, DataFrame], DataFrame]


def _uncut(_: str, step: DataFrame) -> DataFrame:
    return step


def build_features(tx_split: DataFrame, train: DataFrame | None = None, cut: Cut = _uncut) -> DataFrame:
    """Add the ten account features to every row of ``tx_split``.

    ``train`` is the frame the lookups are fitted on (default: rows with
    split = 'train').  Missing lookups become 0.
    """
    if train is None:
        train = tx_split.where(F.col("split") == "train")
    return build_features_from(tx_split, lookup_tables(train), cut=cut)


def build_features_from(rows: DataFrame, tables: dict[str, DataFrame], max_keys: int | None = None, cut: Cut = _uncut) -> DataFrame:
    """Add the ten features to ``rows`` from fitted lookup tables (see :func:`lookup_tables`)."""
    fact = with_date(rows)
    for name, side in (("sender", SENDER), ("receiver", RECEIVER)):
        lk = cut(f"{name}_lookup", side_lookup_from(rows, tables[f"{name}_velocity"], tables[f"{name}_profile"], side, max_keys))
        fact = _attach(fact, lk, side)
        if side is SENDER:
            fact = cut("sender_rows", fact)
    fills = {c: 0 for c in FEATURE_COLUMNS}
    fills.update({c: 0.0 for c in ("sender_amount_sum_24h", "receiver_amount_sum_24h",
                                    "sender_avg_amount", "receiver_avg_amount")})
    return fact.fillna(fills).drop("Date")


# ---------------------------------------------------------------- without the row itself
def _own(side: Side, tag: str) -> dict[str, F.Column]:
    """A row's own part in its account's sums: 1 or 0, and its amount in both parts."""
    dec, rest = money_parts(side.amount)
    return {f"{tag}n": F.col("Timestamp").isNotNull().cast("long"), f"{tag}k": F.col(side.amount).isNotNull().cast("long"),
            f"{tag}amt": F.coalesce(dec, F.lit(0)), f"{tag}rest": F.coalesce(rest, F.lit(0.0))}


def _activity_parts(train: DataFrame, side: Side) -> DataFrame:
    """(account, day) -> count and exact sum of the day and the day before, as parts."""
    daily = daily_activity(train, side)
    shifted = daily.select(side.account, F.explode(F.array("Date", F.date_add("Date", 1))).alias("Date"), "n", "amt", "amt_rest")
    return shifted.groupBy(side.account, "Date").agg(F.sum("n").alias("_vn"), F.sum("amt").alias("_vamt"), F.sum("amt_rest").alias("_vrest"))


def _profile_parts(train: DataFrame, side: Side) -> DataFrame:
    """account -> lifetime count, exact sum and number of amounts, distinct counterparties."""
    dec, rest = money_parts(side.amount)
    return (train.where(F.col(side.account).isNotNull()).groupBy(side.account)
            .agg(F.count("Timestamp").alias("_pn"), F.count(side.amount).alias("_pk"), F.sum(dec).alias("_pamt"), F.sum(rest).alias("_prest"),
                 F.count_distinct(side.counterparty).alias("_deg")))


def build_features_excluding_self(tx_split: DataFrame, cut: Cut = _uncut) -> DataFrame:
    """The ten features as if a training row had not been among the rows they are fitted on.

    Sums are kept as exact decimals, so a training row's own part is subtracted without a rounding
    error.  A counterparty counts for the degree only where another training row links the two
    accounts.  Test rows have the same features as in :func:`build_features`.  An amount that makes
    a sum NaN leaves it NaN.
    """
    train = tx_split.where(F.col("split") == "train")
    mine = (F.col("split") == "train").cast("long")
    pairs = train.groupBy(SENDER.account, RECEIVER.account).agg(F.count(F.lit(1)).alias("_pair"))
    linked = [SENDER.account, RECEIVER.account]
    fact = with_date(tx_split).join(pairs, linked, "left").withColumn("_only", mine * F.coalesce((F.col("_pair") == 1).cast("long"), F.lit(0))).drop("_pair")
    fact = cut("linked_rows", fact)
    out = list(tx_split.columns)
    for name, side in (("sender", SENDER), ("receiver", RECEIVER)):
        fact = _attach(fact, cut(f"{name}_lookup", side_lookup_from(tx_split, _activity_parts(train, side), _profile_parts(train, side), side)), side)
        own = _own(side, "_o")
        dated = mine * F.col("Date").isNotNull().cast("long")
        known, active = F.col("_pn").isNotNull(), F.col("_vn").isNotNull()
        k = F.col("_pk") - mine * own["_ok"]
        total = money_total(F.col("_pamt") - mine * own["_oamt"], F.col("_prest") - mine * own["_orest"])
        fact = fact.withColumns({
            side.count_24h: F.when(active, F.col("_vn") - dated * own["_on"]).otherwise(0),
            side.amount_24h: F.coalesce(F.when(active, money_total(F.col("_vamt") - dated * own["_oamt"], F.col("_vrest") - dated * own["_orest"])), F.lit(0.0)),
            side.count_all: F.when(known, F.col("_pn") - mine * own["_on"]).otherwise(0),
            side.mean_all: F.coalesce(F.when(known & (k > 0), total / k), F.lit(0.0)),
            side.degree: F.when(known, F.col("_deg") - F.col("_only")).otherwise(0)}).drop("_vn", "_vamt", "_vrest", "_pn", "_pk", "_pamt", "_prest", "_deg")
        if side is SENDER:
            fact = cut("sender_rows", fact)
    return fact.select(*out, *FEATURE_COLUMNS)
