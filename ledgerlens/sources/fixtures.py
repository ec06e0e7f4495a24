"""The derived ``transactions`` table built from the star-schema inputs.

Each line item becomes one payment: the ordering customer pays the
supplier.  Labels and a deterministic score come from fixed arithmetic on
the line-item keys, so an independent SQL engine can rebuild the same table.

Join order is chosen for scale: orders is joined to its (smaller) customer
dimension before meeting line items, so the line-item-sized side is shuffled
twice (order key, supplier key) rather than three times.  Nation x region
is broadcast after a row-count check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.joins import checked_broadcast
from ledgerlens.sources.ingest import add_row_features
from ledgerlens.sources.tables import read_table

# fixed values: label rule (price band -> key modulus) and time base
LOW_PRICE, HIGH_PRICE = 25000.0, 79200.0
LOW_MOD, MID_MOD, HIGH_MOD = 800, 50, 16
HOURS_SPAN = 720
MAX_NATIONS = 10_000
BASE_TS = "2022-09-01 00:00:00"


def _nation_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation", ["n_nationkey", "n_regionkey"])
    region = read_table(spark, sf_dir, "region", ["r_regionkey", "r_name"])
    nr = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "r_name")
    # joined on a 25-value key: a shuffle join would hash the payer/payee rows into 25 partitions
    return checked_broadcast(nr, MAX_NATIONS)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned-form transactions plus ``tx_key`` and ``score``."""
    li = read_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_discount"])
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    cust = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    supp = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    nr = _nation_region(spark, sf_dir)

    payer = (orders.join(cust, orders.o_custkey == cust.c_custkey)
             .join(nr.withColumnRenamed("r_name", "c_region"), F.col("c_nationkey") == nr.n_nationkey)
             .select("o_orderkey", "o_custkey", "o_orderpriority", "c_nationkey", "c_region"))
    payee = (supp.join(nr.withColumnRenamed("r_name", "s_region"), F.col("s_nationkey") == nr.n_nationkey)
             .select("s_suppkey", "s_nationkey", "s_region"))
    # line items x orders is fact x fact: neither side has a size bound, so it is a sort-merge
    # join by declaration.  Without the hint the static planner sizes the joined payer side as
    # the product of its inputs and broadcasts the line-item scan itself at small scale.
    j = (li.join(payer.hint("merge"), li.l_orderkey == payer.o_orderkey)
         .join(payee, li.l_suppkey == payee.s_suppkey))

    k = (F.col("l_orderkey") * 7 + F.col("l_partkey") * 3
         + F.col("l_linenumber") * 13 + F.col("l_suppkey") * 5)
    price = F.col("l_extendedprice")
    label = F.when(
        ((price < LOW_PRICE) & (F.col("k") % LOW_MOD == 0))
        | ((price >= LOW_PRICE) & (price < HIGH_PRICE) & (F.col("k") % MID_MOD == 0))
        | ((price >= HIGH_PRICE) & (F.col("k") % HIGH_MOD == 0)), 1).otherwise(0)
    # score = round_half_up(0.45 * label + 0.55 * ((k*37) % 101) / 100, 2), in exact integers
    cents = F.expr("(4500 * Is_Laundering + 55 * ((k * 37) % 101) + 50) div 100")
    received = F.expr(
        "CAST(CAST(CAST(l_extendedprice AS decimal(12,2)) * (1 - CAST(l_discount AS decimal(4,2)))"
        " AS decimal(18,2)) AS double)")

    base = j.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("tx_key"),
        k.alias("k"), "l_extendedprice", "l_discount", "o_custkey", "o_orderpriority",
        "c_nationkey", "c_region", "l_suppkey", "s_nationkey", "s_region",
    ).select("*", label.cast("int").alias("Is_Laundering"))

    out = base.select(
        "tx_key",
        F.expr(f"timestamp_ntz'{BASE_TS}' + make_dt_interval(0, CAST(k % {HOURS_SPAN} AS int))").alias("Timestamp"),
        F.col("c_nationkey").cast("string").alias("From_Bank"),
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("From_Account"),
        F.col("s_nationkey").cast("string").alias("To_Bank"),
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("To_Account"),
        received.alias("Amount_Received"),
        F.col("s_region").alias("Receiving_Currency"),
        F.col("l_extendedprice").alias("Amount_Paid"),
        F.col("c_region").alias("Payment_Currency"),
        F.col("o_orderpriority").alias("Payment_Format"),
        "Is_Laundering",
        (cents.cast("double") / 100.0).alias("score"),
    )
    return add_row_features(out)


# DuckDB text of the same table, used by the oracle queries.
TRANSACTIONS_SQL = f"""
nr AS (
  SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
),
tx_base AS (
  SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_extendedprice, l.l_discount,
         o.o_custkey, o.o_orderpriority, c.c_nationkey, s.s_nationkey,
         cr.r_name AS c_region, sr.r_name AS s_region,
         l.l_orderkey * 7 + l.l_partkey * 3 + l.l_linenumber * 13 + l.l_suppkey * 5 AS k
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nr cr ON c.c_nationkey = cr.n_nationkey
  JOIN nr sr ON s.s_nationkey = sr.n_nationkey
),
tx_labeled AS (
  SELECT *,
    CASE WHEN (l_extendedprice < {LOW_PRICE} AND k % {LOW_MOD} = 0)
           OR (l_extendedprice >= {LOW_PRICE} AND l_extendedprice < {HIGH_PRICE} AND k % {MID_MOD} = 0)
           OR (l_extendedprice >= {HIGH_PRICE} AND k % {HIGH_MOD} = 0)
         THEN 1 ELSE 0 END AS lab
  FROM tx_base
),
transactions AS (
  SELECT
    concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
              CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS tx_key,
    TIMESTAMP '{BASE_TS}' + CAST(k % {HOURS_SPAN} AS INTEGER) * INTERVAL 1 HOUR AS "Timestamp",
    CAST(c_nationkey AS VARCHAR) AS From_Bank,
    'C' || CAST(o_custkey AS VARCHAR) AS From_Account,
    CAST(s_nationkey AS VARCHAR) AS To_Bank,
    'S' || CAST(l_suppkey AS VARCHAR) AS To_Account,
    CAST(CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
         AS DECIMAL(18,2)) AS DOUBLE) AS Amount_Received,
    s_region AS Receiving_Currency,
    l_extendedprice AS Amount_Paid,
    c_region AS Payment_Currency,
    o_orderpriority AS Payment_Format,
    CAST(lab AS INTEGER) AS Is_Laundering,
    CAST((4500 * lab + 55 * ((k * 37) % 101) + 50) // 100 AS DOUBLE) / 100.0 AS score,
    CAST(hour(TIMESTAMP '{BASE_TS}' + CAST(k % {HOURS_SPAN} AS INTEGER) * INTERVAL 1 HOUR) AS INTEGER) AS Hour,
    CAST(dayofweek(TIMESTAMP '{BASE_TS}' + CAST(k % {HOURS_SPAN} AS INTEGER) * INTERVAL 1 HOUR) + 1 AS INTEGER) AS Day_of_Week,
    CASE WHEN s_region <> c_region THEN 1 ELSE 0 END AS Is_Currency_Conversion
  FROM tx_labeled
)"""
