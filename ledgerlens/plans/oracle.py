"""Independent DuckDB SQL for each registered query.

Each statement rebuilds ``transactions`` from the input tables and computes
the result the plain way (for features: the eight-join lookup shape), so
it checks the Spark plans rather than mirroring them.
"""

from __future__ import annotations

from ledgerlens import config
from ledgerlens.operators.explore import BOX_PROBS
from ledgerlens.sources.fixtures import TRANSACTIONS_SQL

LAB = config.TARGET_COL
GRID = config.EVAL_THRESHOLDS
CLEAN_OUT = ("From_Bank, From_Account, To_Bank, To_Account, Amount_Received, Receiving_Currency, Amount_Paid, "
             "Payment_Currency, Payment_Format, Is_Laundering, Hour, Day_of_Week, Is_Currency_Conversion")
FEATS = ("sender_tx_count_24h, sender_amount_sum_24h, receiver_tx_count_24h, receiver_amount_sum_24h, "
         "sender_tx_count, sender_avg_amount, receiver_tx_count, receiver_avg_amount, out_degree, in_degree")
LABEL = "CASE WHEN Is_Laundering = 1 THEN 'Fraud' ELSE 'Normal' END AS label"
# Amounts are summed as compensated doubles (fsum), independent of the decimals in Spark, and taken
# to six decimals: the stated tolerance of these comparisons.

BASE = TRANSACTIONS_SQL + """,
tx_split AS (
  SELECT *, CASE WHEN CAST(concat('0x', substr(md5(tx_key), 1, 8)) AS BIGINT) % 100 < 80
                 THEN 'train' ELSE 'test' END AS split
  FROM transactions WHERE Is_Laundering IN (0, 1)
),
train AS (SELECT * FROM tx_split WHERE split = 'train'),
test AS (SELECT * FROM tx_split WHERE split = 'test'),
frac AS (
  SELECT CASE WHEN SUM(CASE WHEN Is_Laundering = 0 THEN 1 ELSE 0 END) = 0 THEN 1.0
              ELSE least(1.0, CAST(SUM(CASE WHEN Is_Laundering = 1 THEN 1 ELSE 0 END) AS DOUBLE) * 20
                              / CAST(SUM(CASE WHEN Is_Laundering = 0 THEN 1 ELSE 0 END) AS DOUBLE)) END AS fraction
  FROM train
),
balanced_rows AS (
  SELECT t.* FROM train t, frac
  WHERE t.Is_Laundering = 1 OR (t.Is_Laundering = 0 AND
        CAST(CAST(concat('0x', substr(md5(t.tx_key || '-ds'), 1, 8)) AS BIGINT) AS DOUBLE) < frac.fraction * 4294967296.0)
),
pred AS (SELECT tx_key, Is_Laundering AS y_true, score AS y_prob, Amount_Paid FROM test)"""

FEATURES = """,
daily_send AS (SELECT From_Account, CAST("Timestamp" AS DATE) AS d, COUNT("Timestamp") AS n,
                      round(fsum(Amount_Paid), 6) AS amt FROM train GROUP BY 1, 2),
daily_recv AS (SELECT To_Account, CAST("Timestamp" AS DATE) AS d, COUNT("Timestamp") AS n,
                      round(fsum(Amount_Received), 6) AS amt FROM train GROUP BY 1, 2),
sender_stats AS (SELECT From_Account, COUNT("Timestamp") AS sender_tx_count,
                        round(fsum(Amount_Paid), 6) / COUNT(Amount_Paid) AS sender_avg_amount
                 FROM train GROUP BY 1),
receiver_stats AS (SELECT To_Account, COUNT("Timestamp") AS receiver_tx_count,
                          round(fsum(Amount_Received), 6) / COUNT(Amount_Received) AS receiver_avg_amount
                   FROM train GROUP BY 1),
pairs AS (SELECT From_Account, To_Account, COUNT(*) AS c FROM train GROUP BY 1, 2),
out_deg AS (SELECT From_Account, COUNT(To_Account) AS out_degree FROM pairs GROUP BY 1),
in_deg AS (SELECT To_Account, COUNT(From_Account) AS in_degree FROM pairs GROUP BY 1),
feat AS (
  SELECT f.*,
    COALESCE(st.n, 0) + COALESCE(sy.n, 0) AS sender_tx_count_24h,
    round(COALESCE(st.amt, 0.0) + COALESCE(sy.amt, 0.0), 6) AS sender_amount_sum_24h,
    COALESCE(rt.n, 0) + COALESCE(ry.n, 0) AS receiver_tx_count_24h,
    round(COALESCE(rt.amt, 0.0) + COALESCE(ry.amt, 0.0), 6) AS receiver_amount_sum_24h,
    COALESCE(ss.sender_tx_count, 0) AS sender_tx_count,
    COALESCE(ss.sender_avg_amount, 0.0) AS sender_avg_amount,
    COALESCE(rs.receiver_tx_count, 0) AS receiver_tx_count,
    COALESCE(rs.receiver_avg_amount, 0.0) AS receiver_avg_amount,
    COALESCE(od.out_degree, 0) AS out_degree,
    COALESCE(idg.in_degree, 0) AS in_degree
  FROM tx_split f
  LEFT JOIN daily_send st ON f.From_Account = st.From_Account AND CAST(f."Timestamp" AS DATE) = st.d
  LEFT JOIN daily_send sy ON f.From_Account = sy.From_Account AND CAST(f."Timestamp" AS DATE) - INTERVAL 1 DAY = sy.d
  LEFT JOIN daily_recv rt ON f.To_Account = rt.To_Account AND CAST(f."Timestamp" AS DATE) = rt.d
  LEFT JOIN daily_recv ry ON f.To_Account = ry.To_Account AND CAST(f."Timestamp" AS DATE) - INTERVAL 1 DAY = ry.d
  LEFT JOIN sender_stats ss ON f.From_Account = ss.From_Account
  LEFT JOIN receiver_stats rs ON f.To_Account = rs.To_Account
  LEFT JOIN out_deg od ON f.From_Account = od.From_Account
  LEFT JOIN in_deg idg ON f.To_Account = idg.To_Account
),
balanced_feat AS (SELECT f.* FROM feat f JOIN (SELECT DISTINCT tx_key FROM balanced_rows) b USING (tx_key)
                  WHERE f.split = 'train')"""


def _w(body: str, features: bool = False) -> str:
    return "WITH " + BASE + (FEATURES if features else "") + "\n" + body


def _grid_values() -> str:
    return "(VALUES " + ", ".join(f"(CAST({t} AS DOUBLE))" for t in GRID) + ") g(threshold)"


SWEEP_CTE = f""",
counts AS (
  SELECT g.threshold, COUNT(*) AS n, CAST(SUM(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(SUM(CASE WHEN y_true = 1 AND y_prob >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(SUM(CASE WHEN y_true = 0 AND y_prob >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp
  FROM pred, {_grid_values()} GROUP BY g.threshold
),
m1 AS (
  SELECT threshold, tp, fp, pos - tp AS fn, n - pos - fp AS tn, n,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision,
         CASE WHEN pos = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(pos AS DOUBLE) END AS recall,
         CASE WHEN n = 0 THEN 0.0 ELSE CAST(n - fp - (pos - tp) AS DOUBLE) / CAST(n AS DOUBLE) END AS accuracy
  FROM counts
),
sweep AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score
  FROM m1
),
best AS (
  SELECT COALESCE((SELECT threshold FROM sweep WHERE f1_score > 0 ORDER BY f1_score DESC, threshold ASC LIMIT 1), 0.5)
           AS threshold,
         COALESCE((SELECT max(f1_score) FROM sweep WHERE f1_score > 0), 0.0) AS f1_score
)"""

CURVE_CTE = """,
hist AS (SELECT y_prob, CAST(SUM(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
                CAST(SUM(CASE WHEN y_true = 0 THEN 1 ELSE 0 END) AS BIGINT) AS neg FROM pred WHERE y_prob IS NOT NULL GROUP BY y_prob),
tot AS (SELECT CAST(SUM(pos) AS BIGINT) AS P, CAST(SUM(neg) AS BIGINT) AS N FROM hist),
cum AS (SELECT y_prob, pos, neg, CAST(SUM(pos) OVER (ORDER BY y_prob DESC) AS BIGINT) AS tp,
               CAST(SUM(neg) OVER (ORDER BY y_prob DESC) AS BIGINT) AS fp
        FROM hist),
pts AS (
  SELECT y_prob AS threshold, tp, fp,
         CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS precision,
         CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) ELSE 1.0 END AS recall,
         CASE WHEN (tp - pos) + (fp - neg) > 0 THEN CAST(tp - pos AS DOUBLE) / CAST((tp - pos) + (fp - neg) AS DOUBLE)
              ELSE 1.0 END AS prev_precision,
         CASE WHEN P > 0 THEN CAST(tp - pos AS DOUBLE) / CAST(P AS DOUBLE)
              WHEN (tp - pos) + (fp - neg) > 0 THEN 1.0 ELSE 0.0 END AS prev_recall,
         CASE WHEN N > 0 THEN CAST(fp AS DOUBLE) / CAST(N AS DOUBLE) END AS fpr,
         CASE WHEN P > 0 THEN CAST(tp AS DOUBLE) / CAST(P AS DOUBLE) END AS tpr,
         CASE WHEN N > 0 THEN CAST(fp - neg AS DOUBLE) / CAST(N AS DOUBLE) END AS prev_fpr,
         CASE WHEN P > 0 THEN CAST(tp - pos AS DOUBLE) / CAST(P AS DOUBLE) END AS prev_tpr
  FROM cum, tot
),
areas AS (
  SELECT SUM((recall - prev_recall) * (precision + prev_precision) / 2) AS pr_auc,
         SUM((fpr - prev_fpr) * (tpr + prev_tpr) / 2) AS roc_auc FROM pts
)"""

# cut value at probability p: the row at 1-based rank ceil(p * n) (inverse CDF, integer arithmetic)
BUCKET_CTE = f""",
amt_ranked AS (SELECT Amount_Paid, ROW_NUMBER() OVER (ORDER BY Amount_Paid) AS rn, COUNT(*) OVER () AS n
               FROM transactions WHERE Amount_Paid IS NOT NULL AND NOT isnan(Amount_Paid)),
cut_rows AS (SELECT DISTINCT r.Amount_Paid AS c FROM amt_ranked r
             JOIN (SELECT * FROM range(1, {config.RBA_N_BUCKETS}) v(i)) g
               ON r.rn = (g.i * r.n + {config.RBA_N_BUCKETS - 1}) // {config.RBA_N_BUCKETS}),
bucketed AS (SELECT 1 + (SELECT COUNT(*) FROM cut_rows WHERE c <= t.Amount_Paid) AS bucket_id, Amount_Paid, Is_Laundering
             FROM transactions t WHERE Amount_Paid IS NOT NULL AND NOT isnan(Amount_Paid)),
buckets AS (
  SELECT CAST(bucket_id AS INTEGER) AS bucket_id, MIN(Amount_Paid) AS bucket_min, MAX(Amount_Paid) AS bucket_max,
         COUNT(*) AS total_tx, CAST(SUM(Is_Laundering) AS BIGINT) AS fraud_tx,
         round(CAST(SUM(Is_Laundering) AS DOUBLE) * 100.0 / CAST(COUNT(*) AS DOUBLE), 6) AS fraud_rate_pct
  FROM bucketed GROUP BY bucket_id
),
base AS (SELECT CASE WHEN COALESCE(SUM(total_tx), 0) = 0 THEN {config.BASELINE_FALLBACK_RATE}
                     ELSE CAST(SUM(fraud_tx) AS DOUBLE) / CAST(SUM(total_tx) AS DOUBLE) END AS b FROM buckets),
bnd0 AS (
  SELECT COALESCE(MAX(CASE WHEN (CAST(fraud_tx AS DOUBLE) / CAST(total_tx AS DOUBLE)) / greatest(b, {config.BASELINE_FLOOR})
                              < {config.RBA_LOW_MULTIPLIER} THEN bucket_max END), {config.DEFAULT_LOW_BOUNDARY}) AS lo,
         COALESCE(MIN(CASE WHEN (CAST(fraud_tx AS DOUBLE) / CAST(total_tx AS DOUBLE)) / greatest(b, {config.BASELINE_FLOOR})
                              >= {config.RBA_HIGH_MULTIPLIER} THEN bucket_min END), {config.DEFAULT_HIGH_BOUNDARY}) AS hi,
         ANY_VALUE(b) AS b
  FROM buckets, base
),
bounds AS (
  SELECT CASE WHEN lo >= hi OR lo <= 0 THEN {config.FALLBACK_LOW_BOUNDARY} ELSE lo END AS low_boundary,
         CASE WHEN lo >= hi OR lo <= 0 THEN {config.FALLBACK_HIGH_BOUNDARY} ELSE hi END AS high_boundary,
         b AS baseline_rate
  FROM bnd0
),
tiered AS (
  SELECT p.*, CASE WHEN Amount_Paid IS NULL OR isnan(Amount_Paid) THEN NULL
                   WHEN Amount_Paid < low_boundary THEN 'Low'
                   WHEN Amount_Paid < high_boundary THEN 'Medium' ELSE 'High' END AS tier
  FROM pred p, bounds
),
tcounts AS (
  SELECT tier, g.threshold, COUNT(*) AS n, CAST(SUM(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(SUM(CASE WHEN y_true = 1 AND y_prob >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(SUM(CASE WHEN y_true = 0 AND y_prob >= g.threshold THEN 1 ELSE 0 END) AS BIGINT) AS fp
  FROM tiered, {_grid_values()} WHERE tier IS NOT NULL GROUP BY tier, g.threshold
),
tm AS (
  SELECT *, CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision,
            CASE WHEN pos = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(pos AS DOUBLE) END AS recall
  FROM tcounts
),
tm2 AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
         CASE tier WHEN 'Low' THEN precision >= {config.RBA_LOW_MIN_PRECISION}
                   WHEN 'High' THEN precision >= {config.RBA_HIGH_MIN_PRECISION} ELSE TRUE END AS ok
  FROM tm
),
tpick AS (
  SELECT tier, threshold, n, pos, ROW_NUMBER() OVER (
           PARTITION BY tier
           ORDER BY CASE WHEN ok THEN 0 ELSE 1 END,
                    CASE WHEN ok THEN (CASE WHEN tier = 'High' THEN recall ELSE f1 END)
                         ELSE (CASE WHEN tier = 'Low' THEN precision ELSE f1 END) END DESC,
                    threshold ASC) AS rn
  FROM tm2
),
tier_table AS (
  SELECT nm.tier,
         CASE WHEN COALESCE(p.pos, 0) > 0 THEN p.threshold ELSE 0.5 END AS threshold,
         CAST(COALESCE(p.n, 0) AS BIGINT) AS sample_count, CAST(COALESCE(p.pos, 0) AS BIGINT) AS fraud_count
  FROM (VALUES ('Low'), ('Medium'), ('High')) nm(tier) LEFT JOIN (SELECT * FROM tpick WHERE rn = 1) p USING (tier)
),
applied AS (
  SELECT t.*, CASE WHEN tt.threshold IS NOT NULL AND y_prob >= tt.threshold THEN 1 ELSE 0 END AS y_pred_dynamic
  FROM tiered t LEFT JOIN tier_table tt USING (tier)
)"""


def _metrics_select(tp: str, fp: str, fn: str, tn: str) -> str:
    return f"""
  SELECT true_positives, false_positives, false_negatives, true_negatives, precision, recall, accuracy,
         CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1_score
  FROM (SELECT {tp} AS true_positives, {fp} AS false_positives, {fn} AS false_negatives, {tn} AS true_negatives,
          CASE WHEN {tp} + {fp} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / CAST({tp} + {fp} AS DOUBLE) END AS precision,
          CASE WHEN {tp} + {fn} = 0 THEN 0.0 ELSE CAST({tp} AS DOUBLE) / CAST({tp} + {fn} AS DOUBLE) END AS recall,
          CASE WHEN {tp} + {fp} + {fn} + {tn} = 0 THEN 0.0
               ELSE CAST({tp} + {tn} AS DOUBLE) / CAST({tp} + {fp} + {fn} + {tn} AS DOUBLE) END AS accuracy
        FROM c0)"""


def _confusion(pred_col: str) -> str:
    return f"""c0 AS (SELECT
    CAST(SUM(CASE WHEN y_true = 1 AND {pred_col} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp0,
    CAST(SUM(CASE WHEN y_true = 0 AND {pred_col} = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp0,
    CAST(SUM(CASE WHEN y_true = 1 AND {pred_col} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn0,
    CAST(SUM(CASE WHEN y_true = 0 AND {pred_col} = 0 THEN 1 ELSE 0 END) AS BIGINT) AS tn0"""


def _corr_sql() -> str:
    cols = config.CORRELATION_FEATURES
    sds = ", ".join(f"stddev_samp(CAST({c} AS DOUBLE)) AS sd_{i}" for i, c in enumerate(cols))
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                v = f"CASE WHEN (SELECT sd_{i} FROM sds) > 0 THEN 1.0 END"
            else:
                v = (f"CASE WHEN (SELECT sd_{i} FROM sds) > 0 AND (SELECT sd_{j} FROM sds) > 0 "
                     f"THEN round((SELECT corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) FROM balanced_feat), 9) END")
            parts.append(f"SELECT '{a}' AS feature_x, '{b}' AS feature_y, CAST({v} AS DOUBLE) AS corr")
    return _w(", sds AS (SELECT " + sds + " FROM balanced_feat)\n" + "\nUNION ALL\n".join(parts), features=True)


def _ordinal_map_cte() -> str:
    parts = [f"SELECT DISTINCT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM balanced_rows"
             for c in config.CATEGORICAL_COLS]
    return (", vals AS (" + " UNION ALL ".join(parts) + "),\n"
            "omap AS (SELECT col AS \"column\", value, "
            "CAST(DENSE_RANK() OVER (PARTITION BY col ORDER BY value ASC NULLS LAST) - 1 AS DOUBLE) AS code FROM vals)")


def _ordinal_encode() -> str:
    sel, joins = [], []
    for i, c in enumerate(config.CATEGORICAL_COLS):
        joins.append(f"LEFT JOIN (SELECT value, code FROM omap WHERE \"column\" = '{c}') m{i} "
                     f"ON CAST(r.{c} AS VARCHAR) IS NOT DISTINCT FROM m{i}.value")
        sel.append(f"COALESCE(m{i}.code, -1.0) AS {c}")
    body = ("SELECT r.tx_key, r.split, " + ", ".join(sel) + " FROM (SELECT * FROM balanced_rows UNION ALL "
            "SELECT * FROM test) r " + " ".join(joins))
    return "WITH " + BASE + _ordinal_map_cte() + "\n" + body


def _assembled() -> str:
    """The model inputs of the balanced training rows and the test rows, one column each."""
    sel, joins = [], []
    for i, c in enumerate(config.MODEL_FEATURES):
        if c in config.CATEGORICAL_COLS:
            joins.append(f"LEFT JOIN (SELECT value, code FROM omap WHERE \"column\" = '{c}') m{i} "
                         f"ON CAST(r.{c} AS VARCHAR) IS NOT DISTINCT FROM m{i}.value")
            sel.append(f"COALESCE(m{i}.code, -1.0) AS {c}")
        else:
            sel.append(f"CAST(r.{c} AS DOUBLE) AS {c}")
    return _w(_ordinal_map_cte() + f"\nSELECT r.tx_key, r.split, r.{LAB}, " + ", ".join(sel) + " FROM (SELECT * FROM balanced_feat "
              "UNION ALL SELECT * FROM feat WHERE split = 'test') r " + " ".join(joins), True)


def _scored(columns: str = "") -> str:
    """What SQL can know of a score table: the test rows with their labels, and probabilities within bounds."""
    return _w(f"SELECT tx_key, {LAB} AS y_true, true AS in_bounds{columns} FROM test")


def _box_sql() -> str:
    names = ["min_log", "q1_log", "median_log", "q3_log", "max_log"]
    qs = ", ".join(f"round(quantile_cont(log10(Amount_Paid + 1e-5), {p}), 9) AS {n}" for p, n in zip(BOX_PROBS, names))
    return _w(f"SELECT Is_Laundering, {LABEL}, {qs} FROM test "
              "WHERE Amount_Paid IS NOT NULL AND NOT isnan(Amount_Paid) GROUP BY Is_Laundering")


def _comparison_cte() -> str:
    return BUCKET_CTE + SWEEP_CTE + CURVE_CTE + """,
cmp0 AS (
  SELECT CAST(SUM(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
    CAST(SUM(CASE WHEN y_true = 1 AND y_prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS tp0,
    CAST(SUM(CASE WHEN y_true = 0 AND y_prob >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS fp0,
    CAST(SUM(CASE WHEN y_true = 1 AND y_prob >= (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS tp1,
    CAST(SUM(CASE WHEN y_true = 0 AND y_prob >= (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS fp1,
    CAST(SUM(CASE WHEN y_true = 1 AND y_pred_dynamic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp2,
    CAST(SUM(CASE WHEN y_true = 0 AND y_pred_dynamic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp2
  FROM applied
),
cmp1 AS (
  SELECT 'Default (0.50)' AS Threshold_Type, 0.5 AS Threshold_Value, tp0 AS tp, fp0 AS fp, pos FROM cmp0
  UNION ALL SELECT 'Tuned (Static)', (SELECT threshold FROM best), tp1, fp1, pos FROM cmp0
  UNION ALL SELECT 'RBA (Dynamic)', CAST(NULL AS DOUBLE), tp2, fp2, pos FROM cmp0
),
cmp2 AS (
  SELECT 'fixture_score' AS Model, Threshold_Type, CAST(Threshold_Value AS DOUBLE) AS Threshold_Value,
         round((SELECT pr_auc FROM areas), 10) AS PR_AUC, round((SELECT roc_auc FROM areas), 10) AS ROC_AUC,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS Precision,
         CASE WHEN pos = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / CAST(pos AS DOUBLE) END AS Recall,
         fp AS False_Positives, tp AS True_Positives
  FROM cmp1
),
comparison AS (
  SELECT *, CASE WHEN Precision + Recall > 0 THEN 2 * Precision * Recall / (Precision + Recall) ELSE 0.0 END AS F1_Score
  FROM cmp2
)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["class_distribution"] = _w(f"""
SELECT Is_Laundering, {LABEL}, COUNT(*) AS jumlah,
       round(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 4) AS persentase
FROM transactions GROUP BY Is_Laundering""")
    q["amount_stats"] = _w(f"""
SELECT Is_Laundering, {LABEL},
  round(fsum(Amount_Paid) / COUNT(Amount_Paid), 2) AS avg_amount,
  round(MIN(Amount_Paid), 2) AS min_amount, round(MAX(Amount_Paid), 2) AS max_amount,
  round(stddev_samp(Amount_Paid), 2) AS std_amount,
  round(MAX(CASE WHEN rn = (n + 3) // 4 THEN Amount_Paid END), 2) AS q1_amount,
  round(MAX(CASE WHEN rn = (n + 1) // 2 THEN Amount_Paid END), 2) AS median_amount,
  round(MAX(CASE WHEN rn = (3 * n + 3) // 4 THEN Amount_Paid END), 2) AS q3_amount
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY Is_Laundering ORDER BY Amount_Paid) AS rn,
             COUNT(Amount_Paid) OVER (PARTITION BY Is_Laundering) AS n FROM transactions) GROUP BY Is_Laundering""")
    q["payment_format_mix"] = _w(f"""
SELECT Is_Laundering, {LABEL}, Payment_Format, COUNT(*) AS jumlah,
  round(CAST(COUNT(*) AS DOUBLE) * 100.0 / CAST(SUM(COUNT(*)) OVER (PARTITION BY Is_Laundering) AS DOUBLE), 2)
    AS pct_dalam_kelas
FROM transactions GROUP BY Is_Laundering, Payment_Format""")
    daily = f"""
SELECT CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS tanggal, Is_Laundering, {LABEL}, COUNT(*) AS jumlah_transaksi,
  round(fsum(Amount_Paid), 2) AS total_amount
FROM transactions WHERE "Timestamp" IS NOT NULL {{extra}}
GROUP BY CAST("Timestamp" AS DATE), Is_Laundering"""
    q["daily_timeline"] = _w(daily.format(extra=""))
    q["fraud_daily"] = _w(daily.format(extra="AND Is_Laundering = 1"))
    q["top_senders"] = _w(f"""
SELECT From_Account, COUNT(*) AS tx_count_sent, round(fsum(Amount_Paid), 6) AS total_sent,
  COUNT(DISTINCT To_Account) AS unique_recipients, CAST(SUM(Is_Laundering) AS BIGINT) AS fraud_tx_count
FROM transactions GROUP BY From_Account ORDER BY tx_count_sent DESC, From_Account ASC LIMIT {config.TOP_SENDERS}""")
    hourly = f"""
SELECT Hour, Is_Laundering, {LABEL}, COUNT(*) AS jumlah_transaksi FROM transactions {{where}}
GROUP BY Hour, Is_Laundering"""
    q["hourly_distribution"] = _w(hourly.format(where=""))
    q["fraud_hourly"] = _w(hourly.format(where="WHERE Is_Laundering = 1"))
    q["fraud_peak_hour"] = _w("""
SELECT Hour AS peak_hour, n AS peak_count FROM (
  SELECT Hour, COUNT(*) AS n FROM transactions WHERE Is_Laundering = 1 AND Hour IS NOT NULL GROUP BY Hour)
ORDER BY n DESC, Hour ASC LIMIT 1""")
    q["amount_buckets"] = "WITH " + BASE + BUCKET_CTE + "\nSELECT * FROM buckets"
    q["format_share"] = _w(f"""
SELECT Is_Laundering, {LABEL}, Payment_Format,
  CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER (PARTITION BY Is_Laundering) AS DOUBLE) AS proportion
FROM test GROUP BY Is_Laundering, Payment_Format""")
    q["class_median"] = _w(f"""
SELECT Is_Laundering, {LABEL}, round(quantile_cont(Amount_Paid, 0.5), 6) AS median_amount
FROM test WHERE Amount_Paid IS NOT NULL AND NOT isnan(Amount_Paid) GROUP BY Is_Laundering""")
    q["amount_log_box"] = _box_sql()
    q["split_counts"] = _w("SELECT split, Is_Laundering, COUNT(*) AS n FROM tx_split GROUP BY split, Is_Laundering")
    q["downsample_counts"] = _w("SELECT Is_Laundering, COUNT(*) AS n FROM balanced_rows GROUP BY Is_Laundering")
    exact = """, ranked AS (
  SELECT tx_key, Is_Laundering, row_number() OVER (PARTITION BY Is_Laundering ORDER BY
           CAST(concat('0x', substr(md5(tx_key), 1, 8)) AS BIGINT), tx_key) AS r,
         COUNT(*) OVER (PARTITION BY Is_Laundering) AS n
  FROM tx_split),
exact AS (SELECT tx_key, Is_Laundering, CASE WHEN r <= n * 80 // 100 THEN 'train' ELSE 'test' END AS split FROM ranked)"""
    q["split_exact"] = "WITH " + BASE + exact + " SELECT tx_key, split FROM exact"
    q["split_exact_counts"] = "WITH " + BASE + exact + " SELECT split, Is_Laundering, COUNT(*) AS n FROM exact GROUP BY ALL"
    q["downsample_exact"] = _w("""
SELECT tx_key, Is_Laundering FROM (
  SELECT tx_key, Is_Laundering, row_number() OVER (PARTITION BY Is_Laundering ORDER BY
           CAST(concat('0x', substr(md5(tx_key || '-ds'), 1, 8)) AS BIGINT), tx_key) AS r,
         COUNT(*) FILTER (Is_Laundering = 1) OVER () AS pos FROM train)
WHERE Is_Laundering = 1 OR r <= 20 * pos""")
    q["velocity_sender"] = _w("SELECT tx_key, split, sender_tx_count_24h, sender_amount_sum_24h FROM feat", True)
    q["velocity_receiver"] = _w("SELECT tx_key, split, receiver_tx_count_24h, receiver_amount_sum_24h FROM feat", True)
    q["sender_profile"] = _w("""
SELECT From_Account, COUNT("Timestamp") AS sender_tx_count,
  round(fsum(Amount_Paid), 6) / COUNT(Amount_Paid) AS sender_avg_amount,
  COUNT(DISTINCT To_Account) AS out_degree
FROM train WHERE From_Account IS NOT NULL GROUP BY From_Account""")
    q["receiver_profile"] = _w("""
SELECT To_Account, COUNT("Timestamp") AS receiver_tx_count,
  round(fsum(Amount_Received), 6) / COUNT(Amount_Received) AS receiver_avg_amount,
  COUNT(DISTINCT From_Account) AS in_degree
FROM train WHERE To_Account IS NOT NULL GROUP BY To_Account""")
    q["feature_table"] = _w(f"""
SELECT tx_key, split, CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS tx_date, {CLEAN_OUT}, {FEATS} FROM feat""", True)
    q["feature_table_excluding_self"] = _w("""
, less AS (  -- how many training rows share the account, and both accounts
  SELECT f.*, CASE WHEN split = 'train' THEN 1 ELSE 0 END AS me, ss.sender_avg_amount AS s_avg, rs.receiver_avg_amount AS r_avg,
    COUNT(Amount_Paid) FILTER (split = 'train') OVER (PARTITION BY f.From_Account) AS sk,
    COUNT(Amount_Received) FILTER (split = 'train') OVER (PARTITION BY f.To_Account) AS rk,
    COUNT(*) FILTER (split = 'train') OVER (PARTITION BY f.From_Account, f.To_Account) AS together
  FROM feat f LEFT JOIN sender_stats ss ON f.From_Account = ss.From_Account LEFT JOIN receiver_stats rs ON f.To_Account = rs.To_Account)
SELECT tx_key, split, sender_tx_count_24h - me AS sender_tx_count_24h, round(sender_amount_sum_24h - me * Amount_Paid, 6) AS sender_amount_sum_24h,
  receiver_tx_count_24h - me AS receiver_tx_count_24h, round(receiver_amount_sum_24h - me * Amount_Received, 6) AS receiver_amount_sum_24h,
  sender_tx_count - me AS sender_tx_count,
  CASE WHEN me = 0 THEN sender_avg_amount WHEN sk > 1 THEN round(s_avg * sk - Amount_Paid, 6) / (sk - 1) ELSE 0.0 END AS sender_avg_amount,
  receiver_tx_count - me AS receiver_tx_count,
  CASE WHEN me = 0 THEN receiver_avg_amount WHEN rk > 1 THEN round(r_avg * rk - Amount_Received, 6) / (rk - 1) ELSE 0.0 END AS receiver_avg_amount,
  out_degree - CASE WHEN together = 1 THEN me ELSE 0 END AS out_degree, in_degree - CASE WHEN together = 1 THEN me ELSE 0 END AS in_degree
FROM less""", True)
    q["correlation"] = _corr_sql()
    q["class_weight"] = _w("""
SELECT negatives, positives, CASE WHEN positives > 0 THEN CAST(negatives AS DOUBLE) / CAST(positives AS DOUBLE) END
  AS scale_pos_weight
FROM (SELECT CAST(SUM(CASE WHEN Is_Laundering = 0 THEN 1 ELSE 0 END) AS BIGINT) AS negatives,
             CAST(SUM(CASE WHEN Is_Laundering = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives FROM balanced_rows)""")
    q["ordinal_map"] = "WITH " + BASE + _ordinal_map_cte() + "\nSELECT * FROM omap"
    q["ordinal_encode"] = _ordinal_encode()
    q["assemble_features"] = _assembled()
    for name in ("gbt_a_round_checks", "gbt_b_round_checks"):
        q[name] = "WITH " + BASE + f""",
sums AS (SELECT COUNT(*) AS n, SUM(CASE WHEN Is_Laundering = 1 THEN 1 ELSE 0 END) AS pos FROM balanced_rows)
SELECT CAST(r AS INTEGER) AS round, n AS n_train, true AS rows_in_leaves, true AS leaves_in_limit, true AS loss_falls,
       CASE WHEN r = 0 THEN round(2 * (n - pos) * ln(2), 4) END AS first_loss
FROM sums, range({config.GBT_A_ROUNDS + 1}) t(r)"""
    for name in ("rf_score_rows", "gbt_a_score_rows", "gbt_b_score_rows"):
        q[name] = _scored()
    q["confusion_default"] = "WITH " + BASE + ",\n" + _confusion("(CASE WHEN y_prob >= 0.5 THEN 1 ELSE 0 END)") + \
        " FROM pred)\nSELECT tp0 AS true_positives, fp0 AS false_positives, fn0 AS false_negatives, " \
        "tn0 AS true_negatives FROM c0"
    q["threshold_sweep"] = "WITH " + BASE + SWEEP_CTE + """
SELECT threshold, precision, recall, f1_score, accuracy, tp AS true_positives, fp AS false_positives FROM sweep"""
    q["best_static_threshold"] = "WITH " + BASE + SWEEP_CTE + "\nSELECT threshold, f1_score FROM best"
    q["confusion_tuned"] = "WITH " + BASE + SWEEP_CTE + """,
cc AS (SELECT (SELECT threshold FROM best) AS threshold,
  CAST(SUM(CASE WHEN y_true = 1 AND y_prob >= (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS true_positives,
  CAST(SUM(CASE WHEN y_true = 0 AND y_prob >= (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS false_positives,
  CAST(SUM(CASE WHEN y_true = 1 AND y_prob < (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS false_negatives,
  CAST(SUM(CASE WHEN y_true = 0 AND y_prob < (SELECT threshold FROM best) THEN 1 ELSE 0 END) AS BIGINT) AS true_negatives
  FROM pred)
SELECT *, true_positives + false_positives AS alerts FROM cc"""
    q["metrics_default"] = "WITH " + BASE + ",\n" + _confusion("(CASE WHEN y_prob >= 0.5 THEN 1 ELSE 0 END)") + \
        " FROM pred)" + _metrics_select("tp0", "fp0", "fn0", "tn0")
    q["metrics_tuned"] = "WITH " + BASE + SWEEP_CTE + ",\n" + _confusion(
        "(CASE WHEN y_prob >= (SELECT threshold FROM best) THEN 1 ELSE 0 END)") + " FROM pred),\nmm AS (" + \
        _metrics_select("tp0", "fp0", "fn0", "tn0") + ")\nSELECT (SELECT threshold FROM best) AS threshold, * FROM mm"
    q["pr_baseline"] = _w("""
SELECT n, positives, CASE WHEN n = 0 THEN 0.0 ELSE CAST(positives AS DOUBLE) / CAST(n AS DOUBLE) END AS baseline_precision
FROM (SELECT COUNT(*) AS n, CAST(SUM(CASE WHEN y_true = 1 THEN 1 ELSE 0 END) AS BIGINT) AS positives FROM pred)""")
    q["pr_curve"] = "WITH " + BASE + CURVE_CTE + """
SELECT threshold, precision, recall FROM pts UNION ALL SELECT CAST(NULL AS DOUBLE), 1.0, 0.0"""
    q["roc_curve"] = "WITH " + BASE + CURVE_CTE + """
SELECT threshold, fpr, tpr FROM pts UNION ALL SELECT CAST(NULL AS DOUBLE), 0.0, 0.0"""
    q["pr_auc"] = "WITH " + BASE + CURVE_CTE + "\nSELECT round(pr_auc, 10) AS pr_auc FROM areas"
    q["roc_auc"] = "WITH " + BASE + CURVE_CTE + "\nSELECT round(roc_auc, 10) AS roc_auc FROM areas"
    tiers_base = "WITH " + BASE + BUCKET_CTE
    q["rba_boundaries"] = tiers_base + "\nSELECT low_boundary, high_boundary, baseline_rate FROM bounds"
    q["bucket_tiers"] = tiers_base + f"""
SELECT CAST(greatest(1, COALESCE(MAX(CASE WHEN bucket_max <= low_boundary THEN bucket_id END), 1)) AS INTEGER)
         AS low_max_bucket,
       CAST(least({config.RBA_N_BUCKETS}, COALESCE(MIN(CASE WHEN bucket_min >= high_boundary THEN bucket_id END),
         {config.RBA_N_BUCKETS})) AS INTEGER) AS high_min_bucket
FROM buckets, bounds"""
    q["rba_tier_thresholds"] = tiers_base + "\nSELECT tier, threshold, sample_count, fraud_count FROM tier_table"
    q["rba_apply"] = tiers_base + "\nSELECT tx_key, tier, y_pred_dynamic FROM applied"
    q["rba_metrics"] = tiers_base + ",\n" + _confusion("y_pred_dynamic") + " FROM applied)" + \
        _metrics_select("tp0", "fp0", "fn0", "tn0")
    # each fold's thresholds from the rows of all other folds, counted anew for each fold
    fold = "CAST(CAST(concat('0x', substr(md5(tx_key || '-fold'), 1, 8)) AS BIGINT) % 5 AS INTEGER) AS fold"
    static = SWEEP_CTE.replace("SELECT g.threshold, COUNT(*)", "SELECT o.fold, g.threshold, COUNT(*)").replace(
        f"FROM pred, {_grid_values()} GROUP BY g.threshold",
        f"FROM (SELECT *, {fold} FROM pred) p JOIN (SELECT CAST(range AS INTEGER) AS fold FROM range(5)) o ON p.fold <> o.fold, {_grid_values()} GROUP BY ALL")
    static = static.replace("SELECT threshold, tp, fp, pos - tp AS fn", "SELECT fold, threshold, tp, fp, pos - tp AS fn")
    q["crossfit_static_thresholds"] = "WITH " + BASE + static[:static.index("best AS")].rstrip().rstrip(",") + """
SELECT fold, COALESCE(arg_max(threshold, (f1_score, -threshold)) FILTER (f1_score > 0), 0.5) AS threshold, max(f1_score) AS f1_score FROM sweep GROUP BY fold"""
    folded = tiers_base.replace("SELECT tier, g.threshold, COUNT(*)", "SELECT o.fold, tier, g.threshold, COUNT(*)").replace(
        f"FROM tiered, {_grid_values()} WHERE tier IS NOT NULL GROUP BY tier, g.threshold",
        f"FROM (SELECT *, {fold} FROM tiered) p JOIN (SELECT CAST(range AS INTEGER) AS fold FROM range(5)) o ON p.fold <> o.fold, {_grid_values()} "
        "WHERE tier IS NOT NULL GROUP BY ALL").replace("SELECT tier, threshold, n, pos, ROW_NUMBER", "SELECT fold, tier, threshold, n, pos, ROW_NUMBER").replace(
        "PARTITION BY tier\n", "PARTITION BY fold, tier\n").replace("SELECT nm.tier,\n", "SELECT nm.fold, nm.tier,\n").replace(
        "FROM (VALUES ('Low'), ('Medium'), ('High')) nm(tier) LEFT JOIN (SELECT * FROM tpick WHERE rn = 1) p USING (tier)",
        "FROM (SELECT CAST(f AS INTEGER) AS fold, t AS tier FROM range(5) a(f), (VALUES ('Low'), ('Medium'), ('High')) b(t)) nm "
        "LEFT JOIN (SELECT * FROM tpick WHERE rn = 1) p USING (fold, tier)").replace(
        "FROM tiered t LEFT JOIN tier_table tt USING (tier)", f"FROM (SELECT *, {fold} FROM tiered) t LEFT JOIN tier_table tt USING (fold, tier)")
    q["crossfit_tier_thresholds"] = folded + "\nSELECT fold, tier, threshold, sample_count, fraud_count FROM tier_table"
    q["crossfit_apply"] = folded + "\nSELECT tx_key, fold, tier, y_pred_dynamic FROM applied"
    q["crossfit_metrics"] = folded + ",\n" + _confusion("y_pred_dynamic") + " FROM applied)" + _metrics_select("tp0", "fp0", "fn0", "tn0")
    for name in ("sender", "receiver"):
        q[f"state_{name}_profile"], q[f"state_velocity_{name}"] = q[f"{name}_profile"], q[f"velocity_{name}"]
    q["tier_segmentation"] = tiers_base + """
SELECT tier, Is_Laundering, COUNT(*) AS jumlah FROM (
  SELECT Is_Laundering, CASE WHEN Amount_Paid IS NULL OR isnan(Amount_Paid) THEN NULL
                             WHEN Amount_Paid < low_boundary THEN 'Low'
                             WHEN Amount_Paid < high_boundary THEN 'Medium' ELSE 'High' END AS tier
  FROM transactions, bounds) WHERE tier IS NOT NULL GROUP BY tier, Is_Laundering"""
    q["model_comparison"] = "WITH " + BASE + _comparison_cte() + """
SELECT Model, Threshold_Type, Threshold_Value, PR_AUC, ROC_AUC, Precision, Recall, F1_Score, False_Positives,
       True_Positives FROM comparison"""
    q["model_comparison_long"] = "WITH " + BASE + _comparison_cte() + """
SELECT Model, Threshold_Type, Metric, Value FROM (
  SELECT Model, Threshold_Type, 'PR_AUC' AS Metric, PR_AUC AS Value FROM comparison
  UNION ALL SELECT Model, Threshold_Type, 'Precision', Precision FROM comparison
  UNION ALL SELECT Model, Threshold_Type, 'Recall', Recall FROM comparison
  UNION ALL SELECT Model, Threshold_Type, 'F1_Score', F1_Score FROM comparison)
WHERE Threshold_Type IN ('Tuned (Static)', 'RBA (Dynamic)')"""
    q["ingest_clean"] = _w(f"""
SELECT CAST(CAST("Timestamp" AS DATE) AS VARCHAR) AS tx_date, strftime("Timestamp", '%H:%M') AS tx_time, {CLEAN_OUT}
FROM transactions""")
    for name, of in (("sink_parquet", "feature_table"), ("sink_predictions", "rba_apply"), ("sink_json", "daily_timeline"),
                     ("sink_csv", "model_comparison"), ("sink_encoder", "ordinal_map")):
        q[name] = q[of]      # written and read back, nothing changes
    for name in ("class_distribution", "amount_stats", "payment_format_mix", "daily_timeline", "top_senders",
                 "hourly_distribution"):
        q["sql_" + name] = q[name]      # the Spark SQL form answers the same question
    return q
