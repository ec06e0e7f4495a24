"""Fixed values.

These constants must equal the monitoring pipeline being re-expressed
(column names, class balance target, threshold grid, tier multipliers and
precision floors, model hyper-parameters).  They are plain data: change
them here and every operator follows.
"""

# --- fixed values: raw file layout ---------------------------------------
# Physical order of the raw transaction CSV (the header repeats "Account").
RAW_HEADER = [
    "Timestamp", "From Bank", "Account", "To Bank", "Account",
    "Amount Received", "Receiving Currency", "Amount Paid",
    "Payment Currency", "Payment Format", "Is Laundering",
]
# The repeated name as some readers write it.
ACCOUNT_SPELLINGS = ("Account", "Account.1", "Account_1")
# Clean name for each raw position (same order as RAW_HEADER).
CLEAN_NAMES = [
    "Timestamp", "From_Bank", "From_Account", "To_Bank", "To_Account",
    "Amount_Received", "Receiving_Currency", "Amount_Paid",
    "Payment_Currency", "Payment_Format", "Is_Laundering",
]
RAW_TIMESTAMP_FORMAT = "yyyy/MM/dd HH:mm"

# --- fixed values: modelling -------------------------------------------
TARGET_COL = "Is_Laundering"
CATEGORICAL_COLS = [
    "Payment_Format", "Receiving_Currency", "Payment_Currency", "From_Bank", "To_Bank",
]
# Model inputs in physical table order (the order the feature table is built in).
MODEL_FEATURES = [
    "From_Bank", "To_Bank", "Amount_Received", "Receiving_Currency", "Amount_Paid",
    "Payment_Currency", "Payment_Format", "Hour", "Day_of_Week", "Is_Currency_Conversion",
    "sender_tx_count_24h", "sender_amount_sum_24h", "receiver_tx_count_24h",
    "receiver_amount_sum_24h", "sender_tx_count", "sender_avg_amount",
    "receiver_tx_count", "receiver_avg_amount", "out_degree", "in_degree",
]
CORRELATION_FEATURES = [
    "sender_tx_count_24h", "sender_amount_sum_24h", "receiver_tx_count_24h",
    "receiver_amount_sum_24h", "sender_tx_count", "out_degree", "in_degree",
    "Amount_Paid", "Is_Laundering",
]

RANDOM_SEED = 42
TRAIN_PERCENT = 80            # hash bucket < 80 -> train
IMBALANCE_RATIO = 20          # 1 positive : 20 negatives after downsampling
RBA_N_BUCKETS = 20

# --- fixed values: evaluation ------------------------------------------
EVAL_THRESHOLDS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99]
DEFAULT_THRESHOLD = 0.50
RBA_LOW_MULTIPLIER = 0.5
RBA_HIGH_MULTIPLIER = 2.0
RBA_LOW_MIN_PRECISION = 0.35
RBA_HIGH_MIN_PRECISION = 0.10
BASELINE_FALLBACK_RATE = 0.005
BASELINE_FLOOR = 0.0001
DEFAULT_LOW_BOUNDARY = 5000.0
DEFAULT_HIGH_BOUNDARY = 50000.0
FALLBACK_LOW_BOUNDARY = 10000.0
FALLBACK_HIGH_BOUNDARY = 100000.0
TIERS = ["Low", "Medium", "High"]

# --- fixed values: models ----------------------------------------------
RF_N_ESTIMATORS = 300
RF_MAX_DEPTH = 15
RF_MIN_SAMPLES_LEAF = 20
GBT_A_ROUNDS = 300            # leaf-wise boosted trees in the source pipeline
GBT_A_MAX_DEPTH = 8
GBT_A_LEAVES = 31
GBT_A_LEARNING_RATE = 0.05
GBT_A_MIN_ROWS = 20           # its library's defaults for leaves
GBT_A_MIN_HESSIAN = 0.001
GBT_B_ROUNDS = 300            # depth-wise boosted trees in the source pipeline
GBT_B_MAX_DEPTH = 8
GBT_B_LEARNING_RATE = 0.05
GBT_B_SUBSAMPLE = 0.8
GBT_B_COLSAMPLE = 0.7
GBT_B_L2 = 1.0                # its library's defaults for leaves
GBT_B_MIN_HESSIAN = 1.0
TOP_FEATURES = 12
TOP_SENDERS = 15
