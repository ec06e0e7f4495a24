from ledgerlens.functions.columns import (  # noqa: F401
    hash_u32, hash_percent, exact_sum, exact_mean, safe_ratio, label_text, f1_expr,
)
from ledgerlens.functions.joins import checked_broadcast  # noqa: F401
