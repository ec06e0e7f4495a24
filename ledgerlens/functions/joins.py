"""Join helpers: broadcast only tables whose row count is checked.

A table joined against a large one on a low-cardinality key (per-class
statistics, a category mapping, 25 nations) must not go through a shuffle
join: the large side would be hashed into a handful of partitions.  The
planner cannot size derived tables ahead of time, so these helpers check
the size explicitly and broadcast only under a row bound; beyond the bound
the frame is left to a shuffle join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def checked_broadcast(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """Broadcast ``df`` when it has at most ``max_rows`` rows (reads at most max_rows + 1 rows).

    For cheap inputs (a scan of a small table); derived tables should use
    :func:`small_side`, which computes them once.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def small_side(df: DataFrame, max_rows: int = 100_000, with_flag: bool = False):
    """Compute a derived table once (reliable checkpoint in the shared folder), then size-check it.

    The checkpoint cuts the lineage so later plans do not recompute the
    table; the count then reads the checkpoint.  Broadcast within the bound,
    shuffle join beyond it.
    """
    from ledgerlens.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    done = df.checkpoint(eager=True)
    small = done.limit(max_rows + 1).count() <= max_rows
    out = F.broadcast(done) if small else done
    return (out, small) if with_flag else out


def bounded_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a table whose size is bounded by construction (e.g. one row per grid point)."""
    return F.broadcast(df)
