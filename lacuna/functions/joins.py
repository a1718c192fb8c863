"""Small results between passes, and joins that broadcast only what was measured."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.session import checkpoint_dir

BROADCAST_BYTES = 256 << 20


def settle(df: DataFrame) -> DataFrame:
    """Compute a small result once, into the shared checkpoint folder.

    Later passes read it instead of repeating the scan behind it, a lost executor
    cannot take it away, and its size is known afterwards.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def measured_join(big: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", row_bytes: int = 100,
                  limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join a large side to a settled or stored small side.

    The small side is counted.  Under ``limit`` it is broadcast and the large
    side is not shuffled; above it the join is left to Spark, which splits skewed
    partitions.
    """
    side = F.broadcast(small) if small.count() * row_bytes <= limit else small
    return big.join(side, list(on), how)
