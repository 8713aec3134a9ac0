"""The check before a broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it is proven to hold at most this many rows and bytes.
BROADCAST_ROWS = 50_000
BROADCAST_BYTES = 32 * 1024 * 1024


def is_small(side: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Reads at most ``rows + 1`` rows to find out."""
    width = F.octet_length(F.to_json(F.struct("*")))
    count, size = side.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return count <= rows and size <= BROADCAST_BYTES
