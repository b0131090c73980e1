"""Join sides whose size is known before the join is planned."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from windrow.session import enable_checkpoints

MAX_BROADCAST_BYTES = 64 << 20
_ROW_OVERHEAD = 64  # hash table entry and row header


def fits_broadcast(table: DataFrame, limit: int | None = None) -> bool:
    """Count a table that is already stored: do its rows fit `limit` bytes of memory?"""
    row_bytes = _ROW_OVERHEAD + 8 * len(table.columns)
    text = [f.name for f in table.schema.fields if f.dataType.typeName() in ("string", "binary")]
    text_bytes = sum((F.coalesce(F.octet_length(name), F.lit(0)) for name in text), F.lit(0))
    found = table.agg(F.count(F.lit(1)).alias("rows"), F.sum(text_bytes).alias("text_bytes")).first()
    needed = found["rows"] * row_bytes + (found["text_bytes"] or 0)
    return needed <= (MAX_BROADCAST_BYTES if limit is None else limit)


def stored(table: DataFrame) -> DataFrame:
    """Compute a table once, into the shared folder, where it survives the loss of executors."""
    enable_checkpoints(table.sparkSession)
    return table.checkpoint()


def broadcast_if_small(side: DataFrame, limit: int | None = None) -> DataFrame:
    """Compute an aggregated table now and mark it for broadcast if it fits `limit` bytes.

    Spark estimates an aggregate to be as large as its input and so shuffles both sides of a join
    with it; adaptive execution finds out only when the large side has already been written.
    Counting first costs one job on the small table. A table over the limit is returned unmarked
    and is joined by shuffling, where adaptive execution splits skewed keys.
    """
    side = stored(side)
    return F.broadcast(side) if fits_broadcast(side, limit) else side
