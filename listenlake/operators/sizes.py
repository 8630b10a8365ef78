"""How large a frame really is, to decide what may be broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType, VariantType

# what is measured to be larger is joined by shuffle instead of broadcast
BROADCAST_BYTES = 64 << 20


def measured_bytes(df: DataFrame) -> int:
    """Size of the rows as counted by one distributed pass, not as guessed by the planner.

    Text counts with its real length, nested values with the length of their JSON, and every other
    value with eight bytes.
    """
    nested = [f.name for f in df.schema if isinstance(f.dataType, (ArrayType, MapType, StructType, VariantType))]
    texts = [f.name for f in df.schema if f.dataType in (StringType(), BinaryType())]
    text_bytes = [F.sum(F.coalesce(F.octet_length(c), F.lit(0))) for c in texts]
    text_bytes += [F.sum(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))) for c in nested]
    rows, *lengths = df.agg(F.count(F.lit(1)), *text_bytes).first()
    return rows * 8 * len(df.columns) + sum(n or 0 for n in lengths)


def fits_broadcast(df: DataFrame, limit: int = BROADCAST_BYTES) -> bool:
    return measured_bytes(df) <= limit
