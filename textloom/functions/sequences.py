"""Fixed-length id sequences as column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reserved ids and the largest sequence length.
PAD_ID, UNKNOWN_ID, START_ID, END_ID = 0, 1, 2, 3
RESERVED_IDS = 4
MAX_SEQUENCE_LENGTH = 512


def clamp_length(max_len: int) -> int:
    return min(max_len, MAX_SEQUENCE_LENGTH)


def with_markers(ids: Column, max_len: int) -> Column:
    """Cut to ``max_len - 2`` ids and put the start and end marker around them."""
    kept = F.slice(ids, 1, clamp_length(max_len) - 2)
    return F.concat(F.array(F.lit(START_ID)), kept, F.array(F.lit(END_ID)))


def padded(ids: Column, max_len: int) -> Column:
    """Fill up on the right with the padding id to exactly ``max_len``."""
    missing = F.lit(clamp_length(max_len)) - F.size(ids)
    return F.concat(ids, F.array_repeat(F.lit(PAD_ID), missing))


def attention_mask(ids: Column) -> Column:
    """1 for every id above the padding id, else 0."""
    return F.transform(ids, lambda i: F.least(F.lit(1), i))


def segment_ids(max_len: int) -> Column:
    return F.array_repeat(F.lit(0), clamp_length(max_len))
