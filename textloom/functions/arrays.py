"""Small array expressions shared by the operators."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times inside ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def term_bag(tokens: Column) -> Column:
    """Distinct tokens with their counts, as ``array<struct<term, tf>>`` in term order.

    Counting inside the row needs no shuffle: the tokens are sorted and the lengths of the
    runs of equal tokens are read off.
    """

    def runs(words: Column) -> Column:
        size = F.size(words)
        positions = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            positions, lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1))
        )
        return let(
            starts,
            lambda s: F.transform(
                s,
                lambda start, i: F.struct(
                    F.get(words, start).alias("term"),
                    (F.coalesce(F.get(s, i + 1), size) - start).cast("long").alias("tf"),
                ),
            ),
        )

    return let(F.sort_array(F.coalesce(tokens, F.array().cast("array<string>"))), runs)


def l2_normalized(values: Column) -> Column:
    """Scale an array to unit length; an empty or all-zero array stays as it is."""
    squared = F.aggregate(values, F.lit(0.0), lambda total, v: total + v * v)
    return let(
        F.sqrt(squared),
        lambda norm: F.transform(values, lambda v: F.when(norm > 0, v / norm).otherwise(v)),
    )


def argmax(values: Column) -> Column:
    """0-based position of the largest value; the first one wins on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("long")
