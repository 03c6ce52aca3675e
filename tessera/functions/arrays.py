"""Array expressions for logits and token ids (higher-order built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _bound(value: Column, body) -> Column:
    """``body`` of a value worked out once: a name inside a lambda is not inlined, a column is."""
    return F.transform(F.array(value), body)[0]


def softmax(logits: Column) -> Column:
    """Exp-normalise along the array: ``exp(x - max) / sum(exp(x - max))``, linear in its length."""
    def shares(e: Column) -> Column:
        total = F.aggregate(e, F.lit(0.0), lambda acc, x: acc + x)
        return _bound(total, lambda t: F.transform(e, lambda x: x / t))

    return _bound(F.array_max(logits), lambda m: _bound(F.transform(logits, lambda x: F.exp(x - m)), shares))


def argmax(values: Column) -> Column:
    """0-based index of the largest element; the first one wins ties."""
    return _bound(values, lambda v: (F.array_position(v, F.array_max(v)) - 1).cast("int"))


def confidence(probs: Column) -> Column:
    """Probability of the predicted (largest) class."""
    return F.array_max(probs)


def pad_right(values: Column, length: int | Column, fill=0) -> Column:
    """Append ``fill`` up to ``length`` elements (arrays already that long are kept)."""
    n = length if isinstance(length, Column) else F.lit(length)
    missing = F.greatest(n - F.size(values), F.lit(0))
    return F.concat(values, F.array_repeat(F.lit(fill), missing.cast("int")))


def mask_for(values: Column, length: int | Column) -> Column:
    """1 for each real element, 0 for padding, ``length`` in all."""
    return pad_right(F.array_repeat(F.lit(1), F.size(values)), length, 0)
