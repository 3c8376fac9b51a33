"""Scalar column functions.

Each helper returns a ``Column`` built from ``pyspark.sql.functions`` so the
work stays inside Catalyst expressions (no Python UDF on the row path).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, NumericType, StringType

__all__ = [
    "bool_to_int", "target_to_int", "scale_pixels", "flatten_image", "reshape_square",
    "expand_array", "one_hot", "argmax", "threshold", "confidence_binary",
    "confidence_multiclass", "correct_flag", "round4", "fmt_fixed", "fmt_percent",
    "fmt_grouped", "upper_name", "softmax",
]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bool_to_int(c: Column | str) -> Column:
    """Boolean target to 0/1 (null stays null)."""
    return _col(c).cast("int")


def target_to_int(c: Column | str, dtype: DataType) -> Column:
    """Target by lookup.

    Booleans map to 0/1; the text values 'True'/'False' map to 1/0 and any
    other text to null (unlike ``cast('boolean')``, which accepts 'yes');
    numeric targets pass through as integers.
    """
    c = _col(c)
    if isinstance(dtype, BooleanType):
        return c.cast("int")
    if isinstance(dtype, StringType):
        return (F.when(c == "True", F.lit(1)).when(c == "False", F.lit(0))
                .otherwise(F.lit(None).cast("int")))
    if isinstance(dtype, NumericType):
        return c.cast("int")
    raise TypeError(f"unsupported target type {dtype.simpleString()}")


def scale_pixels(c: Column | str, scale: float = 255.0) -> Column:
    """Every element divided by ``scale`` (x / 255 for pixels)."""
    return F.transform(_col(c), lambda x: x.cast("double") / F.lit(scale))


def flatten_image(c: Column | str) -> Column:
    """array<array<T>> (rows of an image) to one flat array<T>."""
    return F.flatten(_col(c))


def reshape_square(c: Column | str, length: int) -> Column:
    """Array of n*n elements to n rows of n; null unless n*n == length."""
    n = math.isqrt(length)
    if n * n != length:
        return F.lit(None)
    a = _col(c)
    rows = F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: F.slice(a, i * n + 1, n))
    return F.when(F.size(a) == length, rows)


def expand_array(c: Column | str, length: int, prefix: str = "pixel_") -> list[Column]:
    """P10: one named column per array element, ``pixel_0`` ... ``pixel_{n-1}``."""
    a = _col(c)
    return [a[i].alias(f"{prefix}{i}") for i in range(length)]


def one_hot(label: Column | str, num_classes: int) -> Column:
    """Integer label to a one-hot array<double> of ``num_classes``."""
    lab = _col(label)
    return F.transform(F.sequence(F.lit(0), F.lit(num_classes - 1)),
                       lambda i: F.when(i == lab, F.lit(1.0)).otherwise(F.lit(0.0)))


def argmax(c: Column | str) -> Column:
    """0-based position of the largest element; the first one wins ties."""
    a = _col(c)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def threshold(p: Column | str, cut: float = 0.5) -> Column:
    """Strict threshold ``p > cut`` as 0/1."""
    return (_col(p) > F.lit(cut)).cast("int")


def confidence_binary(p: Column | str) -> Column:
    """Binary confidence ``|p - 0.5| + 0.5``."""
    return F.abs(_col(p) - F.lit(0.5)) + F.lit(0.5)


def confidence_multiclass(probs: Column | str) -> Column:
    """Multiclass confidence, the largest class probability."""
    return F.array_max(_col(probs))


def correct_flag(label: Column | str, prediction: Column | str) -> Column:
    """1 when the prediction equals the label, else 0."""
    return (_col(label) == _col(prediction)).cast("int")


def round4(c: Column | str) -> Column:
    """Round to 4 decimals (half away from zero)."""
    return F.round(_col(c), 4)


def fmt_fixed(c: Column | str, decimals: int) -> Column:
    """Fixed-point text ('%.4f', '%.3f'); rounded first so engines agree."""
    return F.format_string(f"%.{decimals}f", F.round(_col(c), decimals))


def fmt_percent(c: Column | str, decimals: int = 1) -> Column:
    """Percent text such as '12.3%' for a value already in percent."""
    return F.format_string(f"%.{decimals}f%%", F.round(_col(c), decimals))


def fmt_grouped(c: Column | str) -> Column:
    """Integer with ',' thousands grouping."""
    return F.format_number(_col(c).cast("long"), 0)


def upper_name(c: Column | str) -> Column:
    """Upper-case names (kernel names in reports)."""
    return F.upper(_col(c))


def softmax(c: Column | str) -> Column:
    """Class probabilities exp(x_i) / sum exp(x) of an array of scores."""
    ex = F.transform(_col(c), lambda x: F.exp(x.cast("double")))
    total = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return F.transform(ex, lambda x: x / total)
