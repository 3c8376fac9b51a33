"""Column roles worked out from the schema alone (S3, P5); no data scan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DatetimeType, NumericType, StringType, StructType

# Target names tried in order by the generic loader; the image
# and churn apps use 'target' if present, else 'Churn'.
TARGET_CANDIDATES = ("churn", "Churn", "target", "Target", "class", "Class")
APP_TARGETS = ("target", "Churn")


@dataclass(frozen=True)
class TableSpec:
    """Roles of the columns of one table."""

    id: str | None
    target: str
    categorical: tuple[str, ...] = field(default_factory=tuple)
    numeric: tuple[str, ...] = field(default_factory=tuple)

    @property
    def features(self) -> tuple[str, ...]:
        return self.categorical + self.numeric


def resolve_target(names: list[str], candidates=TARGET_CANDIDATES) -> str:
    """S3: first candidate present, else the last column."""
    if not names:
        raise ValueError("table has no columns")
    for c in candidates:
        if c in names:
            return c
    return names[-1]


def app_target(names: list[str]) -> str:
    """S3 (app form): 'target' when present, else 'Churn'."""
    return "target" if "target" in names else "Churn"


def string_columns(schema: StructType, exclude=()) -> list[str]:
    """P5: every string column except the excluded ones (the target)."""
    return [f.name for f in schema.fields
            if isinstance(f.dataType, StringType) and f.name not in exclude]


def numeric_columns(schema: StructType, exclude=(), include_bool: bool = False) -> list[str]:
    """Numeric columns (booleans excluded, as in a pandas describe)."""
    out = []
    for f in schema.fields:
        if f.name in exclude:
            continue
        if isinstance(f.dataType, NumericType) or (include_bool and isinstance(f.dataType, BooleanType)):
            out.append(f.name)
    return out


def table_spec(df: DataFrame, id_col: str | None = "id", target: str | None = None,
               categorical: list[str] | None = None) -> TableSpec:
    """Build a TableSpec from ``df.schema``: target by S3, categoricals by P5.

    Every other column is a feature: text, dates and times as categories, numbers
    and booleans as numbers.  A column of another type is an error.
    """
    names = [n for n in df.columns if n != id_col]
    tgt = target or resolve_target(names)
    skip = {tgt} | ({id_col} if id_col else set())
    dated = [f.name for f in df.schema.fields if isinstance(f.dataType, DatetimeType) and f.name not in skip]
    text = set(string_columns(df.schema, skip)) | set(dated)
    cats = list(categorical) if categorical is not None else [n for n in names if n in text]
    nums = numeric_columns(df.schema, skip | set(cats), include_bool=True)
    if lost := [n for n in names if n not in skip | set(cats) | set(nums)]:
        raise ValueError(f"columns without a role: {lost}")
    return TableSpec(id_col, tgt, tuple(cats), tuple(nums))
