"""Value cleaning, group labels and the completeness score."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The widest span of whole seconds that fits a microsecond timestamp.
_MAX_EPOCH_SECONDS = (2**63 - 1) // 1_000_000

# Types whose text form can be empty or only spaces.
_TEXT_TYPES = (T.StringType, T.BinaryType)


def is_blank(value: Column) -> Column:
    """True for null, empty and all-space text; never null."""
    return value.isNull() | (F.trim(value) == "")


def as_type(type_name: str) -> Callable[[Column], Column]:
    """A cleaning step that casts, with NULL for what does not parse."""
    return lambda value: value.try_cast(type_name)


def from_epoch_seconds(seconds: Column) -> Column:
    """Timestamp of an epoch second count; NULL where no timestamp can hold it.

    It names an instant, so unlike a round trip through text it does not depend on the
    session time zone.  The guard keeps one absurd value (an epoch in microseconds, say)
    from failing the whole job.
    """
    return F.when(
        seconds.between(-_MAX_EPOCH_SECONDS, _MAX_EPOCH_SECONDS), F.timestamp_seconds(seconds)
    )


def label_or(value: Column, default: str) -> Column:
    """The value as it is, or ``default`` where it is blank."""
    return F.when(is_blank(value), F.lit(default)).otherwise(value)


def lowered_label(value: Column, default: str) -> Column:
    """The value in lower case, or ``default`` where it is blank."""
    return F.when(is_blank(value), F.lit(default)).otherwise(F.lower(value))


def canonical_label(value: Column, default: str) -> Column:
    """Trimmed, each space-separated word capitalized; ``default`` where it is blank."""
    return F.when(is_blank(value), F.lit(default)).otherwise(F.initcap(F.trim(value)))


def _is_populated(name: str, schema: T.StructType) -> Column:
    value = F.col(name)
    if isinstance(schema[name].dataType, _TEXT_TYPES):
        return ~is_blank(value.cast("string"))
    # A number, date or container never prints as blank, so skip formatting it.
    return value.isNotNull()


def completeness(schema: T.StructType, names: Sequence[str], digits: int = 4) -> Column:
    """Share of the named columns that hold something, rounded half up."""
    populated = reduce(add, (_is_populated(n, schema).cast("int") for n in names))
    return F.round(populated / F.lit(len(names)), digits)


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole`` rounded half up; 0.0 where the whole is 0."""
    return F.when(whole > 0, F.round(part / whole, digits)).otherwise(F.lit(0.0))
