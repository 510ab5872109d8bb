"""Quality rules: boolean expressions with a label."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add, or_
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluicegate.functions.values import is_blank

REASON_SEPARATOR = "; "

# A mask is a 64-bit number, whose sign stays free.
MOST_RULES = 63


class Rule(Protocol):
    """A named check.  ``fails`` must be true or false, never null."""

    @property
    def label(self) -> str: ...

    def fails(self) -> Column: ...


@dataclass(frozen=True)
class Required:
    """The column must hold text other than spaces."""

    column: str
    label: str

    def fails(self) -> Column:
        return is_blank(F.col(self.column))


@dataclass(frozen=True)
class Between:
    """The column, where it has a value, must lie in ``[low, high]``.  NaN does not."""

    column: str
    low: float
    high: float
    label: str

    def fails(self) -> Column:
        value = F.col(self.column)
        return value.isNotNull() & ((value < self.low) | (value > self.high))


def _check_labels(rules: Sequence[Rule]) -> None:
    if any(not rule.label for rule in rules):
        raise ValueError("a rule without a label could not reject a row")


def failure_mask(rules: Sequence[Rule]) -> Column:
    """The failing rules as the bits of a number, the first rule the lowest; 0 where none fails."""
    _check_labels(rules)
    if len(rules) > MOST_RULES:
        raise ValueError(f"a mask holds {MOST_RULES} rules")
    bits = (r.fails().cast("long") * F.lit(1 << at).cast("long") for at, r in enumerate(rules))
    return reduce(add, bits, F.lit(0).cast("long"))


def reasons_in(mask: Column, rules: Sequence[Rule]) -> Column:
    """The text of ``rejection_reason`` from a mask, without checking a rule again."""
    bits = (mask.bitwiseAND(F.lit(1 << at).cast("long")) != 0 for at in range(len(rules)))
    labels = (F.when(bit, F.lit(r.label)) for bit, r in zip(bits, rules, strict=True))
    return F.concat_ws(REASON_SEPARATOR, *labels)


def rejection_reason(rules: Sequence[Rule]) -> Column:
    """Labels of all failing rules in rule order; empty text where none fails."""
    _check_labels(rules)
    return F.concat_ws(REASON_SEPARATOR, *(F.when(r.fails(), F.lit(r.label)) for r in rules))


def passes_all(rules: Sequence[Rule]) -> Column:
    """True exactly where ``rejection_reason`` is empty, without building the text."""
    return ~reduce(or_, (rule.fails() for rule in rules))
