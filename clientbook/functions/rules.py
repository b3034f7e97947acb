"""Ordered rules as plain ``CASE`` columns."""

from __future__ import annotations

import operator
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientbook.config import Scale

_COMPARE = {
    "<=": operator.le,
    ">=": operator.ge,
    ">": operator.gt,
    "==": operator.eq,
}


def first_match(rules: Iterable[tuple[Column, object]], otherwise: object = None) -> Column:
    """Result of the first rule whose condition holds."""
    chain = None
    for condition, result in rules:
        chain = (F if chain is None else chain).when(condition, result)
    return chain.otherwise(otherwise)


def on_scale(value: Column, scale: Scale) -> Column:
    """Place ``value`` on an ordered scale of thresholds."""
    return first_match(
        ((_COMPARE[s.op](value, F.lit(s.bound)), F.lit(s.result)) for s in scale.steps),
        F.lit(scale.otherwise),
    )


def evaluate_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns that later filters and rules use as they are.

    A filter on a projected column is normally moved below the projection with the column's
    whole expression copied into every mention. Scores build on scores here, so the copies
    multiply until the generated code no longer compiles. The output of a generator is not
    copied, and a one-element ``inline`` is a generator that keeps each row as it is.
    """
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def lookup(key: Column, table: dict) -> Column:
    """Simple ``CASE key WHEN …``; ``NULL`` for a key that is not in the table."""
    return first_match(((key == k, F.lit(v)) for k, v in table.items()), F.lit(None))


def position(key: Column, ordered: tuple[str, ...]) -> Column:
    """1-based place of ``key`` in a fixed display order; unknown keys come last."""
    return first_match(
        ((key == k, F.lit(i)) for i, k in enumerate(ordered, start=1)), F.lit(len(ordered) + 1)
    )


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.and_, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(operator.or_, conditions, F.lit(False))


def optional_filters(**choices: Iterable[str] | None) -> Column:
    """Conjunction of ``column IN (values)``; a ``None`` or empty choice filters nothing.

    Values travel as literals, never as SQL text.
    """
    return all_of(F.col(name).isin(list(values)) for name, values in choices.items() if values)


def fill(template: str, **values: Column) -> Column:
    """Build text from a ``{name}`` template and columns, as one ``concat``."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        if head:
            parts.append(F.lit(head))
        parts.append(values[name].cast("string"))
    if rest:
        parts.append(F.lit(rest))
    return F.concat(*parts)
