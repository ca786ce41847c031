"""Array helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also when nested lambdas refer to it."""
    return F.transform(F.array(value), body)[0]


def multiset(tokens: Column) -> Column:
    """Tokens with their ordinal among equal tokens, so that set operations count repeats.

    The sorted tokens are numbered run by run, in time linear in their number.
    """

    def first(ordered: Column) -> Column:
        starts = F.transform(ordered, lambda t, i: F.when((i == 0) | ~t.eqNullSafe(F.get(ordered, i - 1)), i))
        return F.filter(starts, lambda i: i.isNotNull())

    def number(ordered: Column, starts: Column) -> Column:
        def run(start: Column, k: Column) -> Column:
            length = F.coalesce(F.get(starts, k + 1), F.size(ordered)) - start
            return F.transform(F.sequence(F.lit(1), length), lambda n: F.concat(F.get(ordered, start), F.lit("#"), n))

        return F.flatten(F.transform(starts, run))

    return let(F.sort_array(tokens), lambda ordered: let(first(ordered), lambda starts: number(ordered, starts)))


def explode_once(df: DataFrame, array: Column, *names: str, keep: list[str | Column] = ()) -> DataFrame:
    """``keep`` and one row per element: (pos, element) or (element,), by the number of names.

    A plain explode of an expression also plans a filter on its size, which computes the expression a
    second time. The outer form does not; the row it leaves for an empty array is dropped afterwards.
    Elements must not be null.
    """
    explode = F.posexplode_outer if len(names) == 2 else F.explode_outer
    return df.select(*keep, explode(array).alias(*names)).filter(F.col(names[-1]).isNotNull())
