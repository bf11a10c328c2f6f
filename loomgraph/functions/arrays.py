"""Walking long arrays in expressions.

A fold copies its state at every step, so appending n elements one by one copies
n * n of them.  Here arrays are walked in about sqrt(n) pieces of sqrt(n).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """body(value) with the value worked out once, however often the body uses it, also inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def pieces(array: Column | str) -> Column:
    """The array cut into about as many consecutive pieces as each has elements."""

    def cut(a):
        size = F.greatest(F.ceil(F.sqrt(F.size(a))).cast("int"), F.lit(1))
        starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.size(a) / size).cast("int") - 1, F.lit(0)))
        return let(size, lambda n: F.transform(starts, lambda k: F.slice(a, k * n + 1, n)))

    return let(F.col(array) if isinstance(array, str) else array, cut)


def walk(array: Column | str, first: Column, kind: str, step) -> Column:
    """What step(state, element) appends on its way through the array; it gives the next state and an array of `kind` to append."""
    none = F.array().cast(f"array<{kind}>")

    def inner(acc, x):
        state, new = step(acc["state"], x)
        return F.struct(state.alias("state"), F.concat(acc["own"], new).alias("own"))

    # a fold copies its whole state at each step, so a piece is folded on its own and then added
    def outer(acc, piece):
        walked = F.aggregate(piece, F.struct(acc["state"].alias("state"), none.alias("own")), inner)
        return let(walked, lambda w: F.struct(w["state"].alias("state"), F.array_append(acc["done"], w["own"]).alias("done")))

    start = F.struct(first.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("done"))
    return F.aggregate(pieces(array), start, outer, lambda acc: F.flatten(acc["done"]))
