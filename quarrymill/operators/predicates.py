"""Condition operators by type: Column, operator name, value -> Column."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarrymill.functions.network import in_ranges
from quarrymill.functions.types import DType


class UnsupportedOperator(ValueError):
    """No such operator for this type."""


def _any(tests) -> Column:
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def _many(v) -> list:
    return list(v) if isinstance(v, list | tuple | set) else [v]


NUMBER: dict[str, Callable] = {
    "==": lambda c, v: c == v,
    "!=": lambda c, v: c != v,
    ">": lambda c, v: c > v,
    ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v,
    "<=": lambda c, v: c <= v,
    "between": lambda c, v: (c >= v[0]) & (c < v[1]),  # the upper bound is out
    "in": lambda c, v: c.isin(_many(v)),
    "not in": lambda c, v: ~c.isin(_many(v)),
}

_TEXT: dict[str, Callable] = {
    "==": lambda c, v: c == v,
    "in": lambda c, v: c.isin(_many(v)),
    "contain": lambda c, v: c.contains(v),
    "mcontain": lambda c, v: _any(c.contains(x) for x in _many(v)),
    "startswith": lambda c, v: c.startswith(v),
    "mstartswith": lambda c, v: _any(c.startswith(x) for x in _many(v)),
    "endswith": lambda c, v: c.endswith(v),
    "mendswith": lambda c, v: _any(c.endswith(x) for x in _many(v)),
    "ip range": lambda c, v: in_ranges(c, [v]),
    "ip ranges": lambda c, v: in_ranges(c, _many(v)),
}
#: Every text operator has its negation: none of.
TEXT = _TEXT | {"!=": lambda c, v: c != v} | {f"not {k}" if k != "==" else "<>": (lambda f: lambda c, v: ~f(c, v))(f) for k, f in _TEXT.items()} | {"not in ip range": lambda c, v: ~in_ranges(c, [v]), "not in ip ranges": lambda c, v: ~in_ranges(c, _many(v))}


def _array(values, element: str) -> Column:
    return F.array(*(F.lit(x).cast(element) for x in values)).cast(f"array<{element}>")


def _bounds(v, n: int, i: int) -> list:
    return list(v[i]) if isinstance(v[i], list | tuple) else [v[i]] * n


def _within(c: Column, v, d: DType) -> Column:
    """Every element in its closed interval; bounds are numbers, or lists with one for each element."""
    low, high = (_array(_bounds(v, d.dimension, i), "double") for i in (0, 1))
    ok = F.zip_with(F.zip_with(c, low, lambda x, b: F.struct(x.alias("x"), b.alias("lo"))), high, lambda s, b: (s["x"] >= s["lo"]) & (s["x"] <= b))
    return F.forall(ok, lambda x: F.coalesce(x, F.lit(False)))


def _list_in(c: Column, v, d: DType, mode: str) -> Column:
    lists = [list(x) if isinstance(x, list | tuple) else [x] for x in v]
    if mode == "tuple" or len(lists) == 1:
        return _any(c == _array(x, d.element) for x in lists)
    # All elements are members of the union of the candidates' elements.
    union = _array([x for one in lists for x in one], d.element)
    return F.forall(c, lambda x: F.array_contains(union, x))


def _list(op: str, c: Column, v, d: DType, mode: str) -> Column | None:
    equal = lambda: c == _array(_many(v), d.element)
    forms = {
        "==": equal,
        "!=": lambda: ~equal(),
        "in": lambda: _list_in(c, v, d, mode),
        "not in": lambda: ~_list_in(c, v, d, mode),
        "range": lambda: _within(c, v, d),
        "not in range": lambda: ~_within(c, v, d),
        "ranges": lambda: _any(_within(c, x, d) for x in v),
        "not in ranges": lambda: ~_any(_within(c, x, d) for x in v),
    }
    return forms[op]() if op in forms else None


def canonical(op: str) -> str:
    op = " ".join(op.strip().lower().split())
    return {"=": "==", "<>": "!="}.get(op, op)


def predicate(c: Column, dtype: DType, op: str, value, list_in_mode: str = "union") -> Column:
    """The condition ``c op value`` for a column of this type."""
    name = canonical(op)
    if dtype.is_list and dtype.is_number:
        if (out := _list(name, c, value, dtype, list_in_mode)) is not None:
            return out
    elif not dtype.is_list and dtype.is_number and name in NUMBER:
        return NUMBER[name](c, value)
    elif not dtype.is_list and dtype.is_string and name in TEXT:
        return TEXT[name](c, value)
    raise UnsupportedOperator(f"operator {op!r} isn't there for type {dtype.id}")
