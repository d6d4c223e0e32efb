"""Column types by number, their Spark types, and parsing that never yields null."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Type ids, as stored in column specifications: (name, Spark type, default as SQL).
SCALARS = {
    1: ("BOOL", "boolean", "false"),
    101: ("INT8", "tinyint", "0"),
    102: ("UINT8", "smallint", "0"),
    103: ("INT16", "smallint", "0"),
    104: ("UINT16", "int", "0"),
    105: ("INT32", "int", "0"),
    106: ("UINT32", "bigint", "0"),
    107: ("INT64", "bigint", "0"),
    109: ("UNIXTIME", "bigint", "0"),
    201: ("FLOAT16", "float", "0"),
    202: ("FLOAT32", "float", "0"),
    203: ("FLOAT64", "double", "0"),
    204: ("FLOAT96", "double", "0"),
    205: ("FLOAT128", "double", "0"),
    301: ("STRING", "string", "''"),
    302: ("EMAIL", "string", "''"),
}
EMAIL_SIZE = 64
LIST_OFFSET = 1000


@dataclass(frozen=True)
class DType:
    """A scalar type, or a list of it with a fixed dimension; strings have a size."""

    id: int
    size: int | None = None
    dimension: int | None = None

    def __post_init__(self):
        if self.scalar_id not in SCALARS:
            raise ValueError(f"unknown type {self.id}")
        if self.scalar_id == 301 and self.size is None:
            raise ValueError("a string type needs a size")
        if self.is_list and not isinstance(self.dimension, int):
            raise ValueError("a list type needs an integer dimension")

    @property
    def scalar_id(self) -> int:
        return self.id % LIST_OFFSET

    @property
    def is_list(self) -> bool:
        return self.id > LIST_OFFSET

    @property
    def is_number(self) -> bool:
        return 100 <= self.scalar_id < 300

    @property
    def is_string(self) -> bool:
        return 300 <= self.scalar_id < 400

    @property
    def is_bool(self) -> bool:
        return self.scalar_id == 1

    @property
    def element(self) -> str:
        return SCALARS[self.scalar_id][1]

    @property
    def sql(self) -> str:
        return f"array<{self.element}>" if self.is_list else self.element

    @property
    def default(self) -> Column:
        value = F.expr(f"cast({SCALARS[self.scalar_id][2]} as {self.element})")
        return F.array_repeat(value, self.dimension) if self.is_list else value


_WIDTH = {101: 8, 103: 16, 105: 32, 107: 64, 109: 64}
_UNSIGNED = {102: 8, 104: 16, 106: 32}
_SIGNED_BY_WIDTH = {8: 101, 16: 103, 32: 105, 64: 107}


def wider(a: int, b: int) -> int:
    """The least type id that holds both; text wins over numbers, floats over integers."""
    if a == b:
        return a
    if a // 100 != b // 100:
        return max(a, b)
    if a // 100 == 1:
        width = lambda t: _WIDTH.get(t) or _UNSIGNED[t]
        if a in _UNSIGNED and b in _UNSIGNED:
            return max(a, b)
        need = max(width(t) * (2 if t in _UNSIGNED else 1) for t in (a, b))
        return _SIGNED_BY_WIDTH[min(64, need)]
    return max(a, b)


def clean_text(value: Column, size: int | None) -> Column:
    """ASCII characters only, without white space around them, at most ``size``."""
    text = F.trim(F.regexp_replace(value.cast("string"), r"[^\x00-\x7F]", ""))
    return F.substring(text, 1, size) if size else text


def parse(value: Column, dtype: DType) -> Column:
    """A raw value in its type; missing, empty or unreadable ones become the type's default."""
    if dtype.is_list:
        # Lists come from a transformer; here only their length is made sure.
        padded = F.concat(F.coalesce(value, F.array().cast(dtype.sql)), dtype.default)
        return F.slice(padded, 1, dtype.dimension)
    if dtype.is_string:
        return F.coalesce(clean_text(value, EMAIL_SIZE if dtype.scalar_id == 302 else dtype.size), F.lit(""))
    if dtype.is_bool:
        text = F.trim(value.cast("string"))
        return F.coalesce(text != "", F.lit(False))
    return F.coalesce(value.cast("string").try_cast("double").try_cast(dtype.element) if dtype.scalar_id >= 200 else F.trim(value.cast("string")).try_cast(dtype.element), dtype.default)
