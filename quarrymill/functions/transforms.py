"""Named column transformers. A transformer takes a Column and keyword parameters and returns a Column."""

from __future__ import annotations

import inspect
from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

REGISTRY: dict[str, Callable[..., Column]] = {}


def transformer(f: Callable[..., Column]) -> Callable[..., Column]:
    REGISTRY[f.__name__] = f
    return f


#: How parameters that are given as text become values, by the annotation of the transformer's parameter.
DECODERS: dict[str, Callable] = {"int": int, "float": float, "bool": lambda v: v.strip().lower() in ("true", "1", "yes", "on"), "datetime": datetime.fromisoformat}


def _check(f: Callable) -> dict[str, inspect.Parameter]:
    """The parameters after the value; a transformer needs the value alone."""
    params = list(inspect.signature(f).parameters.values())
    if not params or params[0].kind not in (params[0].POSITIONAL_ONLY, params[0].POSITIONAL_OR_KEYWORD):
        raise ValueError("a transformer takes the value as its first parameter")
    more = [p.name for p in params[1:] if p.default is p.empty and p.kind in (p.POSITIONAL_ONLY, p.POSITIONAL_OR_KEYWORD) and p.name != "record"]
    if more:
        raise ValueError(f"parameters without a default: {', '.join(more)}")
    return {p.name: p for p in params[1:]}


def _decoded(f: Callable, kw: dict) -> dict:
    params = _check(f)
    if unknown := [k for k in kw if k not in params and not any(p.kind == p.VAR_KEYWORD for p in params.values())]:
        raise ValueError(f"no such parameters: {', '.join(unknown)}")
    kind = lambda k: str(getattr(a := params[k].annotation, "__name__", a)).split(" |")[0] if k in params else ""
    return {k: DECODERS[kind(k)](v) if isinstance(v, str) and kind(k) in DECODERS else v for k, v in kw.items()}


def register(name: str, f: Callable[..., Column], return_type: str | None = None) -> None:
    """Adds a transformer of the user's. With ``return_type``, f maps one Python value to one value and runs as an Arrow UDF."""
    _check(f)
    if return_type is None:
        REGISTRY[name] = f
        return

    def on_column(c: Column, **kw) -> Column:
        return F.udf(partial(f, **_decoded(f, kw)), return_type, useArrow=True)(c)

    REGISTRY[name] = on_column


def register_sql(spark: SparkSession, name: str, expression: str, return_type: str = "string") -> None:
    """Adds a transformer from SQL text over ``value`` (text), such as "upper(trim(value))", as a temporary SQL function."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS {return_type} RETURN {expression}")
    REGISTRY[name] = lambda c: F.call_function(name, c.cast("string"))


def apply(name: str, c: Column, record: dict[str, Column] | None = None, **kw) -> Column:
    """The transformer ``name`` on c; one that takes ``record`` gets the row's other columns."""
    if name not in REGISTRY:
        raise KeyError(f"no transformer {name}")
    f = REGISTRY[name]
    kw = _decoded(f, kw)
    if record is not None and "record" in inspect.signature(f).parameters:
        kw["record"] = record
    return f(c, **kw)


#: strptime directives and Java's letters for them.
_PATTERNS = {"Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "f": "SSSSSS", "z": "xx", "b": "MMM", "B": "MMMM", "y": "yy", "j": "DDD", "I": "hh", "p": "a", "a": "EEE", "A": "EEEE", "Z": "zzz", "%": "%"}


def java_pattern(pattern: str) -> str:
    """A strptime pattern in Java's letters."""
    out, literal, i = [], "", 0
    while i < len(pattern):
        if pattern[i] == "%" and i + 1 < len(pattern):
            if literal:
                out.append(f"'{literal}'" if any(ch.isalpha() for ch in literal) else literal)
            literal = ""
            if pattern[i + 1] not in _PATTERNS:
                raise ValueError(f"unknown directive %{pattern[i + 1]}")
            out.append(_PATTERNS[pattern[i + 1]])
            i += 2
        else:
            literal += pattern[i]
            i += 1
    if literal:
        out.append(f"'{literal}'" if any(ch.isalpha() for ch in literal) else literal)
    return "".join(out)


def _instant(c: Column, pattern: str | None, timezone: str | None) -> Column:
    at = F.try_to_timestamp(c, F.lit(java_pattern(pattern))) if pattern else c.cast("timestamp")
    has_zone = bool(pattern) and ("%z" in pattern or "%Z" in pattern)
    return F.to_utc_timestamp(at, timezone) if timezone and not has_zone else at


@transformer
def str2unixtime(c: Column, pattern: str | None = None, timezone: str | None = None, truncate_to: str | None = None) -> Column:
    """Epoch seconds, cut to second, hour, day or month; "millisecond" keeps the fraction."""
    at = _instant(c, pattern, timezone)
    if truncate_to == "millisecond":
        return F.unix_millis(at) / 1000.0
    if truncate_to in ("hour", "day", "month"):
        at = F.to_utc_timestamp(F.date_trunc(truncate_to, F.from_utc_timestamp(at, timezone)), timezone) if timezone else F.date_trunc(truncate_to, at)
    elif truncate_to not in (None, "second"):
        raise ValueError(f"can't cut to {truncate_to}")
    return F.unix_seconds(at)


@transformer
def str2datetime(c: Column, pattern: str | None = None, srctimezone: str = "UTC", targettimezone: str = "UTC") -> Column:
    """The local time in the target zone."""
    return F.from_utc_timestamp(_instant(c, pattern, srctimezone), targettimezone)


@transformer
def number2group(c: Column, rules: list[tuple] = (), otherwise: str | None = None) -> Column:
    """The label of the first rule (label, operator, value) that holds; what isn't an integer is null and matches "null" only."""
    from quarrymill.operators.predicates import NUMBER, canonical

    number = c.cast("string").try_cast("bigint")
    return _first_match([(label, number.isNull() if op == "null" else NUMBER[canonical(op)](number, v)) for label, op, v in rules], otherwise, c)


@transformer
def str2group(c: Column, rules: list[tuple] = (), otherwise: str | None = None) -> Column:
    """The label of the first rule that matches: (label, pattern), found anywhere whatever the case, or (label, operator, value)."""
    from quarrymill.operators.predicates import TEXT, canonical

    text = c.cast("string")
    return _first_match([(r[0], text.rlike(f"(?i){r[1]}") if len(r) == 2 else TEXT[canonical(r[1])](text, r[2])) for r in rules], otherwise, c)


def _first_match(tests: list[tuple[str, Column]], otherwise: str | None, value: Column) -> Column:
    out = None
    for label, test in tests:
        out = (F if out is None else out).when(F.coalesce(test, F.lit(False)), F.lit(label))
    failed = F.lit(otherwise) if otherwise is not None else F.raise_error(F.concat(F.lit("no group for "), F.coalesce(value.cast("string"), F.lit("null")))).cast("string")
    return out.otherwise(failed) if out is not None else failed


@transformer
def urldecode(c: Column) -> Column:
    return F.try_url_decode(c)


@transformer
def urlhost(c: Column) -> Column:
    return F.try_parse_url(c, F.lit("HOST"))


KEY_SIZE = 511


@transformer
def resourcekey(c: Column, record: dict[str, Column] = None, path: str = "path", query: str | None = None, configs: dict[str, str] = None, default: str = "") -> Column:
    """What a request asked for: by domain a SQL expression over ``path`` and ``query`` (decoded); nothing found: default."""
    decoded_path = F.try_url_decode(record[path])
    decoded_query = F.try_url_decode(record[query]) if query else F.lit(None).cast("string")
    out = F.lit(None).cast("string")
    for domain, (kind, arg) in reversed(list((configs or {}).items())):
        if kind == "path":
            found = F.nullif(F.regexp_extract(decoded_path, r"^/*(?:[^/?#]+/){%d}([^/?#]+)" % int(arg), 1), F.lit(""))
        elif kind == "query":
            found = F.nullif(F.regexp_extract(decoded_query, r"(?:^|[?&])" + arg + r"=([^&#]*)", 1), F.lit(""))
        elif kind == "pattern":
            found = F.nullif(F.regexp_extract(decoded_path, arg, 1), F.lit(""))
        else:
            raise ValueError(f"unknown extractor {kind}")
        out = F.when(c == domain, found).otherwise(out)
    return F.substring(F.coalesce(out, F.lit(default)), 1, KEY_SIZE)
