"""Specifications of datasets and reports, as frozen dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from typing import Any

from quarrymill.functions.types import DType


@dataclass(frozen=True)
class Transform:
    """A named transformer and its parameters."""

    name: str
    parameters: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class ColumnSpec:
    """One typed column. source: the raw column it is read from; computed: "new" or "override" adds it to the data itself."""

    name: str
    dtype: DType
    source: str | None = None
    transformer: Transform | None = None
    statistical: bool = False
    filterable: bool = True
    groupable: bool = False
    distinctable: bool = False
    computed: str | None = None
    enum: str | None = None  # the dictionary whose ids the column holds
    group_enum: bool = False  # its ids, not its labels, give the order
    normalize: str | None = None  # SQL over the raw columns
    include: tuple[str, ...] = ()  # SQL conditions over the raw columns
    exclude: tuple[str, ...] = ()
    to_string: str | None = None  # a registered renderer of list keys

    @property
    def used(self) -> bool:
        return self.statistical or self.filterable or self.groupable or self.distinctable


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: tuple[ColumnSpec, ...]
    data_interval: str = "Hourly"
    header: tuple[str, ...] = ()
    has_header: bool = False
    multi_line: bool = True  # quoted CSV values may hold line breaks
    filetype: str = "csv"
    filename: str = "%Y%m%d%H.csv"
    cache_timeout: int = 28
    ignore_missing_datafile: bool = False
    timezone: str = "UTC"  # whose wall clock days, ranges and file names are of; times without a zone in the data are UTC
    time_column: str = "interval_start"

    def column(self, name: str) -> ColumnSpec:
        for c in self.columns:
            if c.name == name:
                return c
        raise KeyError(f"dataset {self.name} has no column {name!r}")


@dataclass(frozen=True)
class ReportSpec:
    """conditions and raw_conditions: (column, operator, value); having: (alias or "distinct", operator, number);
    sort_by: (key or alias, "asc" or other); resultset: (column, aggregate, alias or None).

    options: bucket_mode "floor" or "label"; list_in_mode "union" or "tuple"; empty_minmax "null" or "zero";
    strict (check usage flags of conditions); limit; single_file (result files are one file each).
    """

    name: str
    dataset: str
    start: datetime | None = None
    end: datetime | None = None
    rtype: str | int | None = None
    conditions: tuple[tuple, ...] = ()
    raw_conditions: tuple[tuple, ...] = ()
    having: tuple[tuple, ...] = ()
    group_by: tuple[str, ...] = ()
    sort_by: tuple[tuple, ...] = ()
    resultset: tuple[tuple, ...] = ()
    periodic: bool = True
    id: int = 0
    options: dict[str, Any] = field(default_factory=dict)

    @property
    def is_details(self) -> bool:
        return not self.resultset or any(r[0] == "__all__" for r in self.resultset)
