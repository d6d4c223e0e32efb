"""Audit logs: flattening of nested records, and a paged REST source."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

#: The scalar fields of a record.
SCALARS = ("activityDateTime", "category", "operationType", "activityDisplayName", "result", "resultReason", "loggedByService", "id", "correlationId")

RECORD = (
    ", ".join(f"{s} string" for s in SCALARS)
    + ", initiatedBy struct<app:map<string,string>,user:map<string,string>>, additionalDetails array<struct<key:string,value:string>>"
    + ", targetResources array<map<string,string>>"
)
_MODIFIED = "array<struct<displayName:string,oldValue:string,newValue:string>>"


def _once(value: Column, then) -> Column:
    """``then`` of a value that is computed once, however often ``then`` names it."""
    return F.transform(F.array(value), then)[0]


_PAIRS = "array<struct<key:string,value:string>>"


def _entries(r: Column) -> Column:
    """Names and values of a parsed record, in order."""
    some = lambda c, kind=_PAIRS: F.coalesce(c, F.array().cast(kind))
    named = lambda prefix, pairs: F.transform(pairs, lambda e: F.struct(F.concat(F.lit(prefix), e["key"]).alias("key"), e["value"].alias("value")))
    pairs = [F.array(*(F.struct(F.lit(s).alias("key"), r[s].alias("value")) for s in SCALARS))]
    pairs += [named(f"initiatedBy.{kind}.", some(F.map_entries(r["initiatedBy"][kind]))) for kind in ("app", "user")]
    pairs.append(named("additionalDetails.", some(r["additionalDetails"])))

    def target(t: Column) -> Column:
        kind = F.coalesce(t["type"], F.lit("Other"))
        change = lambda m, of: F.concat(m["displayName"], F.lit(f".{of}="), F.coalesce(m[f"{of}Value"], F.lit("")))

        def prop(e: Column) -> Column:
            changes = F.from_json(e["value"], _MODIFIED)
            told = F.array_join(F.transform(changes, lambda m: F.concat(F.lit("("), change(m, "old"), F.lit(","), change(m, "new"), F.lit(")"))), "")
            return F.struct(F.concat(F.lit("targetResource."), kind, F.lit("."), e["key"]).alias("key"), F.when(e["key"] == "modifiedProperties", told).otherwise(e["value"]).alias("value"))

        return F.transform(F.filter(F.map_entries(t), lambda e: e["key"] != "type"), prop)

    pairs.append(F.flatten(F.transform(some(r["targetResources"], "array<map<string,string>>"), target)))
    return F.filter(F.concat(*pairs), lambda e: e["key"].isNotNull())


def _as_map(entries: Column) -> Column:
    """A name that repeats keeps its last value."""
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(entries, lambda e: e["key"] == k), -1)["value"]))


def flat(record: Column) -> Column:
    """A JSON record as a map from flat names to text."""
    return _once(_once(F.from_json(record, RECORD), _entries), _as_map)


def flatten(records: DataFrame, column: str = "value", known: tuple[str, ...] = SCALARS, most: int = 10_000) -> tuple[DataFrame, tuple[str, ...]]:
    """(a column for each known name, then one for each new name; all names). More than ``most`` names are an error: a table can't have so many columns."""
    maps = records.select(flat(F.col(column)).alias("m"))
    found = [r[0] for r in maps.select(F.explode(F.map_keys("m"))).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"the records have more than {most} names; keep the map of flat() as one column")
    names = (*known, *sorted(set(found) - set(known)))
    return maps.select(*(F.try_element_at("m", F.lit(n)).alias(n) for n in names)), names


class Pages:
    """Records of a paged REST service by slices of time; each slice follows its own next links, a page at a time.

    With ``tokenurl`` (and clientid, clientsecret, scope) a task asks for a token by client credentials, and for a new one where it has run out; else ``token`` is
    sent, if there is one. A page that fails is asked for again, up to ``retries`` times after ``wait``, twice ``wait`` and so on seconds: the pages before it aren't read
    again. A service that answers newest first has ``ascending`` false: its pages are turned round; ``in_order`` sorts all of them.
    """

    def __init__(self, options: dict[str, str]):
        self.options = options

    def slices(self, start: datetime, end: datetime) -> list[InputPartition]:
        n = int(self.options.get("slices", "1"))
        ends = [start + (end - start) * i / n for i in range(n + 1)]
        return [InputPartition((a.isoformat(), b.isoformat())) for a, b in zip(ends, ends[1:]) if a < b]

    def token(self) -> str | None:
        if "tokenurl" not in self.options:
            return self.options.get("token")
        form = {"grant_type": "client_credentials", "client_id": self.options["clientid"], "client_secret": self.options["clientsecret"], "scope": self.options.get("scope", "")}
        request = urllib.request.Request(self.options["tokenurl"], data=urllib.parse.urlencode(form).encode())  # noqa: S310
        with urllib.request.urlopen(request, timeout=60) as answer:  # noqa: S310
            return json.load(answer)["access_token"]

    def _pages(self, low: str, high: str) -> Iterator[list[dict]]:
        time_ = self.options.get("timefield", SCALARS[0])
        query = urllib.parse.urlencode({"$filter": f"{time_} ge {low}Z and {time_} lt {high}Z"})
        url, token, left = f"{self.options['url']}?{query}", self.token(), int(self.options.get("retries", "3"))
        wait = float(self.options.get("wait", "1"))
        while url:
            try:
                request = urllib.request.Request(url, headers={"Authorization": f"Bearer {token}"} if token else {})  # noqa: S310
                with urllib.request.urlopen(request, timeout=60) as answer:  # noqa: S310
                    page = json.load(answer)
            except (OSError, ValueError) as e:  # refused, cut off, or no JSON
                refused = isinstance(e, urllib.error.HTTPError) and 400 <= e.code < 500 and e.code not in (401, 408, 429)
                if refused or not left or getattr(e, "code", None) == 401 and "tokenurl" not in self.options:
                    raise
                time.sleep(wait)
                token, left, wait = self.token(), left - 1, 2 * wait
                continue
            left, wait = int(self.options.get("retries", "3")), float(self.options.get("wait", "1"))
            yield page.get("value", [])
            url = page.get("@odata.nextLink")

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        down = self.options.get("ascending", "true").lower() != "true"
        field = self.options.get("timefield", SCALARS[0])
        for page in self._pages(*partition.value):
            for record in reversed(page) if down else page:
                yield record.get(field), json.dumps(record)


class AuditPages(Pages, DataSourceReader):
    """The records between ``start`` and ``end``."""

    def partitions(self) -> list[InputPartition]:
        return self.slices(*(datetime.fromisoformat(self.options[k]) for k in ("start", "end")))


class AuditStream(Pages, DataSourceStreamReader):
    """The records from ``start`` on, as they come. An offset is a time: a batch is the records between two, and a batch that fails is asked for again.

    Records are taken ``lag`` seconds (300 by default) after their time, when the service has them all; with ``end`` not beyond it.
    """

    def initialOffset(self) -> dict:
        return {"time": datetime.fromisoformat(self.options["start"]).isoformat()}

    def latestOffset(self) -> dict:
        now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0) - timedelta(seconds=float(self.options.get("lag", "300")))
        latest = min(now, datetime.fromisoformat(self.options["end"])) if "end" in self.options else now
        return {"time": max(latest, datetime.fromisoformat(self.options["start"])).isoformat()}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return self.slices(datetime.fromisoformat(start["time"]), datetime.fromisoformat(end["time"]))

    def commit(self, end: dict) -> None:
        """The service keeps its records; there is nothing to give back."""


class AuditLog(DataSource):
    """spark.dataSource.register(AuditLog); spark.read (or readStream).format("auditlog").options(url=, token=, start=, end=)."""

    @classmethod
    def name(cls) -> str:
        return "auditlog"

    def schema(self) -> str:
        return "time string, value string"

    def reader(self, schema) -> DataSourceReader:
        return AuditPages(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return AuditStream(dict(self.options))


def in_order(records: DataFrame) -> DataFrame:
    """Records by time, whatever order the service and its slices gave them in."""
    return records.orderBy("time", "value")
