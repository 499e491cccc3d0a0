"""Paged item API as a Spark data source.

``spark.read.format("item_api")`` with options ``start``, ``end`` (days), ``days`` (window
length, one partition each) or ``windows`` (JSON pairs of days), ``field`` (the time field of the window) and ``transport``
(import path ``module:function`` of a callable ``(url, body) -> dict``; the default
speaks HTTP). Each partition walks its window's pages; a page names the next one.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
import time
import urllib.error
import urllib.request

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE = 200
TRIES = 8


def next_request(page: dict, url: str, body: dict) -> tuple[str, dict] | None:
    """The request for the following page: a ``next`` link's body, merged into the present one if it says so."""
    link = next((x for x in page.get("links", []) if x.get("rel") == "next"), None)
    if link is None:
        return None
    given = link.get("body") or {}
    return link.get("href", url), ({**body, **given} if link.get("merge") else given or body)


def wait_seconds(attempt: int) -> int:
    return min(5 * 2**attempt, 300)


def http(url: str, body: dict, sleep=time.sleep) -> dict:
    """POST with retries; a missing resource is not retried."""
    data = json.dumps(body).encode()
    for attempt in range(TRIES):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, data, {"Content-Type": "application/json"}), timeout=120) as got:
                return json.load(got)
        except urllib.error.HTTPError as error:
            if error.code == 404 or attempt == TRIES - 1:
                raise
        except urllib.error.URLError:
            if attempt == TRIES - 1:
                raise
        sleep(wait_seconds(attempt))
    raise AssertionError("unreachable")


def named(path: str):
    """The function that an import path ``module:function`` names."""
    module, _, name = path.partition(":")
    return getattr(importlib.import_module(module), name)


def http_get(url: str) -> str | None:
    """The body of an object; None where it is missing."""
    try:
        with urllib.request.urlopen(url, timeout=120) as got:
            return got.read().decode()
    except urllib.error.HTTPError as error:
        if error.code == 404:
            return None
        raise


def http_list(folder: str) -> list[str]:
    """Keys below a folder ``https://host/prefix`` of a bucket that answers version 2 listings, page by page."""
    import re
    import urllib.parse
    from xml.sax.saxutils import unescape

    host, _, prefix = folder.partition("://")[2].partition("/")
    keys, token = [], None
    while True:
        query = {"list-type": "2", "prefix": prefix} | ({"continuation-token": token} if token else {})
        page = http_get(f"https://{host}/?{urllib.parse.urlencode(query)}") or ""
        keys += [unescape(k) for k in re.findall(r"<Key>([^<]*)</Key>", page)]
        more = re.search(r"<NextContinuationToken>([^<]*)<", page)
        if not more:
            return keys
        token = unescape(more.group(1))


def list_objects(folders, transport: str = f"{__name__}:http_list"):
    """``folder, key``: the objects below each folder of a DataFrame with ``folder``; tasks list some folders each."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            rows = [(f, k) for f in batch["folder"] for k in named(transport)(f)]
            yield pd.DataFrame(rows, columns=["folder", "key"], dtype=object)

    return folders.select("folder").mapInPandas(run, "folder string, key string")


def get_objects(keys, transport: str = f"{__name__}:http_get"):
    """``key, value``: the text of each object of a DataFrame with ``key``, null where it is missing; one request a row."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            yield pd.DataFrame({"key": batch["key"], "value": [named(transport)(k) for k in batch["key"]]}, dtype=object)

    return keys.select("key").mapInPandas(run, "key string, value string")


def windows(start: str, end: str, days: int) -> list[tuple[str, str]]:
    """Consecutive windows of ``days`` days that cover start..end, both included."""
    a, b, out = dt.date.fromisoformat(start), dt.date.fromisoformat(end), []
    while a <= b:
        last = min(a + dt.timedelta(days - 1), b)
        out.append((a.isoformat(), last.isoformat()))
        a = last + dt.timedelta(1)
    return out


class Window(InputPartition):
    def __init__(self, first: str, last: str):
        super().__init__(0)
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def partitions(self):
        o = self.options
        listed = json.loads(o["windows"]) if "windows" in o else windows(o["start"], o["end"], int(o.get("days", 1)))
        return [Window(*w) for w in listed]

    def read(self, partition):
        o = self.options
        send = named(o.get("transport", f"{__name__}:http"))
        span = f"{partition.first}T00:00:00Z/{partition.last}T23:59:59.999Z"
        body = {"collections": [o["collection"]], "limit": int(o.get("limit", PAGE))}
        if o.get("field", "datetime") == "datetime":
            body["datetime"] = span
        else:
            low, high = span.split("/")
            body["query"] = {o["field"]: {"gte": low, "lte": high}}
        request = (o["url"], body)
        while request:
            page = send(*request)
            for item in page.get("features", []):
                yield partition.first, item.get("id"), json.dumps(item, separators=(",", ":"))
            request = next_request(page, *request)


class ItemApi(DataSource):
    @classmethod
    def name(cls):
        return "item_api"

    def schema(self):
        return "window string, id string, value string"

    def reader(self, schema):
        return _Reader(dict(self.options))


def register(spark) -> None:
    spark.dataSource.register(ItemApi)


def missing_windows(wanted: list[tuple[str, str]], fetched: set[str]) -> list[tuple[str, str]]:
    """Windows that no earlier run has fetched; a fetched window without rows counts as fetched."""
    return [w for w in wanted if w[0] not in fetched]
