"""A paged catalog of sessions as a data source: format("session_catalog").

Pages come from a reader object, by default JSON over HTTP with three attempts. Reading stops at the total, at the limit
or at an empty page.
"""

from __future__ import annotations

import json
import time
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "sid string, fingerprint string, in_progress boolean, started_at string"
PAUSES = (2.0, 5.0)


def get_json(url: str, attempts: int = 3) -> dict:
    for i in range(attempts):
        try:
            with urllib.request.urlopen(url, timeout=60) as r:
                return json.load(r)
        except OSError:
            if i == attempts - 1:
                raise
            time.sleep(PAUSES[min(i, len(PAUSES) - 1)])
    return {}


class CatalogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.url = options["url"]
        self.size = int(options.get("pagesize", "100"))
        self.limit = int(options["limit"]) if "limit" in options else None
        self.attempts = int(options.get("attempts", "3"))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        given, page = 0, 1
        while True:
            doc = get_json(f"{self.url}?page={page}&size={self.size}", self.attempts)
            items = doc.get("items") or []
            for x in items:
                if self.limit is not None and given >= self.limit:
                    return
                yield x.get("sid"), x.get("fingerprint"), bool(x.get("in_progress")), x.get("started_at")
                given += 1
            if not items or given >= int(doc.get("total", given)):
                return
            page += 1


class SessionCatalog(DataSource):
    @classmethod
    def name(cls) -> str:
        return "session_catalog"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> CatalogReader:
        return CatalogReader(self.options)
