"""A Spark data source for paged interfaces, with whatever fetches a page as a parameter.

Cursors of one window follow each other, so that a window is a partition and windows run side by side. A page that fails
is asked for again with half its size, down to a floor; a page provider is any importable function, so that tests and
offline runs read recorded pages.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PAGE, FLOOR, TRIES = 1000, 100, 5

#: (window, cursor, size) -> (records, next cursor or None)
Provider = Callable[[str, str | None, int], tuple[list[dict], str | None]]


def provider_of(name: str) -> Provider:
    """The function that module:name names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def records(fetch: Provider, window: str, page: int = PAGE, floor: int = FLOOR, tries: int = TRIES) -> Iterator[dict]:
    """All records of a window, page after page."""
    cursor: str | None = None
    while True:
        size, left = page, tries
        while True:
            try:
                rows, following = fetch(window, cursor, size)
                break
            except TimeoutError:
                left -= 1
                if left == 0 or size == floor:
                    raise
                size = max(floor, size // 2)
        yield from rows
        if following is None or following == cursor:
            return
        cursor = following


class PagesReader(DataSourceReader):
    def __init__(self, options: dict):
        self.windows = json.loads(options["windows"])
        self.provider = options["provider"]
        self.page = int(options.get("page", PAGE))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(w) for w in self.windows]

    def read(self, partition: InputPartition):
        for record in records(provider_of(self.provider), partition.value, self.page):
            yield partition.value, json.dumps(record)


class Pages(DataSource):
    """spark.read.format("pages").option("provider", "module:function").option("windows", json)"""

    @classmethod
    def name(cls) -> str:
        return "pages"

    def schema(self) -> str:
        return "window string, record string"

    def reader(self, schema) -> DataSourceReader:
        return PagesReader(self.options)
