"""A paged API as a Spark data source: one cursor, a cap on pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader


def read_pages(fetch: Callable[[str | None], dict], most: int) -> Iterator[dict]:
    """Items of all pages; raises when the cap is reached with pages left."""
    cursor = None
    for _ in range(most):
        page = fetch(cursor)
        yield from page.get("data", [])
        cursor = page.get("next_page")
        if not cursor:
            return
    raise RuntimeError(f"more than {most} pages")


class PagedSource(DataSource):
    """``spark.read.format("paged")`` over page files in a folder: option ``path``; page N names the next one.

    It stands for a remote list whose pages are JSON objects {data: [...], next_page: name or null};
    the transport is a function, so that a service's client can take the place of the files. The folder is a URI that pyarrow's file systems open.
    """

    @classmethod
    def name(cls) -> str:
        return "paged"

    def schema(self) -> str:
        return "id string, type string, body string"

    def reader(self, schema):
        return PagedReader(self.options)


class PagedReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.first, self.most = options["path"], options.get("first", "0"), int(options.get("most", "100"))

    def read(self, partition):
        import json

        from quillspark.sources.corpus import _open

        files, root = _open(self.path)

        def fetch(cursor):
            with files.open_input_stream(f"{root}/{cursor or self.first}.json") as f:
                return json.loads(f.read())

        for item in read_pages(fetch, self.most):
            yield str(item.get("id")), item.get("type"), json.dumps(item, sort_keys=True)
