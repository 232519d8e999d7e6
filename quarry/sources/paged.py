"""Paged JSON source (A10-A12) as a Python Data Source.

The driver plans page numbers (known total, stated total, ``max_pages``,
or a short binary search for the last non-empty page); each input
partition is a range of ``pages_per_partition`` pages fetched on an
executor, so extraction runs in parallel and a lost executor refetches only
its pages.  Rows are ``(page, body, status)``;
records are parsed with ``from_json`` + ``explode`` in Spark (A11).

The page fetcher is injected: ``fetch(page, offset, size) -> str | None``
(``None`` or an empty list = past the end).  ``file_pages`` reads page
files; an HTTP fetcher is a few lines for the caller (no client here).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

Fetcher = Callable[[int, int, int], "str | None"]

PAGE_SCHEMA = "page int, body string, status string"


def file_pages(folder: str, pattern: str = "page-{page}.json") -> Fetcher:
    """Fetcher over page files ``folder/page-<n>.json`` (1-based) on any
    file system Arrow can open from a URI (shared ``hdfs://``, ``s3://``,
    ``file:`` or a plain path), so executors can read them on a cluster.
    A page may also be a folder holding the page as one data file."""
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder[len("file:"):]

    def fetch(page: int, offset: int, size: int):
        from pyarrow import fs as pafs
        if "://" in folder:
            filesystem, base = pafs.FileSystem.from_uri(folder)
        else:
            filesystem, base = pafs.LocalFileSystem(), folder
        path = base.rstrip("/") + "/" + pattern.format(page=page, offset=offset)
        info = filesystem.get_file_info(path)
        if info.type == pafs.FileType.Directory:
            names = sorted(i.path for i in filesystem.get_file_info(pafs.FileSelector(path))
                           if i.type == pafs.FileType.File and not i.base_name.startswith((".", "_")))
            if not names:
                return None
            if len(names) > 1:
                return _merged([_text(filesystem, n) for n in names], path)
            path = names[0]
        elif info.type != pafs.FileType.File:
            return None
        return _text(filesystem, path)
    return fetch


def _text(filesystem, path: str) -> str:
    with filesystem.open_input_stream(path) as f:
        return f.read().decode("utf-8")


def _merged(bodies: list[str], path: str) -> str:
    """One page that lies in several files: lists are joined in file order."""
    lists = [json.loads(b) for b in bodies if b.strip()]
    if not all(isinstance(x, list) for x in lists):
        raise ValueError(f"{path}: a page in several files must hold a list in each")
    return json.dumps([record for x in lists for record in x])


def _records_len(body: str | None, results_path: str) -> int:
    if body is None:
        return 0
    try:
        node = json.loads(body)
    except ValueError:
        return 1
    for part in [p for p in results_path.split(".") if p]:
        node = node.get(part) if isinstance(node, dict) else None
    if node is None:
        return 0
    return len(node) if isinstance(node, list) else 1


class _PagePartition(InputPartition):
    """A contiguous range of pages read by one task."""

    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first = first
        self.last = last


class _PagedReader(DataSourceReader):
    def __init__(self, options, fetch: Fetcher):
        self.fetch = fetch
        self.size = int(options.get("page_size", "100"))
        self.kind = options.get("pagination", "page")
        self.strict = options.get("strict", "false").lower() == "true"
        self.rate_limit = float(options.get("rate_limit", "0"))
        self.results_path = options.get("results_path", "")
        self.max_pages = int(options["max_pages"]) if options.get("max_pages") else None
        self.total_pages = int(options["total_pages"]) if options.get("total_pages") else None
        self.first_page = int(options.get("first_page", "1"))
        self.total_pages_field = options.get("total_pages_field", "")
        self.pages_per_partition = max(1, int(options.get("pages_per_partition", "1")))
        self.attempts = max(1, int(options.get("attempts", "3")))
        self.retry_wait = float(options.get("retry_wait", "0.2"))
        self.probe_span = 3

    def _offset(self, page: int) -> int:
        return (page - self.first_page) * self.size

    def _fetch(self, page: int) -> str | None:
        """A page's body; lenient mode tries again before it gives up."""
        for attempt in range(1 if self.strict else self.attempts):
            try:
                return self.fetch(page, self._offset(page), self.size)
            except Exception as e:
                failure = e
                if not self.strict and attempt + 1 < self.attempts:
                    time.sleep(self.retry_wait * (attempt + 1))
        raise failure

    def _nonempty(self, page: int) -> bool:
        """Whether the plan reaches this page.  Strict mode raises what the
        probe raised.  In lenient mode a page that cannot be fetched counts
        as there (its error row is written when it is read), unless the pages
        after it cannot be fetched either: then the end cannot be found."""
        for ahead in range(self.probe_span):
            try:
                found = _records_len(self._fetch(page + ahead), self.results_path) > 0
                return found if ahead == 0 else True
            except Exception as e:
                if self.strict:
                    raise
                failure = e
        raise RuntimeError(f"pages {page} to {page + self.probe_span - 1} cannot be fetched") from failure

    def _last_page(self) -> int:
        """Last page to plan: total, cap, or a doubling + binary search over
        single-page probes (O(log pages) small fetches on the driver)."""
        if self.total_pages is None and self.total_pages_field:
            # The API states its page count in the first page (page >= total stops).
            body = self._fetch(self.first_page)
            node = json.loads(body) if body else {}
            for part in self.total_pages_field.split("."):
                node = node.get(part) if isinstance(node, dict) else None
            if node is not None:
                self.total_pages = int(node)
        if self.total_pages is not None:
            last = self.first_page + self.total_pages - 1
            return min(last, self.first_page + self.max_pages - 1) if self.max_pages else last
        if self.kind not in ("page", "offset"):
            return self.first_page  # no pagination: a single request (M9)
        if not self._nonempty(self.first_page):
            return self.first_page
        lo, step = self.first_page, 1
        cap = self.first_page + self.max_pages - 1 if self.max_pages else None
        while True:
            hi = lo + step
            if cap is not None and hi > cap:
                hi = cap + 1
                if cap == lo or not self._nonempty(cap):
                    break
                return cap
            if not self._nonempty(hi):
                break
            lo, step = hi, step * 2
        while hi - lo > 1:  # lo non-empty, hi empty
            mid = (lo + hi) // 2
            if self._nonempty(mid):
                lo = mid
            else:
                hi = mid
        return lo

    def partitions(self):
        last = self._last_page()
        # A rate limit holds for the whole source, so one task makes all requests.
        step = max(1, last - self.first_page + 1) if self.rate_limit else self.pages_per_partition
        return [_PagePartition(p, min(p + step - 1, last)) for p in range(self.first_page, last + 1, step)]

    def read(self, partition):
        # Pages of one range are fetched in order; the rate limit applies
        # between requests of this task.
        for page in range(partition.first, partition.last + 1):
            if self.rate_limit:
                time.sleep(self.rate_limit)
            try:
                body = self._fetch(page)
            except Exception as e:  # A12
                if self.strict:
                    raise
                yield (page, None, f"error: {type(e).__name__}: {e}")
                continue
            if body is None:
                continue
            yield (page, body, "ok")


def paged_source(fetch: Fetcher, source_name: str = "quarry_paged") -> type[DataSource]:
    """Build a DataSource class bound to ``fetch`` (pickled to executors)."""

    class PagedJsonSource(DataSource):
        @classmethod
        def name(cls):
            return source_name

        def schema(self):
            return PAGE_SCHEMA

        def reader(self, schema):
            return _PagedReader(self.options, fetch)

    return PagedJsonSource


def read_pages(spark: SparkSession, fetch: Fetcher, **options) -> DataFrame:
    """A10: ``(page, body, status)`` rows, one input partition per range of pages."""
    from ..session import ship_code
    ship_code()
    # Sessions share registered names, so each call registers its own.
    src = paged_source(fetch, f"quarry_paged_{uuid.uuid4().hex}")
    spark.dataSource.register(src)
    return spark.read.format(src.name()).options(**{k: str(v) for k, v in options.items()}).load()


def _node_at(body: Column, results_path: str) -> Column:
    return F.get_json_object(body, "$." + results_path) if results_path else body


def explode_records(pages: DataFrame, record_schema: T.DataType | str, results_path: str = "",
                    body_col: str = "body", keep: tuple[str, ...] = ()) -> DataFrame:
    """Walk ``results_path`` (``a.b.c``) to the record list; a single
    object or scalar becomes one record; a missing path yields no rows."""
    if isinstance(record_schema, str):
        record_schema = T._parse_datatype_string(record_schema)
    node = _node_at(F.col(body_col), results_path)
    trimmed = F.ltrim(node)
    arr_text = (F.when(node.isNull(), F.lit("[]"))
                .when(trimmed.startswith("["), node)
                .otherwise(F.concat(F.lit("["), node, F.lit("]"))))
    recs = F.from_json(arr_text, T.ArrayType(record_schema))
    out = pages.select(*keep, F.explode(recs).alias("_rec"))
    if isinstance(record_schema, T.StructType):
        return out.select(*keep, "_rec.*")
    return out


def page_errors(pages: DataFrame) -> Column:
    """Aggregate counting failed pages (lenient mode)."""
    return F.count_if(F.col("status") != "ok")
