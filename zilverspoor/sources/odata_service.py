"""Reading entity sets from a live OData service, many pages at a time.

A Spark data source fetches page bodies on the executors; Spark parses them. How
a request reaches the service is up to the caller: a transport is any picklable
function from a relative URL to the response text, so authentication and proxies
stay outside.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from urllib.parse import quote, urlencode

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from zilverspoor.sources.odata import EntityType, parse_pages

Transport = Callable[[str], str]

# Fixed value: rows per request when nothing else is asked for.
PAGE_ROWS = 5_000
# Ranges that a whole-number key is cut into.
KEY_RANGES = 64
# Positions that probing asks for at most.
MOST_ROWS = 1 << 48


@dataclass(frozen=True)
class UrlTransport:
    """Plain HTTP transport; Spark repeats a task whose request fails."""

    base_url: str
    headers: dict[str, str] = field(default_factory=dict)
    timeout: int = 30

    def __call__(self, relative_url: str) -> str:
        url = relative_url
        if "://" not in relative_url:
            url = f"{self.base_url.rstrip('/')}/{relative_url}"
        request = urllib.request.Request(
            url, headers={"Accept": "application/json", **self.headers}
        )
        with urllib.request.urlopen(request, timeout=self.timeout) as response:
            return response.read().decode("utf-8")


def request_url(entity_set: str, **params: object) -> str:
    """Relative URL of a request; empty parameters are left out."""
    given = {f"${k}": str(v) for k, v in params.items() if v not in (None, "", 0)}
    path = "/".join(quote(step, safe="$") for step in entity_set.split("/"))
    return f"{path}?{urlencode(given, safe='$,', quote_via=quote)}" if given else path


class ServiceError(ValueError):
    """The service answers in a way that rows would be lost or repeated."""


@dataclass(frozen=True)
class Page:
    """Rows of a page body and the link to the next page."""

    rows: list
    link: str | None


def page_of(body: str) -> Page:
    """A page of either version; version 2 may give a bare list, which has no link."""
    page = json.loads(body)
    if "d" not in page:
        return Page(page.get("value") or [], page.get("@odata.nextLink"))
    page = page["d"]
    if isinstance(page, list):
        return Page(page, None)
    return Page(page.get("results") or [], page.get("__next"))


def count_rows(fetch: Transport, entity_set: str, condition: str | None) -> int | None:
    """What the service says the filtered set holds, ``None`` when it does not say."""
    try:
        return int(fetch(request_url(f"{entity_set}/$count", filter=condition)).strip("\ufeff \n"))
    except Exception:  # a service without counts answers with any kind of error
        return None


def probe_rows(row_at: Callable[[int], object]) -> int:
    """Size of a set whose service does not count, by asking for single rows.

    Doubling finds a position past the end and halving the end itself, so a set
    of a billion rows takes some sixty requests. Beyond ``MOST_ROWS`` the service
    is taken for one that answers any position.
    """
    if row_at(0) is None:
        return 0
    low, high = 0, 1
    while row_at(high) is not None:
        low, high = high, high * 2
        if high > MOST_ROWS:
            raise ServiceError(f"the service still has rows at position {low}")
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if row_at(middle) is not None else (low, middle)
    return high


class RowRange(InputPartition):
    """Rows from ``start``; ``length`` of them, or all that follow."""

    def __init__(self, start: int, length: int | None, links_only: bool = False):
        self.start = start
        self.length = length
        self.links_only = links_only


class PageReader(DataSourceReader):
    """Ranges of rows, each fetched by one task.

    What the service counts, or what probing finds, only says where ranges begin:
    the last one goes on until a page is empty and leads nowhere, so rows that
    the count lacks are read all the same. Positions mean something under one
    order only, so rows are asked for in key order.
    """

    def __init__(self, fetch: Transport, options: dict[str, str]):
        self.fetch = fetch
        self.entity_set = options["entityset"]
        self.select = options.get("select")
        self.expand = options.get("expand")
        self.condition = options.get("filter")
        self.order = options.get("orderby")
        self.page_rows = int(options.get("pagerows", PAGE_ROWS))
        self.pages_per_task = int(options.get("pagespertask", "20"))
        self.row_limit = int(options.get("rowlimit", "0"))
        self.links_only = options.get("linksonly", "false") == "true"

    def _row_at(self, position: int) -> object:
        """The row at a position, ``None`` beyond the last one."""
        url = request_url(
            self.entity_set,
            filter=self.condition,
            orderby=self.order,
            skip=position,
            top=1,
        )
        seen = set()
        while url is not None and url not in seen:
            seen.add(url)
            page = page_of(self.fetch(url))
            if page.rows:
                return page.rows[0]
            url = page.link  # an empty page may lead on
        return None

    def _ignores_positions(self) -> bool:
        """Whether the service gives the first row for other positions, too."""
        first = self._row_at(0)
        return first is not None and self._row_at(1) == first and self._row_at(2) == first

    def partitions(self) -> list[InputPartition]:
        limit = self.row_limit or None
        if self.links_only:
            return [RowRange(0, limit, True)]
        step = self.page_rows * self.pages_per_task
        if limit is not None and limit <= step:
            return [RowRange(0, limit)]
        if self._ignores_positions():
            # one task follows the links, as with a service that refuses positions
            return [RowRange(0, limit, True)]
        total = count_rows(self.fetch, self.entity_set, self.condition)
        if total is None:
            total = probe_rows(self._row_at)
        if limit is not None:
            total = min(total, limit)
        starts = list(range(0, max(1, total), step))
        ranges = [RowRange(start, step) for start in starts[:-1]]
        rest = None if limit is None else limit - starts[-1]
        return [*ranges, RowRange(starts[-1], rest)]

    def read(self, partition: RowRange) -> Iterator[tuple[str, int]]:
        """Page bodies of a range and the rows to take of each: a page is continued by its link, else by position."""
        done, link = 0, None
        seen: set[str] = set()
        while partition.length is None or done < partition.length:
            left = None if partition.length is None else partition.length - done
            if link is None:
                top = self.page_rows if left is None else min(self.page_rows, left)
                link = request_url(
                    self.entity_set,
                    select=self.select,
                    expand=self.expand,
                    filter=self.condition,
                    orderby=self.order,
                    skip=partition.start + done,
                    top=None if partition.links_only else top,
                )
            if link in seen:
                raise ServiceError(f"the service leads back to {link}")
            seen.add(link)
            body = self.fetch(link)
            page = page_of(body)
            if page.rows:
                # a link need not carry what was left of the range: no row beyond it
                rows = len(page.rows) if left is None else min(left, len(page.rows))
                yield body, rows
                done += rows
            link = page.link
            if link is None and (not page.rows or partition.links_only):
                return


class KeyRange(InputPartition):
    """Rows whose first key is at least ``start`` and below ``stop``; an end that is None is open."""

    def __init__(self, start: int | None, stop: int | None):
        self.start = start
        self.stop = stop


class KeysetReader(DataSourceReader):
    """Ranges of keys, each fetched by one task: every page asks for the keys beyond the last one.

    Unlike positions, keys don't move when rows come and go between two requests, so each row that
    is there all the time is read once. A whole-number key is cut into ranges of equal width first,
    and each cut is moved to the next key that exists, by asking for one row: gaps make no empty
    ranges. The last range is open, so later keys are read as well. Other keys are one range.
    """

    def __init__(self, fetch: Transport, options: dict[str, str]):
        self.fetch = fetch
        self.entity_set = options["entityset"]
        self.expand = options.get("expand")
        self.condition = options.get("filter")
        self.kinds = json.loads(options["keys"])  # name and literal form, in key order
        select = options.get("select")
        self.select = select and ",".join(dict.fromkeys([*_names(select), *self.kinds]))
        self.page_rows = int(options.get("pagerows", PAGE_ROWS))
        self.ranges = int(options.get("ranges", KEY_RANGES))
        self.row_limit = int(options.get("rowlimit", "0"))

    def _literal(self, key: str, value: object) -> str:
        if self.kinds[key] == "text":
            return "'" + str(value).replace("'", "''") + "'"
        return str(value)

    def _beyond(self, last: list) -> str:
        """Keys after the given ones in their common order."""
        keys, cases = list(self.kinds), []
        for i, key in enumerate(keys):
            same = [f"{k} eq {self._literal(k, v)}" for k, v in zip(keys[:i], last)]
            cases.append(" and ".join([*same, f"{key} gt {self._literal(key, last[i])}"]))
        return cases[0] if len(cases) == 1 else " or ".join(f"({c})" for c in cases)

    def _url(self, conditions: list[str], top: int, select: str | None, descending: bool = False) -> str:
        given = [c for c in [self.condition, *conditions] if c]
        return request_url(
            self.entity_set,
            select=select,
            expand=self.expand if select == self.select else None,
            filter=" and ".join(f"({c})" for c in given) if len(given) > 1 else "".join(given),
            orderby=",".join(f"{k} desc" if descending else k for k in self.kinds),
            top=top,
        )

    def _key_of(self, row: dict) -> list:
        try:
            return [row[k] for k in self.kinds]
        except (KeyError, TypeError) as error:
            raise ServiceError(f"a row of {self.entity_set} lacks its key") from error

    def _first_key(self, conditions: list[str], descending: bool = False) -> int | None:
        page = self._page(self._url(conditions, 1, ",".join(self.kinds), descending))[1]
        return self._key_of(page.rows[0])[0] if page.rows else None

    def _page(self, url: str) -> tuple[str, Page]:
        """A page; an empty one may lead on."""
        seen = set()
        while True:
            body = self.fetch(url)
            page = page_of(body)
            if page.rows or page.link is None or page.link in seen:
                return body, page
            seen.add(url := page.link)

    def partitions(self) -> list[InputPartition]:
        key = next(iter(self.kinds))
        if self.row_limit or len(self.kinds) > 1 or self.kinds[key] != "whole":
            return [KeyRange(None, None)]
        low, high = self._first_key([]), self._first_key([], descending=True)
        if low is None or high is None:
            return [KeyRange(None, None)]
        low, high = int(low), int(high)
        step = max(1, -(-(high - low + 1) // self.ranges))
        found = (self._first_key([f"{key} ge {at}"]) for at in range(low + step, high + 1, step))
        cuts = sorted({int(c) for c in found if c is not None})
        return [KeyRange(a, b) for a, b in zip([None, *cuts], [*cuts, None])]

    def read(self, partition: KeyRange) -> Iterator[tuple[str, int]]:
        key = next(iter(self.kinds))
        inside = [f"{key} lt {partition.stop}"] if partition.stop is not None else []
        since = [f"{key} ge {partition.start}"] if partition.start is not None else []
        done = 0
        while not self.row_limit or done < self.row_limit:
            left = self.row_limit - done if self.row_limit else self.page_rows
            body, page = self._page(self._url([*since, *inside], min(left, self.page_rows), self.select))
            rows = page.rows[:left] if self.row_limit else page.rows
            if not rows:
                return
            last = self._key_of(rows[-1])
            again = self._beyond(last)
            if since == [again]:
                raise ServiceError(f"the service gives rows of {self.entity_set} again after {last}")
            yield body, len(rows)
            done += len(rows)
            since = [again]


def _names(select: str) -> list[str]:
    return [name.strip() for name in select.split(",") if name.strip()]


def key_kinds(entity: EntityType, version: str) -> dict[str, str]:
    """How the keys of an entity are written in a condition."""
    kinds = {}
    for key in entity.keys:
        kind = entity.properties.get(key)
        if isinstance(kind, T.IntegralType):
            kinds[key] = "whole"
        elif isinstance(kind, T.StringType):
            kinds[key] = "text"
        elif version == "v4" and isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)):
            kinds[key] = "plain"
        else:
            raise ServiceError(f"{entity.name} cannot be paged by its key {key}")
    if not kinds:
        raise ServiceError(f"{entity.name} has no key to page by")
    return kinds


def page_source(fetch: Transport) -> type[DataSource]:
    """A data source named ``odata_pages`` that fetches through the transport."""

    class PageSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "odata_pages"

        def schema(self) -> str:
            return "body string, keep int"

        def reader(self, schema) -> DataSourceReader:
            by_key = "keys" in self.options
            return (KeysetReader if by_key else PageReader)(fetch, dict(self.options))

    return PageSource


def read_service(
    spark: SparkSession,
    fetch: Transport,
    entity_set: str,
    entity: EntityType,
    version: str = "v4",
    select: str | None = None,
    expand: str | None = None,
    condition: str | None = None,
    row_limit: int = 0,
    page_rows: int = PAGE_ROWS,
    pages_per_task: int = 20,
    links_only: bool = False,
    order: str | None = None,
    by_key: bool = False,
) -> DataFrame:
    """Rows of an entity set.

    The set is cut into ranges of pages, by the service's count or by probing,
    and every task fetches one range. ``links_only`` is for services that refuse
    ``$skip``: there one task has to follow the links, a page at a time; services
    that ignore it are found out. ``by_key`` asks for ranges of keys instead of
    positions, for services that refuse positions or change while they are read.
    The condition is the service's own ``$filter`` text, the order its keys unless
    ``order`` names another (empty: none).
    """
    spark.dataSource.register(page_source(fetch))
    options = {
        "entitySet": entity_set,
        "select": select,
        "expand": expand,
        "filter": condition,
        "orderBy": ",".join(entity.keys) if order is None else order,
        "pageRows": str(page_rows),
        "pagesPerTask": str(pages_per_task),
        "rowLimit": str(row_limit),
        "linksOnly": str(links_only).lower(),
        "keys": json.dumps(key_kinds(entity, version)) if by_key else None,
    }
    bodies = (
        spark.read.format("odata_pages")
        .options(**{k: v for k, v in options.items() if v is not None})
        .load()
    )
    return parse_pages(bodies, entity, version, select, expand, row_limit=row_limit)
