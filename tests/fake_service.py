"""A paged service in memory, importable by Spark's Python workers."""

import json
from dataclasses import dataclass
from urllib.parse import parse_qs, unquote, urlparse


@dataclass
class FakeService:
    """Answers requests from a list of rows, without any network.

    The options are habits of real services: a wrong count (``said``), an empty page
    in front of a position, links without the rest of the range, positions that are
    ignored, rows in another order at each position unless an order is asked for, and
    a bare list in version 2.
    """

    size: int
    server_page: int | None = None
    counts: bool = True
    version: str = "v4"
    said: int | None = None
    empty_before: int | None = None
    forgets: bool = False
    ignores_skip: bool = False
    shuffles: bool = False
    bare: bool = False

    def __call__(self, url):
        parsed = urlparse(url)
        params = {k: v[0] for k, v in parse_qs(parsed.query).items()}
        if unquote(parsed.path).endswith("/$count"):
            if not self.counts:
                raise RuntimeError("501")
            return str(self.size if self.said is None else self.said)
        at = "$skiptoken" if self.ignores_skip else "$skip"
        skip = int(params.get(at, 0))
        top = int(params.get("$top", self.size))
        if self.ignores_skip:
            top = self.size
        asked = max(0, min(top, self.size - skip))
        given = max(0, min(asked, self.server_page or asked))
        if self.empty_before == skip and "empty" not in params:
            return self.page([], f"Items?$skip={skip}&$top={top}&empty=1")
        rows = list(range(skip, skip + given))
        if self.shuffles and "$orderby" not in params:
            rows = [(r * 7 + skip) % self.size for r in rows]
        link = None
        if given < asked:
            link = f"Items?{at}={skip + given}"
            if "$top" in params and not self.forgets:
                link += f"&$top={top - given}"
        return self.page([{"id": i, "value": f"v{i}"} for i in rows], link)

    def page(self, rows, link):
        if self.version == "v2":
            page = {"results": rows} | ({"__next": link} if link else {})
            return json.dumps({"d": rows if self.bare else page})
        return json.dumps({"value": rows} | ({"@odata.nextLink": link} if link else {}))


@dataclass
class ChangingService:
    """Rows with keys that come while it is read: each request finds more of them, also before it.

    It answers conditions on its keys only and refuses positions, unless ``positions`` is given.
    Requests are counted in a file, as they come from many processes. Keys in ``always`` are there
    from the begin to the end.
    """

    always: list
    later: list
    counter: str
    keys: tuple = ("id",)
    positions: bool = False
    server_page: int = 1000

    def __call__(self, url):
        params = {k: v[0] for k, v in parse_qs(urlparse(url).query).items()}
        with open(self.counter, "ab") as out:
            out.write(b"x")
            n = out.tell()
        if "$skip" in params and not self.positions:
            raise RuntimeError("501")
        rows = [self.row(k) for k in [*self.always, *self.later[: 3 * n]]]
        if "$filter" in params:
            test = params["$filter"]
            for name, sign in ((" eq ", " == "), (" gt ", " > "), (" ge ", " >= "), (" lt ", " < ")):
                test = test.replace(name, sign)
            rows = [r for r in rows if eval(test.replace("''", "\\'"), {}, dict(r))]
        order = params.get("$orderby", "")
        rows.sort(key=lambda r: tuple(r[k] for k in self.keys), reverse=order.endswith(" desc"))
        skip = int(params.get("$skip", 0))
        top = min(int(params.get("$top", len(rows))), self.server_page)
        return json.dumps({"value": rows[skip : skip + top]})

    def row(self, key):
        key = key if isinstance(key, tuple) else (key,)
        return dict(zip(self.keys, key)) | {"value": "v" + "-".join(map(str, key))}
