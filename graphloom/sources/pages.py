"""Recorded listing pages and answers: a Python data source with one partition of reading for each
stream, and lookups of single records."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from graphloom.functions.devalue import route_result, unwrap_date
from graphloom.sources import objects

ITEM = (
    "stream string, page int, position int, artifact_id string, post_id string, author_id string, author string, published_at string, "
    "tool_ids array<int>, has_meta boolean, type string, url string, name string, tags array<string>, stats map<string,bigint>"
)
#: Answers that mean that the server wants a credential or will not serve us at all.
REFUSED = (401, 403)


class AuthRequired(RuntimeError):
    """The source refused; that is no missing record and must not pass as one."""


class _Stream(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


def item_row(stream: str, page: int, position: int, item: dict) -> tuple:
    """One listing item as a row of ITEM; anything missing or of a strange type is null or empty, and
    statistics are cut to whole numbers."""
    user = item.get("user") if isinstance(item.get("user"), dict) else {}
    stats = item.get("stats") if isinstance(item.get("stats"), dict) else {}
    text = lambda v: None if v is None or v == "" else str(v)
    return (
        stream, page, position, text(item.get("id")), text(item.get("postId")), text(item.get("userId")), text(user.get("username") or item.get("username")),
        unwrap_date(item.get("publishedAt")) or unwrap_date(item.get("createdAt")),
        [t for t in item.get("toolIds") or [] if isinstance(t, int)], bool(item.get("hasMeta")), text(item.get("type")),
        text(item.get("url")), text(item.get("name")), [str(t) for t in item.get("tagIds") or []],
        {k: int(v) for k, v in stats.items() if isinstance(v, (int, float)) and v == v and abs(v) < 2**63},
    )


def page_content(body: bytes, form: str) -> tuple[list, str | None]:
    """(items, cursor of the next page or None) of one page: a route's response, flattened or plain
    (``route``), or a plain listing with its cursor in ``metadata`` (``rest``)."""
    if form == "rest":
        data = json.loads(body)
        following = (data.get("metadata") or {}).get("nextCursor")
    else:
        data = route_result(body) or {}
        following = data.get("nextCursor")
    return [i for i in data.get("items") or [] if isinstance(i, dict)], None if following in (None, "") else str(following)


class PageReader(DataSourceReader):
    def __init__(self, options):
        self.root, self.form = options["path"], options.get("form", "route")
        self.limit = int(options.get("limit", 0)) or None
        self.pages = int(options.get("pages", 0)) or None
        self.cursor = options.get("cursor", "0")
        self.tools = {int(t) for t in options.get("tools", "").split(",") if t.strip()}
        self.streams = {s.strip() for s in options.get("streams", "").split(",") if s.strip()}

    def partitions(self):
        system, base = objects.open_root(self.root)
        found = [n for n in objects.names(system, base) if not self.streams or n in self.streams]
        return [_Stream(name) for name in found]

    def read(self, partition):
        system, base = objects.open_root(self.root)
        cursor: str | None = self.cursor
        page = given = 0
        while cursor is not None and (self.pages is None or page < self.pages):
            body = objects.get(system, f"{base}/{partition.path}/{cursor}.json")
            if body is None:
                return
            items, cursor = page_content(body, self.form)
            if not items:
                return
            for position, item in enumerate(items):
                if self.tools and not self.tools & {t for t in item.get("toolIds") or [] if isinstance(t, int)}:
                    continue
                yield item_row(partition.path, page, position, item)
                given += 1
                if self.limit is not None and given >= self.limit:
                    return
            page += 1


class RecordedPages(DataSource):
    """``path``, of any file system that ``sources.objects`` knows, is a folder with one folder a stream
    (the tip, or a user); page ``0.json`` comes first and each page names the next. Options: ``form``
    (route, rest), ``streams`` and ``tools`` to read only those, ``limit`` items a stream, ``cursor`` to
    begin at and ``pages`` to read of each. A page without items ends its stream."""

    @classmethod
    def name(cls) -> str:
        return "recorded_pages"

    def schema(self) -> str:
        return ITEM

    def reader(self, schema) -> DataSourceReader:
        return PageReader(self.options)


def write_pages(root: str, stream: str, pages: list[list[dict]], form: str = "route") -> None:
    """Record pages, as a test or an offline run needs them; routes in the flattened form."""
    from graphloom.functions.devalue import encode

    system, base = objects.open_root(root)
    for number, items in enumerate(pages):
        following = number + 1 if number + 1 < len(pages) else None
        if form == "rest":
            body = {"items": items, "metadata": {"nextCursor": following}}
        else:
            body = {"result": {"data": encode({"items": items, "nextCursor": following})}}
        objects.put(system, f"{base}/{stream}/{number}.json", json.dumps(body).encode())


# --- single records -------------------------------------------------------------------------

LOOKUP = "artifact_id string, status int, record string"


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        records = []
        for status, body in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            try:
                found = route_result(body) if status == 200 and body is not None else None
            except (ValueError, KeyError, TypeError, IndexError, RecursionError):
                found = None
            records.append(json.dumps(found) if isinstance(found, dict) else None)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(records, pa.string())], names=["artifact_id", "status", "record"])


def lookup_records(ids: DataFrame, answers: DataFrame) -> DataFrame:
    """Rows of LOOKUP for each of ``ids`` (artifact_id, distinct): the record in its answer (artifact_id,
    status, body), null where there is none, where it is no object or where the answer was an error.
    An id without an answer has status 404. Refusals keep their status: see :func:`refuse`."""
    asked = ids.select("artifact_id").join(answers.select("artifact_id", "status", "body"), "artifact_id", "left")
    return asked.select("artifact_id", F.coalesce("status", F.lit(404)).alias("status"), "body").mapInArrow(_bodies, LOOKUP)


def refuse(found: DataFrame) -> DataFrame:
    """``found`` as it is, or AuthRequired if one of its answers is a refusal."""
    if not found.filter(F.col("status").isin(*REFUSED)).isEmpty():
        raise AuthRequired("the source refused (401 or 403); give it a credential")
    return found


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: dict[str, list] = {"workflow": [], "prompt": []}
        for text in batch.column(1).to_pylist():
            held = json.loads(text) if text is not None else {}
            meta = held.get("meta") if isinstance(held.get("meta"), dict) else {}
            inner = meta.get(API_FIELD)
            try:
                inner = json.loads(inner) if isinstance(inner, str) else inner
            except (ValueError, RecursionError):
                inner = None
            for kind, values in out.items():
                value = inner.get(kind) if isinstance(inner, dict) else None
                values.append(None if value is None else json.dumps(value))
        yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, pa.string()) for v in out.values()]], names=["artifact_id", *out])


#: Fixed value: where a generation record keeps the graphs, as an object or as its JSON.
API_FIELD = "comfy"


def generation_documents(found: DataFrame) -> DataFrame:
    """(artifact_id, workflow, prompt): the graphs in generation records, as JSON; null if not there."""
    return found.select("artifact_id", "record").mapInArrow(_documents, "artifact_id string, workflow string, prompt string")
