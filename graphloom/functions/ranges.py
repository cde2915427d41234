"""Planning of byte ranges: how much of a file is read to get at its graph.

The plan is a pure function of a reader, so it runs on a stored file as on a server.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from graphloom.functions.containers import DOCUMENTS, Extract, parse

KIB = 1024
#: Ends of the first parts read one after the other.
FIRST_ENDS = (128 * KIB, 512 * KIB)
LAST_PART = 128 * KIB

#: (first byte, last byte or None for the last part) -> bytes
Reader = Callable[[int, int], bytes]


@dataclass
class Capture:
    channel: str = "bytes_head"
    container: str | None = None
    total_size: int = 0
    bytes_fetched: int = 0
    needed_bytes: int | None = None
    windows: list[int] = field(default_factory=list)
    from_tail: bool = False
    workflow: str | None = None
    prompt: str | None = None


def _fill(capture: Capture, found: Extract) -> bool:
    """Take what is still missing; whether anything was."""
    gained = False
    for kind in DOCUMENTS:
        if getattr(capture, kind) is None and kind in found.documents:
            setattr(capture, kind, found.documents[kind])
            gained = True
    return gained


def capture_file(content: bytes) -> Capture:
    """Read a stored file the way it would be fetched: first parts until the graph is there, the
    data ends or the last bound is met, then the last part where the container keeps its graph
    there."""
    capture = Capture(total_size=len(content))
    data = b""
    for end in FIRST_ENDS:
        part = content[len(data) : end]
        data += part
        capture.bytes_fetched += len(part)
        capture.windows.append(len(part))
        quick = parse(data, past_image=False)
        capture.container, capture.needed_bytes = quick.container, quick.until
        _fill(capture, quick)
        _fill(capture, parse(data))
        if quick.graph_last or not quick.ran_out or capture.workflow is not None or len(data) >= len(content):
            break
    kept_last = capture.container is not None and (capture.container.startswith("isobmff") or capture.container == "webp")
    if kept_last and capture.workflow is None and len(content) > LAST_PART:
        tail = content[-LAST_PART:]
        capture.bytes_fetched += len(tail)
        capture.from_tail = _fill(capture, parse(tail))
        if capture.from_tail:
            capture.channel = "bytes_tail"
    return capture


def wants_api(workflow, has_meta):
    """Whether the dearer channel can pay: no graph in the bytes, and the listing says there is one. The
    flag may be a column; a null one says nothing."""
    if isinstance(has_meta, Column):
        return F.coalesce(has_meta, F.lit(False)) if workflow is None else F.lit(False)
    return workflow is None and bool(has_meta)
