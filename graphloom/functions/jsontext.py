"""Decoding of untrusted JSON text and walks over it; nothing here raises on bad input."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from json.decoder import scanstring
from typing import Any

_BLANK = re.compile(r"[ \t\n\r]*")
_SCALAR = re.compile(r"-?Infinity|NaN|true|false|null|-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?")


def decode(text: str | None) -> Any:
    """The value of a JSON text, however deep it is nested; None if it is null, blank, cut off or
    not JSON."""
    if not text:
        return None
    try:
        return json.loads(text)
    except RecursionError:
        pass
    except ValueError:
        return None
    try:
        return _decode_deep(text)
    except (ValueError, IndexError):
        return None


def _decode_deep(text: str) -> Any:
    """JSON without recursion, for texts deeper than the interpreter's own decoder goes. Open
    containers wait on a stack, each with the key that its next value belongs to."""
    root: list = []
    waiting: list[tuple[Any, str | None]] = [(root, None)]
    at = _BLANK.match(text).end()

    def put(value: Any) -> None:
        holder, key = waiting[-1]
        if isinstance(holder, list):
            holder.append(value)
        else:
            holder[key] = value

    def name(at: int) -> int:
        """Read a key and its colon into the open object."""
        if text[at] != '"':
            raise ValueError("a key must be a string")
        key, at = scanstring(text, at + 1)
        at = _BLANK.match(text, at).end()
        if text[at] != ":":
            raise ValueError("no colon behind a key")
        waiting[-1] = (waiting[-1][0], key)
        return _BLANK.match(text, at + 1).end()

    while True:
        sign = text[at]
        if sign in "{[":
            value: Any = {} if sign == "{" else []
            put(value)
            at = _BLANK.match(text, at + 1).end()
            if text[at] != ("}" if sign == "{" else "]"):
                waiting.append((value, None))
                at = name(at) if sign == "{" else at
                continue
            at += 1
        elif sign == '"':
            value, at = scanstring(text, at + 1)
            put(value)
        else:
            found = _SCALAR.match(text, at)
            if found is None:
                raise ValueError("no value")
            put(json.loads(found.group()))
            at = found.end()
        # behind a value: close what ends here, then go on in what is still open
        while True:
            at = _BLANK.match(text, at).end()
            if len(waiting) == 1:
                if at != len(text):
                    raise ValueError("text behind the value")
                return root[0]
            holder = waiting[-1][0]
            if text[at] == ("]" if isinstance(holder, list) else "}"):
                waiting.pop()
                at += 1
                continue
            if text[at] != ",":
                raise ValueError("no comma between values")
            at = _BLANK.match(text, at + 1).end()
            at = at if isinstance(holder, list) else name(at)
            break


def encode(value: Any, **options: Any) -> str:
    """JSON of a value, however deep: what the interpreter cannot write by recursion is written from
    a work list, without blanks."""
    try:
        return json.dumps(value, **options)
    except RecursionError:
        pass
    out: list[str] = []
    todo: list[Any] = [value]
    raw = object()  # marks text that is to be written as it is
    while todo:
        item = todo.pop()
        if isinstance(item, tuple) and item[0] is raw:
            out.append(item[1])
        elif isinstance(item, dict):
            inner: list[Any] = [(raw, "{")]
            for number, (key, own) in enumerate(item.items()):
                inner += [(raw, ("," if number else "") + json.dumps(key) + ":"), own]
            todo += [*inner, (raw, "}")][::-1]
        elif isinstance(item, list):
            inner = [(raw, "[")]
            for number, own in enumerate(item):
                inner += [(raw, ","), own] if number else [own]
            todo += [*inner, (raw, "]")][::-1]
        else:
            out.append(json.dumps(item))
    return "".join(out)


def decode_object(text: str | None) -> dict | None:
    """The object of a JSON text, decoded once more if it is a string; None for all else."""
    value = decode(text)
    if isinstance(value, str):
        value = decode(value)
    return value if isinstance(value, dict) else None


def kind(value: Any) -> str:
    """string, number, boolean or array."""
    if isinstance(value, str):
        return "string"
    if isinstance(value, bool):
        return "boolean"
    return "array" if isinstance(value, list) else "number"


def fields(obj: dict) -> Iterator[tuple[str, Any]]:
    """(dotted path, value) of everything in an object that is neither an object nor null."""
    stack: list[tuple[str, dict]] = [("", obj)]
    while stack:
        prefix, current = stack.pop()
        for key, value in current.items():
            if isinstance(value, dict):
                stack.append((f"{prefix}{key}.", value))
            elif value is not None:
                yield prefix + key, value


def value_text(value: Any, longest: int = 80) -> str:
    """Text that is the same for equal values of one type and for 1 and 1.0; long texts by
    their digest."""
    if isinstance(value, str):
        text = "s" + value
    elif isinstance(value, float) and value.is_integer() and abs(value) < 1e16:
        text = str(int(value))
    else:
        text = encode(value, sort_keys=True, separators=(",", ":"))
    if len(text) > longest:
        return "#" + hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()
    return clean(text)


def clean(text: str) -> str:
    """Without lone surrogates, which JSON can express and UTF-8 cannot."""
    return text if text.isascii() else text.encode("utf-8", "replace").decode("utf-8")


def plain(value: Any) -> str:
    """A scalar as text: strings as they are, null as '', the rest as JSON."""
    if isinstance(value, str):
        return clean(value)
    return "" if value is None else encode(value)
