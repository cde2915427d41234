"""Small files of every container with given texts in them, for queries and tests: no table has files."""

from __future__ import annotations

import json
import struct
import zlib

from graphloom.functions.containers import PNG_SIGNATURE
from graphloom.functions.ranges import LAST_PART


def png_file(texts: dict[str, str], kind: str = "tEXt", padding: int = 0) -> bytes:
    """A small PNG with text chunks behind the header."""
    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body))

    parts = [PNG_SIGNATURE, chunk(b"IHDR", bytes(13))]
    for key, text in texts.items():
        raw, head = text.encode(), key.encode() + b"\0"
        body = {"tEXt": head + raw, "zTXt": head + b"\0" + zlib.compress(raw), "iTXt": head + b"\1\0\0\0" + zlib.compress(raw)}[kind]
        parts.append(chunk(kind.encode(), body))
    return b"".join([*parts, chunk(b"IDAT", bytes(padding)), chunk(b"IEND", b"")])


def exif_blob(texts: dict[str, str], order: str = "<") -> bytes:
    """A TIFF directory of ASCII entries ``key:value``."""
    tags = [0x010F, 0x0110, 0x010E][: len(texts)]
    values = [f"{k}:{v}".encode() + b"\0" for k, v in texts.items()]
    at = 8 + 2 + 12 * len(values) + 4
    entries = b""
    for tag, value in zip(tags, values, strict=True):
        entries += struct.pack(f"{order}HHII", tag, 2, len(value), at)
        at += len(value)
    head = (b"II" if order == "<" else b"MM") + struct.pack(f"{order}HI", 42, 8)
    return head + struct.pack(f"{order}H", len(values)) + entries + bytes(4) + b"".join(values)


def webp_file(texts: dict[str, str], padding: int = 0) -> bytes:
    def chunk(tag: bytes, body: bytes) -> bytes:
        return tag + struct.pack("<I", len(body)) + body + b"\0" * (len(body) % 2)

    body = chunk(b"VP8X", b"\x08" + bytes(9)) + chunk(b"VP8 ", bytes(padding)) + chunk(b"EXIF", exif_blob(texts))
    return b"RIFF" + struct.pack("<I", len(body) + 4) + b"WEBP" + body


def jpeg_file(texts: dict[str, str]) -> bytes:
    body = b"Exif\0\0" + exif_blob(texts, ">")
    return b"\xff\xd8\xff\xe1" + struct.pack(">H", len(body) + 2) + body + b"\xff\xda\0\x02"


def movie_file(texts: dict[str, str], padding: int = 0, last: bool = True) -> bytes:
    """Boxes with both documents in one comment, the movie box last or first."""
    def box(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body) + 8) + tag + body

    data = box(b"data", struct.pack(">II", 1, 0) + json.dumps(texts).encode())
    movie = box(b"moov", box(b"udta", box(b"meta", bytes(4) + box(b"ilst", box(b"\xa9cmt", data)))))
    media = box(b"mdat", bytes(padding))
    return box(b"ftyp", b"isom" + bytes(4)) + (media + movie if last else movie + media)


def build_file(kind: str, document: str) -> bytes:
    texts = {"workflow": document}
    builders = {
        "png": lambda: png_file(texts, "tEXt"), "png-z": lambda: png_file(texts, "zTXt"), "png-i": lambda: png_file(texts, "iTXt"),
        "webp": lambda: webp_file(texts, LAST_PART), "jpeg": lambda: jpeg_file(texts), "isobmff": lambda: movie_file(texts, 2 * LAST_PART),
    }
    return builders[kind]()


KINDS = ("png", "png-z", "png-i", "webp", "jpeg", "isobmff")
