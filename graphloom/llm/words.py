"""Words as the overlap operators count them."""

from __future__ import annotations

import re
import unicodedata

import regex

_ASCII = re.compile(r"[a-z0-9]+")
_WORD = regex.compile(r"[\p{L}\p{Nd}]+")
_FORMAT = regex.compile(r"\p{Cf}+")


def words(text: str | None) -> list[str]:
    """Maximal runs of Unicode letters and digits after NFKC, removal of format characters and
    lower-casing; [] for null."""
    if not text:
        return []
    if text.isascii():
        return _ASCII.findall(text.lower())
    return _WORD.findall(_FORMAT.sub("", unicodedata.normalize("NFKC", text)).lower())
