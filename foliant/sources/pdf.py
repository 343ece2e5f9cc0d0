"""Text of a PDF's first page with the standard library alone: enough for headers, names and addresses."""

from __future__ import annotations

import re
import zlib

_STREAM = re.compile(rb"<<(.*?)>>\s*stream\r?\n(.*?)\r?\nendstream", re.DOTALL)
_SHOWN = re.compile(rb"\[((?:[^\[\]\\]|\\.)*)\]\s*TJ|\(((?:[^()\\]|\\.)*)\)\s*(?:Tj|')|(T\*|Td|TD|ET)", re.DOTALL)
_STRING = re.compile(rb"\(((?:[^()\\]|\\.)*)\)|(-?\d+(?:\.\d+)?)", re.DOTALL)
_ESCAPE = re.compile(rb"\\([0-7]{1,3}|.)", re.DOTALL)


def _plain(raw: bytes) -> str:
    names = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"", b"f": b""}

    def one(m: re.Match) -> bytes:
        x = m[1]
        return bytes([int(x, 8) & 255]) if x[:1].isdigit() else names.get(x, x)

    return _ESCAPE.sub(one, raw).decode("latin-1")


def first_page(content: bytes) -> tuple[str, str]:
    """(author of the metadata, text of the first content stream that shows text)."""
    author = re.search(rb"/Author\s*\(((?:[^()\\]|\\.)*)\)", content)
    for head, body in _STREAM.findall(content):
        if b"FlateDecode" in head:
            try:
                body = zlib.decompress(body)
            except zlib.error:
                continue
        if b"BT" not in body:
            continue
        out: list[str] = []
        for listed, single, move in _SHOWN.findall(body):
            if move:
                out.append("\n" if move != b"ET" else " ")
            elif listed:
                # Wide gaps between pieces of a shown list are spaces.
                out += [_plain(s) if s or not gap else (" " if float(gap) < -200 else "") for s, gap in _STRING.findall(listed)]
            else:
                out.append(_plain(single))
        if text := re.sub(r"[ \t]+", " ", "".join(out)).strip():
            return (_plain(author[1]) if author else ""), text
    return (_plain(author[1]) if author else ""), ""
