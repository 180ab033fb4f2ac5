"""A container file of named blobs (statistics sketches, deletion vectors).

Form: magic, blobs, footer. The footer is magic, a JSON document, its size
(4 bytes, little-endian), flags (4 bytes; the lowest bit says that the document
is compressed) and magic.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Sequence

import zstandard

#: Fixed values of the form.
MAGIC = b"PFA1"
_TAIL = 12


def write_blobs(blobs: Sequence[dict], properties: dict[str, str] | None = None, compress: bool = False) -> bytes:
    """A container. A blob has type, fields, snapshot-id, sequence-number, data (bytes) and perhaps properties."""
    out, told = bytearray(MAGIC), []
    for b in blobs:
        if not b.get("type") or b.get("fields") is None:
            raise ValueError("a blob needs a type and fields")
        data = zstandard.ZstdCompressor().compress(b["data"]) if compress else bytes(b["data"])
        told.append({"type": b["type"], "fields": [*b["fields"]], "snapshot-id": b.get("snapshot-id", -1), "sequence-number": b.get("sequence-number", -1), "offset": len(out), "length": len(data)} | ({"compression-codec": "zstd"} if compress else {}) | ({"properties": b["properties"]} if b.get("properties") else {}))
        out += data
    foot = json.dumps({"blobs": told} | ({"properties": properties} if properties else {})).encode()
    return bytes(out + MAGIC + foot + struct.pack("<II", len(foot), 0) + MAGIC)


def read_footer(raw: bytes) -> dict:
    """The footer of a container; an error if it is none or damaged."""
    if len(raw) < 2 * len(MAGIC) + _TAIL or raw[:4] != MAGIC or raw[-4:] != MAGIC:
        raise ValueError("no blob container")
    size, flags = struct.unpack("<II", raw[-_TAIL:-4])
    at = len(raw) - _TAIL - size
    if at < 8 or raw[at - 4 : at] != MAGIC or flags & ~1:
        raise ValueError("a blob container is damaged")
    if flags & 1:
        raise ValueError("compressed footers are not read")
    foot = json.loads(raw[at : len(raw) - _TAIL])
    for b in foot["blobs"]:
        if b["offset"] < 4 or b["length"] < 0 or b["offset"] + b["length"] > at - 4:
            raise ValueError("a blob lies outside its container")
    return foot


def read_blobs(raw: bytes) -> list[dict]:
    """All blobs, with their data."""
    out = []
    for b in read_footer(raw)["blobs"]:
        data, codec = raw[b["offset"] : b["offset"] + b["length"]], b.get("compression-codec")
        if codec not in (None, "zstd"):
            raise ValueError(f"unknown compression {codec!r}")
        out.append(b | {"data": zstandard.ZstdDecompressor().decompressobj().decompress(data) if codec else data})
    return out
