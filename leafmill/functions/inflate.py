"""Undoing a content encoding that was left on a body."""

from __future__ import annotations

import gzip
import zlib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.session import ship_code

try:
    import brotli
except ImportError:
    brotli = None

GZIP_MAGIC = b"\x1f\x8b"


def _inflate(body: bytes, encoding: str) -> bytes | None:
    """The plain body, or None when it is not encoded that way."""
    try:
        if body[:2] == GZIP_MAGIC or encoding == "gzip":
            return gzip.decompress(body)
        if encoding == "deflate":
            try:
                return zlib.decompress(body)
            except zlib.error:
                return zlib.decompress(body, -zlib.MAX_WBITS)
        if encoding == "br" and brotli is not None:
            return brotli.decompress(body)
    except Exception:
        pass
    return None


def inflated(body: Column, encoding: Column) -> Column:
    """Plain bodies; null in, or a body that cannot be inflated, gives null."""
    ship_code()

    @F.arrow_udf("binary")
    def inflate(bodies: pa.Array, encodings: pa.Array) -> pa.Array:
        pairs = zip(bodies.to_pylist(), encodings.to_pylist())
        return pa.array([None if b is None else _inflate(b, e or "") for b, e in pairs], pa.binary())

    return inflate(body, encoding)
