"""Documents (as JSON text) to BSON bytes."""

from __future__ import annotations

import json
import struct
from typing import Any

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _element(name: str, value: Any) -> bytes:
    key = name.encode("utf-8") + b"\0"
    if value is None:
        return b"\x0a" + key
    if isinstance(value, bool):
        return b"\x08" + key + bytes([value])
    if isinstance(value, int):
        if -(1 << 31) <= value < 1 << 31:
            return b"\x10" + key + struct.pack("<i", value)
        if -(1 << 63) <= value < 1 << 63:
            return b"\x12" + key + struct.pack("<q", value)
        value = float(value)
    if isinstance(value, float):
        return b"\x01" + key + struct.pack("<d", value)
    if isinstance(value, str):
        raw = value.encode("utf-8") + b"\0"
        return b"\x02" + key + struct.pack("<i", len(raw)) + raw
    if isinstance(value, dict):
        return b"\x03" + key + document(value)
    return b"\x04" + key + document({str(i): v for i, v in enumerate(value)})


def document(value: dict[str, Any]) -> bytes:
    body = b"".join(_element(k, v) for k, v in value.items())
    return struct.pack("<i", len(body) + 5) + body + b"\0"


@F.pandas_udf(T.BinaryType())
def bson_bytes(text: pd.Series) -> pd.Series:
    """BSON of JSON objects; null stays null."""
    return text.map(lambda t: None if t is None else document(json.loads(t)))
