"""Which kind of source or sink a URI names."""

from __future__ import annotations

import os
from typing import NamedTuple
from urllib.parse import urlparse


class KafkaTopic(NamedTuple):
    servers: str
    topic: str


class FilePath(NamedTuple):
    path: str
    fmt: str


def parse_uri(uri: str) -> KafkaTopic | FilePath:
    """``kafka://host:port/topic`` or a path; json and csv by extension, everything else is text."""
    if uri.startswith("kafka://"):
        parts = urlparse(uri)
        topic = parts.path.strip("/")
        if not parts.netloc or not topic:
            raise ValueError(f"kafka URI needs host and topic: {uri}")
        return KafkaTopic(parts.netloc, topic)
    if uri.startswith("file://") or "/" in uri or "\\" in uri:
        extension = os.path.splitext(uri.rstrip("/"))[1].lower()
        return FilePath(uri, {".json": "json", ".csv": "csv"}.get(extension, "text"))
    raise ValueError(f"unsupported source or sink: {uri}")
