"""Opening files inside of tasks, by the URIs that Spark gives out."""

from __future__ import annotations

#: Names of one store in Spark and in Arrow.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasbs": "abfss"}


def arrow_uri(uri: str) -> str:
    """The URI under the scheme that Arrow knows; a local path stays a path."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return uri
    if scheme == "file":
        return "/" + rest.lstrip("/")
    return f"{SCHEMES.get(scheme, scheme)}:{rest}"


def open_fs(uri: str):
    """Arrow's file system and the path in it, for a URI or path as Spark writes it."""
    from pyarrow import fs

    known = arrow_uri(uri)
    if known.startswith("/") or ":" not in known:
        return fs.LocalFileSystem(), known
    return fs.FileSystem.from_uri(known)
