"""File name, extension, MIME and object-key helpers."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted image extensions (compared lower-case) and their MIME types.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".webp")
MIME_BY_EXTENSION = {
    ".jpg": "image/jpeg",
    ".jpeg": "image/jpeg",
    ".png": "image/png",
    ".gif": "image/gif",
    ".bmp": "image/bmp",
    ".tiff": "image/tiff",
    ".webp": "image/webp",
}
DEFAULT_MIME = "application/octet-stream"
OBJECT_PREFIX = "images/"


def file_name(path: Column) -> Column:
    """Last path segment."""
    return F.regexp_extract(path, r"[^/]+$", 0)


def local_path(path: Column) -> Column:
    """Absolute path without the ``file:`` scheme that the binaryFile source adds."""
    return F.regexp_replace(path, r"^file:(//)?", "")


def extension(name: Column) -> Column:
    """Suffix of a file name including the dot ('' when none; a leading dot alone is no suffix)."""
    return F.regexp_extract(name, r"^.+(\.[^./]+)$", 1)


def is_image_name(name: Column) -> Column:
    return F.lower(extension(name)).isin(*IMAGE_EXTENSIONS)


def mime_from_extension(ext: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for x in chain.from_iterable(MIME_BY_EXTENSION.items())])
    return F.coalesce(mapping[F.lower(ext)], F.lit(DEFAULT_MIME))


def object_key(day: Column, filename: Column) -> Column:
    """Date-keyed object path ``images/YYYY/MM/DD/<filename>``."""
    return F.concat(F.lit(OBJECT_PREFIX), F.date_format(day, "yyyy/MM/dd"), F.lit("/"), filename)
