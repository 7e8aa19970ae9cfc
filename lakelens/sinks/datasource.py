"""Append sink as a Spark data source: tasks stage files, the driver commits them by one rename.

``spark.dataSource.register(AppendSource)``, then for a table ``rows.write.format(AppendSource.name())
.mode("append").save(path)``, for a stream ``writeStream.format(AppendSource.name()).start(path)``.

Each task writes its rows to a Parquet file of its own in a staging folder (names with ``_`` are
not read by Spark) and hands a commit message with the file's name and rows to the driver.  The
commit gathers the files that the messages name, so those of failed or duplicate attempts are
left out, adds a manifest with the counts, and renames the folder to its place: readers see a
commit whole or not at all.  A streaming batch has a folder by its number, and a replay
replaces it.  An aborted write removes what its tasks staged.

Files go through ``pyarrow.fs``: a path without a scheme or any store that it can open and
rename folders in.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceStreamArrowWriter,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from lakelens.schemas import PROCESSED_ROW

STAGING, MANIFEST, ABORTED = "_staging", "_manifest.json", "aborted"


@dataclass
class Staged(WriterCommitMessage):
    """What one task wrote; a task without rows writes no file."""

    file: str | None
    rows: int


def open_path(path: str) -> tuple[pafs.FileSystem, str]:
    """(file system, path in it)"""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri("file://" + path[5:] if path.startswith("file:/") and path[5:7] != "//" else path)
    return pafs.LocalFileSystem(), path


@dataclass
class _Commits:
    """Staging and committing under one table path; used by both writers."""

    path: str
    token: str

    def stage(self, batches: Iterator[pa.RecordBatch]) -> Staged:
        store, root = open_path(self.path)
        folder = f"{root}/{STAGING}/{self.token}"
        name, rows, writer = f"part-{uuid.uuid4().hex}.parquet", 0, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if writer is None:
                    store.create_dir(folder, recursive=True)
                    writer = pq.ParquetWriter(f"{folder}/{name}", batch.schema, filesystem=store, compression="zstd")
                writer.write_batch(batch)
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        if writer is not None and store.get_file_info(f"{folder}-{ABORTED}").type != pafs.FileType.NotFound:
            if store.get_file_info(f"{folder}/{name}").type != pafs.FileType.NotFound:
                store.delete_file(f"{folder}/{name}")  # this task ended after the write was aborted
            raise RuntimeError(f"the write {self.token} was aborted")
        return Staged(name if writer is not None else None, rows)

    def commit(self, messages: list[Staged | None], target: str) -> None:
        """Make the files of ``messages`` the folder ``target``, replacing an older one."""
        store, root = open_path(self.path)
        staged, ready = f"{root}/{STAGING}/{self.token}", f"{root}/{STAGING}/{self.token}-ready"
        done = [m for m in messages if m is not None]
        if store.get_file_info(ready).type != pafs.FileType.NotFound:  # of a commit that did not end
            store.delete_dir(ready)
        store.create_dir(ready, recursive=True)
        for message in done:
            if message.file:
                store.move(f"{staged}/{message.file}", f"{ready}/{message.file}")
        with store.open_output_stream(f"{ready}/{MANIFEST}") as out:
            out.write(json.dumps({"files": {m.file: m.rows for m in done if m.file},
                                  "rows": sum(m.rows for m in done)}).encode())
        place = f"{root}/{target}"
        if store.get_file_info(place).type != pafs.FileType.NotFound:
            store.delete_dir(place)
        store.create_dir(place.rsplit("/", 1)[0], recursive=True)
        store.move(ready, place)
        self.clean()

    def abort(self) -> None:
        """Remove what is staged; tasks that end later find the mark, an empty folder, and remove theirs."""
        store, root = open_path(self.path)
        store.create_dir(f"{root}/{STAGING}/{self.token}-{ABORTED}", recursive=True)
        self.clean()

    def clean(self) -> None:
        """Remove what is still staged: files of attempts that no message names."""
        store, root = open_path(self.path)
        for folder in (f"{root}/{STAGING}/{self.token}", f"{root}/{STAGING}/{self.token}-ready"):
            if store.get_file_info(folder).type != pafs.FileType.NotFound:
                store.delete_dir(folder)


class AppendWriter(DataSourceArrowWriter):
    """Batch append: one commit, one folder.  ``commit_id`` names it, so that a retried job replaces its own."""

    def __init__(self, options: dict):
        self.name = options.get("commit_id") or uuid.uuid4().hex
        self.commits = _Commits(options["path"].rstrip("/"), uuid.uuid4().hex)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.commits.stage(iterator)

    def commit(self, messages: list[Staged | None]) -> None:
        self.commits.commit(messages, f"commit={self.name}")

    def abort(self, messages: list[Staged | None]) -> None:
        self.commits.abort()


class AppendStreamWriter(DataSourceStreamArrowWriter):
    """Streaming append: a folder by batch number below the stream's ``commit_id``."""

    def __init__(self, options: dict):
        self.name = options.get("commit_id") or "stream"
        # Spark makes this object anew for each commit, so the staging folder goes by the stream's name
        self.commits = _Commits(options["path"].rstrip("/"), self.name)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        return self.commits.stage(iterator)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        self.commits.commit(messages, f"commit={self.name}-{batchId:012d}")

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self.commits.clean()


class AppendSource(DataSource):
    """``format("lakelens_append")``; options ``path`` and ``commit_id``."""

    @classmethod
    def name(cls) -> str:
        return "lakelens_append"

    def schema(self) -> StructType:
        return PROCESSED_ROW

    def writer(self, schema: StructType, overwrite: bool) -> AppendWriter:
        if overwrite:
            raise ValueError("this sink appends")
        return AppendWriter(self.options)

    def streamWriter(self, schema: StructType, overwrite: bool) -> AppendStreamWriter:
        return AppendStreamWriter(self.options)


def append(rows: DataFrame, path: str, commit_id: str | None = None) -> None:
    """Append ``rows`` to the table at ``path`` in one commit."""
    rows.sparkSession.dataSource.register(AppendSource)
    writer = rows.write.format(AppendSource.name()).mode("append")
    if commit_id:
        writer = writer.option("commit_id", commit_id)
    writer.save(path)


def committed(spark: SparkSession, path: str, schema: StructType = PROCESSED_ROW) -> DataFrame:
    """Rows of all commits."""
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def manifests(path: str) -> dict[str, dict]:
    """Commit folder -> its manifest (files with their rows, and all rows)."""
    store, root = open_path(path.rstrip("/"))
    out = {}
    for info in store.get_file_info(pafs.FileSelector(root)):
        if info.base_name.startswith("commit="):
            with store.open_input_stream(f"{info.path}/{MANIFEST}") as data:
                out[info.base_name] = json.loads(data.read())
    return out
