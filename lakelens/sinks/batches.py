"""Identity of a micro-batch and small marker files, kept through the Hadoop file system.

A batch is identified by the writer, the run of its checkpoint and the batch number.  The
run is drawn once for each checkpoint and stored inside it, so a new checkpoint, whose batch
numbers start at 0 again, never meets the folders of an older one, nor does another writer.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from lakelens.session import file_system


@dataclass(frozen=True)
class BatchRef:
    """``writer`` (job name), ``run`` (of its checkpoint) and the batch number."""

    writer: str
    run: str
    batch: int

    @property
    def folder(self) -> str:
        return f"writer={self.writer}/run={self.run}/batch={self.batch:012d}"

    @staticmethod
    def of(batch: BatchRef | int, writer: str = "manual") -> BatchRef:
        """A bare number is a batch of the run ``r0`` of a manual writer."""
        return batch if isinstance(batch, BatchRef) else BatchRef(writer, "r0", int(batch))


@dataclass(frozen=True)
class Run:
    """Run of a checkpoint: its id and the time at which the checkpoint was first used."""

    id: str
    started: str
    checkpoint: str


def run_of(spark: SparkSession, checkpoint: str) -> Run:
    """The run stored in ``checkpoint``; drawn and stored at its first use."""
    fs, root = file_system(spark, f"{checkpoint.rstrip('/')}/_run")
    if fs.exists(root):
        for status in fs.listStatus(root):
            found = re.fullmatch(r"(r[0-9a-f]{12})-(\d{8}T\d{6}\.\d{6})", status.getPath().getName())
            if found:
                return Run(found[1], datetime.strptime(found[2], "%Y%m%dT%H%M%S.%f").isoformat(" "), checkpoint.rstrip("/"))
    now = datetime.now(timezone.utc).replace(tzinfo=None)
    run = f"r{uuid.uuid4().hex[:12]}"
    create_marker(spark, f"{checkpoint.rstrip('/')}/_run", f"{run}-{now.strftime('%Y%m%dT%H%M%S.%f')}")
    return Run(run, now.isoformat(" "), checkpoint.rstrip("/"))


def create_marker(spark: SparkSession, folder: str, name: str) -> bool:
    """Create an empty file unless it exists (atomic); whether this call created it."""
    fs, path = file_system(spark, f"{folder.rstrip('/')}/{name}")
    fs.mkdirs(path.getParent())
    return fs.createNewFile(path)


def markers(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in ``folder``; none if it does not exist."""
    fs, path = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def delete_marker(spark: SparkSession, folder: str, name: str) -> None:
    fs, path = file_system(spark, f"{folder.rstrip('/')}/{name}")
    fs.delete(path, False)


def write_text(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """A file that appears whole, by a rename."""
    fs, draft = file_system(spark, f"{folder.rstrip('/')}/.{name}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, file_system(spark, f"{folder.rstrip('/')}/{name}")[1]):
        raise RuntimeError(f"{folder}/{name} exists")


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = file_system(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def reserve_ids(spark: SparkSession, table: str, count: int, at_least: int = 0) -> int:
    """Reserve ``count`` serial ids of ``table``; the id before the first of them.

    The high-water mark lies beside the rows (``<table>/_serial``) and never falls, so ids of
    deleted rows are not given out again.  Two writers cannot reserve the same range: the mark
    is an exclusively created file, and the loser takes the next range.
    """
    folder = f"{table.rstrip('/')}/_serial"
    while True:
        old = markers(spark, folder)
        start = max([at_least, *(int(m) for m in old)])
        if count == 0 or create_marker(spark, folder, f"{start + count:020d}"):
            for m in old if count else []:
                delete_marker(spark, folder, m)
            return start


def reserve_offsets(spark: SparkSession, topic: str, ref: BatchRef, counts: dict[int, int]) -> dict[int, int]:
    """First offset of each partition for ``counts`` new records of a batch on a file topic.

    Offsets are dense by partition from the stored end (``<topic>/_offsets``).  A batch that is
    replayed gets the offsets that it got before.  One producer writes a file topic at a time.
    """
    folder, tag = f"{topic.rstrip('/')}/_offsets", [ref.writer, ref.run, str(ref.batch)]
    stored = [m.split("~") for m in markers(spark, folder)]
    out = {}
    for partition, count in sorted(counts.items()):
        own = [m for m in stored if int(m[0]) == partition]
        before = [m for m in own if m[3:] == tag]
        if before:
            out[partition] = int(before[0][1])
            continue
        start = max([int(m[2]) for m in own], default=0)
        create_marker(spark, folder, "~".join([str(partition), f"{start:020d}", f"{start + count:020d}", *tag]))
        out[partition] = start
        for m in own:  # older batches of this run cannot be replayed any more
            if m[3:5] == tag[:2] and int(m[5]) < ref.batch:
                delete_marker(spark, folder, "~".join(m))
    return out
