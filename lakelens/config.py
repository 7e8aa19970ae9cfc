"""Job configuration read from environment variables with defaults (one dataclass for all jobs)."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

# Fixed values that must equal the original pipeline's settings.
MAX_MESSAGE_BYTES = 26_214_400          # producer max request size and broker max message
MAX_FETCH_BYTES = 31_457_280            # consumer fetch limit, all partitions; a task slot reads like a consumer
MAX_PARTITION_FETCH_BYTES = 26_214_400  # consumer fetch limit, per partition
MAX_OFFSETS_PER_TRIGGER = 10_000        # records of a Kafka micro-batch (ours)
POLL_INTERVAL_SECONDS = 1               # folder poll
COMMIT_INTERVAL_SECONDS = 5.0           # stream service commit interval
INSERT_PAGE_ROWS = 1_000                # relational batched insert page
TOPIC_PARTITIONS = 3                    # image-uploads partitions
RETENTION_DAYS = 30                     # metadata retention
SNAPSHOT_RETENTION_DAYS = 7             # expire_snapshots threshold


def _env_bool(name: str, default: str) -> bool:
    # Only the literal "true" (any case) enables a flag.
    return os.getenv(name, default).lower() == "true"


@dataclass(frozen=True)
class JobConfig:
    watch_path: str = "/data/incoming"
    input_topic: str = "image-uploads"
    output_topic: str = "image-uploads-processed"
    consumer_group: str = "image-consumer-group"
    starting_offsets: str = "earliest"          # image consumer
    processor_starting_offsets: str = "latest"  # stream service
    bootstrap_servers: str | None = None        # None -> file-backed topic folders
    topic_root: str | None = None               # folder holding file-backed topics
    object_root: str | None = None              # object store root (date-keyed paths)
    metadata_table: str | None = None           # T1 path
    processed_table: str | None = None          # T2 path
    lake_table: str | None = None               # T3 path
    images_table: str | None = None             # T4 path
    dead_letter_table: str | None = None
    enable_postgres_sink: bool = True
    enable_iceberg_sink: bool = True
    max_message_bytes: int = MAX_MESSAGE_BYTES
    max_bytes_per_trigger: int | None = None    # bytes of a micro-batch; None: the fetch limit for each task slot
    max_offsets_per_trigger: int = MAX_OFFSETS_PER_TRIGGER
    poll_interval_seconds: int = POLL_INTERVAL_SECONDS
    commit_interval_seconds: float = COMMIT_INTERVAL_SECONDS
    topic_partitions: int = TOPIC_PARTITIONS
    retention_days: int = RETENTION_DAYS
    snapshot_retention_days: int = SNAPSHOT_RETENTION_DAYS

    def dead_letter_root(self) -> str:
        """Where refused records go; a job without such a place would lose them."""
        if not self.dead_letter_table:
            raise ValueError("dead_letter_table must be set")
        return self.dead_letter_table

    @classmethod
    def from_env(cls, **overrides) -> "JobConfig":
        env = {
            "watch_path": os.getenv("WATCH_PATH", cls.watch_path),
            "input_topic": os.getenv("KAFKA_INPUT_TOPIC", os.getenv("KAFKA_TOPIC", cls.input_topic)),
            "output_topic": os.getenv("KAFKA_OUTPUT_TOPIC", cls.output_topic),
            "consumer_group": os.getenv("KAFKA_GROUP_ID", cls.consumer_group),
            "starting_offsets": os.getenv("KAFKA_AUTO_OFFSET_RESET", cls.starting_offsets),
            "processor_starting_offsets": os.getenv("KAFKA_AUTO_OFFSET_RESET", cls.processor_starting_offsets),
            "bootstrap_servers": os.getenv("KAFKA_BOOTSTRAP_SERVERS"),
            "topic_root": os.getenv("LAKELENS_TOPIC_ROOT"),
            "object_root": os.getenv("LAKELENS_OBJECT_ROOT"),
            "metadata_table": os.getenv("LAKELENS_METADATA_TABLE"),
            "processed_table": os.getenv("LAKELENS_PROCESSED_TABLE"),
            "lake_table": os.getenv("LAKELENS_LAKE_TABLE"),
            "images_table": os.getenv("LAKELENS_IMAGES_TABLE"),
            "dead_letter_table": os.getenv("LAKELENS_DEAD_LETTER_TABLE"),
            "enable_postgres_sink": _env_bool("ENABLE_POSTGRES_SINK", "true"),
            "enable_iceberg_sink": _env_bool("ENABLE_ICEBERG_SINK", "true"),
            "poll_interval_seconds": int(os.getenv("POLL_INTERVAL", str(POLL_INTERVAL_SECONDS))),
            "commit_interval_seconds": float(os.getenv("COMMIT_INTERVAL_SECONDS", str(COMMIT_INTERVAL_SECONDS))),
        }
        env.update(overrides)
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in env.items() if k in known})
