"""Where the lake keeps its tables, and the knobs of the ingest jobs."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit

# Defaults of the jobs.
DEFAULT_BASE = "hdfs://localhost:9000/reviews"
DEFAULT_CSV = "data/Reviews.csv"
DEFAULT_BROKERS = "localhost:9092"
DEFAULT_TOPIC = "reviews"
DEFAULT_TRIGGER_SECONDS = 30


def as_read_uri(path: str) -> str:
    """A URI stays as it is; a bare path becomes an absolute file URI, so that a cluster
    whose default file system is remote does not look for it there."""
    has_scheme = ":" in path.split("/", 1)[0]
    return path if has_scheme else "file://" + os.path.abspath(os.path.expanduser(path))


@dataclass(frozen=True)
class LakeLayout:
    """Paths below one base folder.

    The two silver lanes have folders of their own. A streaming file sink keeps a commit
    log in its folder and Spark then reads only the files of that log, so batch files in
    the same folder would be lost to readers.
    """

    base: str
    default_fs_override: str | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> LakeLayout:
        base = env.get("HDFS_BASE_PATH", DEFAULT_BASE).rstrip("/")
        return cls(base, env.get("HDFS_DEFAULT_FS") or None)

    @property
    def bronze_stream(self) -> str:
        return f"{self.base}/bronze/reviews_raw"

    @property
    def bronze_batch(self) -> str:
        return f"{self.base}/bronze/amazon_reviews_raw"

    @property
    def bronze_rejected(self) -> str:
        return f"{self.base}/bronze/reviews_rejected"

    @property
    def fanout(self) -> str:
        return f"{self.base}/fanout"

    @property
    def fanout_bronze(self) -> str:
        return f"{self.base}/bronze/reviews_fanout"

    @property
    def fanout_rejected(self) -> str:
        return f"{self.base}/bronze/reviews_fanout_rejected"

    @property
    def fanout_silver(self) -> str:
        return f"{self.base}/silver/reviews_fanout"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver/reviews_enriched"

    @property
    def silver_batch(self) -> str:
        return f"{self.silver}/ingest=batch"

    @property
    def silver_stream(self) -> str:
        return f"{self.silver}/ingest=stream"

    @property
    def silver_compacted(self) -> str:
        return f"{self.base}/silver/reviews_compacted"

    @property
    def loads(self) -> str:
        return f"{self.base}/loads"

    @property
    def partials(self) -> str:
        return f"{self.base}/gold/partials"

    @property
    def gold(self) -> str:
        return f"{self.base}/gold/dashboard"

    def checkpoint(self, name: str) -> str:
        return f"{self.base}/checkpoints/{name}"

    @property
    def default_fs(self) -> str | None:
        """The file system of the base path, for `spark.hadoop.fs.defaultFS`, unless the
        environment names one."""
        if self.default_fs_override:
            return self.default_fs_override
        parts = urlsplit(self.base)
        return f"{parts.scheme}://{parts.netloc}" if parts.scheme and parts.netloc else None


def _int_setting(env: Mapping[str, str], name: str, default: int) -> int:
    try:
        return int(env.get(name, default))
    except ValueError:
        return default


@dataclass(frozen=True)
class StreamSettings:
    brokers: str = DEFAULT_BROKERS
    topic: str = DEFAULT_TOPIC
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = False
    trigger_seconds: int = DEFAULT_TRIGGER_SECONDS
    max_offsets_per_trigger: int | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> StreamSettings:
        return cls(
            brokers=env.get("KAFKA_BOOTSTRAP_SERVERS", DEFAULT_BROKERS),
            topic=env.get("KAFKA_TOPIC", DEFAULT_TOPIC),
            starting_offsets=env.get("KAFKA_STARTING_OFFSETS", "latest"),
            max_offsets_per_trigger=_int_setting(env, "KAFKA_MAX_OFFSETS_PER_TRIGGER", 0) or None,
            fail_on_data_loss=env.get("SPARK_KAFKA_FAIL_ON_DATA_LOSS", "false").lower() == "true",
            trigger_seconds=_int_setting(
                env, "SPARK_STREAM_TRIGGER_SECONDS", DEFAULT_TRIGGER_SECONDS
            ),
        )

    @property
    def trigger(self) -> dict[str, str]:
        return {"processingTime": f"{self.trigger_seconds} seconds"}


def history_csv_path(env: Mapping[str, str] = os.environ) -> str:
    return as_read_uri(env.get("AMAZON_REVIEWS_CSV", DEFAULT_CSV))
