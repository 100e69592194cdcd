"""Settings of the metrics job."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field


@dataclass(frozen=True)
class JobConfig:
    app_name: str = "event-metrics"
    timezone: str = "UTC"
    # source
    bootstrap_servers: str = "localhost:9092"
    topic: str = "events.raw"
    starting_offsets: str = "latest"
    fail_on_data_loss: bool = True
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    # event time
    watermark_delay: str = "2 minutes"
    window_duration: str = "1 minute"
    slide_duration: str = "1 minute"
    max_event_skew: str | None = None
    # execution
    trigger_interval: str = "10 seconds"
    shuffle_partitions: int | None = None
    checkpoint_dir: str | None = None
    # sink
    metric_table: str = "metrics_realtime_1m"
    table_root: str | None = None
    extra_conf: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.starting_offsets not in ("earliest", "latest"):
            raise ValueError("starting_offsets must be 'earliest' or 'latest'")
        for name in ("app_name", "bootstrap_servers", "topic", "watermark_delay", "window_duration",
                     "slide_duration", "trigger_interval", "metric_table"):
            if not getattr(self, name).strip():
                raise ValueError(f"{name} must not be empty")
        for name in ("shuffle_partitions", "max_offsets_per_trigger", "min_partitions"):
            value = getattr(self, name)
            if value is not None and value < 1:
                raise ValueError(f"{name} must be positive")

    @property
    def query_name(self) -> str:
        return f"{self.app_name}-query"

    def session_conf(self) -> dict[str, str]:
        """Spark settings of the job. Everything here can be set on a running session."""
        conf = {
            "spark.sql.session.timeZone": self.timezone,
            # State lives off-heap and only changes are uploaded per micro-batch.
            "spark.sql.streaming.stateStore.providerClass":
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
            "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
            # Of a repeated key the last value counts, as in a typed decode.
            "spark.sql.variant.allowDuplicateKeys": "true",
            # The JVM leaves methods above 8000 bytes of byte code uncompiled; wide decodes reach that.
            "spark.sql.codegen.hugeMethodLimit": "8000",
        }
        if self.shuffle_partitions is not None:
            # Fixed for the life of a checkpoint: a restart reads the value stored there.
            conf["spark.sql.shuffle.partitions"] = str(self.shuffle_partitions)
        return {**conf, **self.extra_conf}
