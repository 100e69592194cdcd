"""Records to metric rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from pulse.config import JobConfig
from pulse.contract import EVENT_CONTRACT, Contract
from pulse.operators.metrics import METRICS, Metric, build_metrics
from pulse.operators.normalize import normalize_events
from pulse.operators.parse import parse_events

# Columns the metrics read; the rest of a record is not decoded for them.
METRIC_FIELDS = ("event_type", "event_time", "user_id", "total_amount", "payment_status", "stock_after")


def metrics_from_records(
    records: DataFrame,
    config: JobConfig = JobConfig(),
    metrics: Sequence[Metric] = METRICS,
    contract: Contract = EVENT_CONTRACT,
    fields: Sequence[str] | None = METRIC_FIELDS,
) -> DataFrame:
    """Parse, normalise and aggregate, for batch and streaming records alike.

    Metrics of one's own that read further columns pass those in ``fields``.
    """
    events = parse_events(records, contract, fields)
    return build_metrics(normalize_events(events, config), config, metrics)
