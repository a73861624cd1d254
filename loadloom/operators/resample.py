"""Raw readings to one value per UTC hour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import KEYS, TS
from .spine import fill_gaps

# The aggregates an hourly table may be built with.
AGGREGATES = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}


def latest_revision(
    readings: DataFrame, keys: Sequence[str] = KEYS, ts: str = TS,
    value: str = "value", seq: str = "ingest_seq",
) -> DataFrame:
    """One row per instant: the value that arrived last.

    ``max_by`` over primitives is a hash aggregate with map-side combine, so an instant
    revised a billion times shrinks before the shuffle.
    """
    return readings.groupBy(*keys, ts).agg(F.max_by(value, seq).alias(value))


def to_hourly(
    readings: DataFrame, value: str = "value", out: str = "load_mw",
    aggregate: str = "mean", keys: Sequence[str] = KEYS, ts: str = TS,
    seq: str | None = "ingest_seq", complete: bool = True,
) -> DataFrame:
    """Resample on UTC hours after resolving revisions; empty hours are null rows.

    The mean is the right default for instantaneous power. Pass ``complete=False`` when a
    later step builds its own spine.
    """
    if aggregate not in AGGREGATES:
        raise ValueError(f"aggregate must be one of {sorted(AGGREGATES)}, got {aggregate!r}")
    single = latest_revision(readings, keys, ts, value, seq) if seq else readings
    hourly = single.groupBy(*keys, F.date_trunc("hour", ts).alias(ts)).agg(
        AGGREGATES[aggregate](value).alias(out)
    )
    return fill_gaps(hourly, keys, ts) if complete else hourly
