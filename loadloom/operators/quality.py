"""Schema, range and continuity checks as one table of issues."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import KEYS, TS
from .islands import hour_runs
from .latest import first_n_per_key
from .spine import continuity

# Plausible ranges, default examples per issue, issue names.
LOAD_MW_RANGE = (10000.0, 30000.0)
TEMPERATURE_RANGE = (-35.0, 45.0)
PERCENT_RANGE = (0.0, 100.0)
MAX_EXAMPLES = 8
DUPLICATES = "duplicate timestamps"
MISSING = "missing hours"
NO_REFERENCE = "load present but TSO forecast missing"
NO_LOAD = "load missing"

RANGES = {
    "load_mw": LOAD_MW_RANGE,
    "tso_forecast_mw": LOAD_MW_RANGE,
    "temp_c": TEMPERATURE_RANGE,
    "wind_ms": (0.0, None),
    "cloud_cover": PERCENT_RANGE,
    "humidity_pct": PERCENT_RANGE,
}
REQUIRED = ("is_holiday",)


def violations(df: DataFrame, ranges=None, required: Sequence[str] = REQUIRED, keys=KEYS, ts: str = TS) -> DataFrame:
    """One row per broken rule and row: ``column, check_name, ts, value``. One scan."""
    rules = []
    for name, (low, high) in (ranges or RANGES).items():
        if name not in df.columns:
            continue
        c = F.col(name)
        bad = (c < low) if high is None else ~c.between(low, high)
        check = f"greater_than_or_equal_to({low:g})" if high is None else f"in_range({low:g}, {high:g})"
        rules.append((name, check, bad, c.cast("string")))
    for name in required:
        if name in df.columns:
            rules.append((name, "not_nullable", F.col(name).isNull(), F.lit(None).cast("string")))
    broken = F.array_compact(
        F.array(
            *[
                F.when(
                    bad,
                    F.struct(F.lit(n).alias("column"), F.lit(k).alias("check_name"), v.alias("value")),
                )
                for n, k, bad, v in rules
            ]
        )
    )
    return df.select(*keys, ts, F.explode(broken).alias("_v")).select(
        *keys, ts, "_v.column", "_v.check_name", "_v.value"
    )


def violation_counts(
    df: DataFrame, ranges=None, required=REQUIRED, keys=KEYS, ts: str = TS, n_examples: int = MAX_EXAMPLES
) -> DataFrame:
    """Counts and first examples per (key, column, check)."""
    found = violations(df, ranges, required, keys, ts)
    group = [*keys, "column", "check_name"]
    counts = found.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    shown = found.withColumn(
        "example", F.concat_ws("  ", F.date_format(ts, "yyyy-MM-dd HH:mm"), F.coalesce("value", F.lit("null")))
    )
    return counts.join(first_examples(shown, group, [ts, "value"], n_examples), group, "left")


def first_examples(shown: DataFrame, group: Sequence[str], order: Sequence[str], n_examples: int = MAX_EXAMPLES) -> DataFrame:
    """The first ``n_examples`` per group in order, as an array: a report's illustration.

    ``violations`` and ``hour_runs`` give every one. The row-number filter is pushed below
    the shuffle as a group limit, so a rule broken by most rows sends few rows per task.
    """
    top = first_n_per_key(shown, group, order, n_examples)
    return top.groupBy(*group).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", "example"))), lambda x: x["example"]
        ).alias("examples")
    )


def _run_issue(runs: DataFrame, name: str, severity: str, keys, n_examples: int = MAX_EXAMPLES) -> DataFrame:
    """One issue per key from runs of hours: hours in total, and runs as examples."""
    shown = runs.withColumn(
        "example",
        F.concat(
            F.date_format("first_ts", "yyyy-MM-dd HH:mm"), F.lit(" -> "),
            F.date_format("last_ts", "yyyy-MM-dd HH:mm"), F.lit("  ("), "hours", F.lit(" h)"),
        ),
    )
    counts = shown.groupBy(*keys).agg(F.sum("hours").alias("n"), F.count(F.lit(1)).alias("groups"))
    return (
        counts.join(first_examples(shown, keys, ["first_ts"], n_examples), list(keys), "left")
        .select(*keys, F.lit(name).alias("name"), F.lit(severity).alias("severity"), "n", "groups", "examples")
    )


def cross_column_issues(df: DataFrame, keys=KEYS, ts: str = TS, n_examples: int = MAX_EXAMPLES) -> DataFrame:
    """Load without a reference forecast is an error; load missing is a warning."""
    no_reference = df.filter("load_mw IS NOT NULL AND tso_forecast_mw IS NULL")
    no_load = df.filter("load_mw IS NULL")
    return _run_issue(hour_runs(no_reference, keys, ts), NO_REFERENCE, "error", keys, n_examples).unionByName(
        _run_issue(hour_runs(no_load, keys, ts), NO_LOAD, "warning", keys, n_examples)
    )


def validate(
    df: DataFrame, ranges=None, required=REQUIRED, keys=KEYS, ts: str = TS, n_examples: int = MAX_EXAMPLES
) -> DataFrame:
    """All issues per key: ``name, severity, n, groups, examples``. Empty means valid.

    ``groups`` is the number of runs or examples there are in total, so a reader can say
    "and n more".
    """
    keys = list(keys)
    breaks = continuity(df, keys, ts)
    surplus = breaks.filter("kind = 'duplicate'").withColumn("example", F.date_format("first_ts", "yyyy-MM-dd HH:mm"))
    dups = (
        surplus.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
        .join(first_examples(surplus, keys, ["first_ts"], n_examples), keys, "left")
        .select(
            *keys, F.lit(DUPLICATES).alias("name"), F.lit("error").alias("severity"),
            "n", F.col("n").alias("groups"), "examples",
        )
    )
    schema = violation_counts(df, ranges, required, keys, ts, n_examples).select(
        *keys,
        F.concat(F.lit("schema: "), "column", F.lit(" failed "), "check_name").alias("name"),
        F.lit("error").alias("severity"), "n", F.col("n").alias("groups"), "examples",
    )
    missing = _run_issue(breaks.filter("kind = 'gap'"), MISSING, "error", keys, n_examples)
    return dups.unionByName(missing).unionByName(schema).unionByName(cross_column_issues(df, keys, ts, n_examples))


def is_valid(issues: DataFrame) -> bool:
    """No error-level issue. Runs an action."""
    return issues.filter("severity = 'error'").isEmpty()


class ValidationError(ValueError):
    """Raised by ``raise_for_status`` when a table has error-level issues."""


def raise_for_status(issues: DataFrame, shown: int = 5) -> None:
    """Raise if there is an error-level issue; the message names ``shown`` of them and says
    how many there are in total."""
    errors = issues.filter("severity = 'error'")
    total = errors.count()
    if total:
        first = errors.orderBy(F.desc("n"), "name").select("name", "n").take(shown)
        listed = "; ".join(f"{r['name']}: {r['n']}" for r in first)
        raise ValidationError(f"{total} issue(s): {listed}" + ("; and others" if total > len(first) else ""))


def rows_per_year(df: DataFrame, keys=KEYS, ts: str = TS) -> DataFrame:
    return df.groupBy(*keys, F.year(ts).alias("year")).agg(F.count(F.lit(1)).alias("n"))


def column_coverage(df: DataFrame, columns: Sequence[str], keys=KEYS) -> DataFrame:
    """Non-null count per column, long."""
    wide = df.groupBy(*keys).agg(*[F.count(c).alias(c) for c in columns if c in df.columns])
    return wide.unpivot(list(keys), [c for c in columns if c in df.columns], "column", "n_present")
