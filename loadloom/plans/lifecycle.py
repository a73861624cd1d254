"""Decisions over tables: retraining, promotion, retention, model card."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import finite
from ..operators.latest import latest_per_key
from ..operators.splits import chronological_split
from ..session import through_table
from ..sources import tables
from . import models, training
from .evaluation import references
from .features import feature_names, make_features

# Cadence, retention and the tolerated relative regression.
CADENCE_DAYS, KEEP_RUNS_DAYS, MAX_REGRESSION = 7, 120, 1.02


def _instant(at) -> Column:
    return at if isinstance(at, Column) else F.lit(at).cast("timestamp")


def last_success(events: DataFrame, now, by: Sequence[str] = ()) -> DataFrame:
    """Newest success per pipeline and the days since."""
    elapsed = (F.unix_micros(_instant(now)) - F.unix_micros("last_success")) / 86_400_000_000
    return (
        events.filter("event = 'success'")
        .groupBy(*by, "pipeline")
        .agg(F.max("at").alias("last_success"))
        .withColumn("days_since", elapsed)
    )


def retrain_flag(events: DataFrame, by: Sequence[str] = ("series_id",)) -> DataFrame:
    """The raised flag: the *earliest* raise after the last clear, none when cleared.

    One aggregation finds the last clear; no per-key ordering of events is needed.
    """
    by = list(by)
    flags = events.filter("event IN ('raise', 'clear')")
    cleared = flags.groupBy(*by).agg(F.max(F.when(F.col("event") == "clear", F.col("at"))).alias("_cleared"))
    open_raises = flags.filter("event = 'raise'").join(cleared, by).filter(
        F.col("_cleared").isNull() | (F.col("at") > F.col("_cleared"))
    )
    flag = open_raises.groupBy(*by).agg(F.min(F.struct("at", "reason")).alias("_f"))
    return flag.select(*by, F.col("_f.at").alias("raised_at"), F.col("_f.reason").alias("reason"))


def retrain_due(
    known: DataFrame, flags: DataFrame, successes: DataFrame, now, cadence_days: float = CADENCE_DAYS,
    by: Sequence[str] = ("series_id",), force: bool = False,
) -> DataFrame:
    """Is a retrain owed, and why: flag, else never run, else cadence elapsed."""
    by = list(by)
    state = known.join(flags, by, "left").join(
        successes.select(*by, "last_success"), by, "left"
    )
    elapsed = (F.unix_micros(_instant(now)) - F.unix_micros("last_success")) / 86_400_000_000
    flagged = F.col("raised_at").isNotNull()
    overdue = elapsed >= cadence_days
    rules = [
        (F.lit(force), "forced", F.lit("asked for by hand")),
        (flagged, "flag", F.concat(F.lit("open drift flag of "), F.date_format("raised_at", "yyyy-MM-dd HH:mm"), F.lit(": "), F.col("reason"))),
        (elapsed.isNull(), "never", F.lit("no successful retrain on record")),
        (overdue, "cadence", F.format_string(f"%.1f days since the last success; the cadence is {cadence_days}", elapsed)),
    ]
    code, text = F, F
    for condition, name, words in rules:
        code, text = code.when(condition, name), text.when(condition, words)
    code = code.otherwise("fresh")
    text = text.otherwise(F.format_string(f"%.1f of {cadence_days} days since the last success", elapsed))
    return state.select(*known.columns, (code != "fresh").alias("due"), code.alias("due_code"), text.alias("due_reason"))


def promotion_decision(
    candidates: DataFrame, candidate: str = "candidate", naive: str = "naive",
    champion: str = "champion", max_regression: float | str = MAX_REGRESSION,
) -> DataFrame:
    """Promote? Lower is better. Fails closed on any value that is not a finite number.

    A null champion means there is none yet; a NaN champion is a fault and holds.
    """
    if not isinstance(max_regression, str) and max_regression < 1:
        raise ValueError(f"a tolerance below 1 would ask for progress: max_regression={max_regression}")
    tolerance = F.col(max_regression) if isinstance(max_regression, str) else F.lit(float(max_regression))
    tolerance = F.when(tolerance >= 1, tolerance).otherwise(
        F.raise_error(F.lit("a tolerance below 1 would ask for progress")).cast("double")
    )
    c, n, k = F.col(candidate), F.col(naive), F.col(champion)
    ceiling = k * tolerance
    rules = [
        (~finite(c), False, "candidate_invalid", F.lit("the candidate has no usable metric")),
        (~finite(n), False, "baseline_invalid", F.lit("the naive baseline has no usable metric")),
        (c >= n, False, "worse_than_naive", F.format_string("naive %.4f is as good as the candidate's %.4f", n, c)),
        (k.isNull(), True, "first", F.format_string("%.4f against naive %.4f; no champion to compare with", c, n)),
        (~finite(k), False, "champion_invalid", F.lit("a champion is set but its metric is unknown")),
        (c > ceiling, False, "regression", F.format_string("%.4f is over the limit of %.4f set by the champion", c, ceiling)),
    ]
    promote, code, reason = F, F, F
    for condition, verdict, name, text in rules:
        promote, code, reason = promote.when(condition, F.lit(verdict)), code.when(condition, name), reason.when(condition, text)
    return candidates.withColumns(
        {
            "promote": promote.otherwise(F.lit(True)), "gate_code": code.otherwise("accepted"),
            "gate_reason": reason.otherwise(F.format_string("%.4f against naive %.4f and champion %.4f", c, n, k)),
        }
    )


def current_alias(aliases: DataFrame, key: Sequence[str] = ("model_name", "alias")) -> DataFrame:
    """The version an alias points at now: its newest row; of equal times the larger number."""
    return latest_per_key(aliases, key, ["at", F.expr("try_cast(version AS bigint)"), "version"])


def champion_metric(
    aliases: DataFrame, runs: DataFrame, metric: str, data_source: str | None = None,
    alias: str = "champion", key: Sequence[str] = ("model_name", "alias"),
) -> DataFrame:
    """Champion's value of a metric.

    Null when its data source is not comparable, which is like having no champion. NaN when
    the alias points at a run that is not on record or lacks the metric: the gate then holds.
    """
    now = current_alias(aliases.filter(F.col("alias") == alias), key)
    value = F.coalesce(F.try_element_at("metrics", F.lit(metric)), F.lit(float("nan")))
    if data_source is not None:
        value = F.when(F.col("data_source").isNull() | (F.col("data_source") == data_source), value)
    return now.join(runs.select("run_id", "data_source", "metrics"), "run_id", "left").select(
        *key, "version", "run_id", value.alias("champion")
    )


def apply_gate(
    decisions: DataFrame, at, alias: str = "champion", metric: str = "candidate"
) -> tuple[DataFrame, DataFrame]:
    """Rows to append: one decision per candidate, and one alias move per model.

    Of several promoted candidates of a model the best (lowest metric, then the larger
    version number) gets the alias.
    """
    log = decisions.select(
        "model_name", "version", "run_id", "promote", F.col("gate_code").alias("code"), F.col("gate_reason").alias("reason"),
        _instant(at).alias("at"),
    )
    best = latest_per_key(
        decisions.filter("promote"), ["model_name"], [-F.col(metric), F.expr("try_cast(version AS bigint)"), F.col("version")]
    )
    moves = best.select("model_name", F.lit(alias).alias("alias"), "version", "run_id", _instant(at).alias("at"))
    return log, moves


def prunable_runs(
    runs: DataFrame, aliases: DataFrame, now, keep_days: int = KEEP_RUNS_DAYS,
    key: Sequence[str] = ("model_name", "alias"),
) -> DataFrame:
    """Runs older than the retention that no alias points at."""
    old = runs.filter(F.unix_seconds("started_at") < F.unix_seconds(_instant(now)) - keep_days * 86400)
    protected = current_alias(aliases, key).select("run_id")
    return old.join(protected, "run_id", "left_anti")


def model_card(
    aliases: DataFrame, runs: DataFrame, alias: str = "champion", key: Sequence[str] = ("model_name", "alias")
) -> DataFrame:
    """Who is serving, since when, trained on what; nulls when the run is unknown."""
    now = current_alias(aliases.filter(F.col("alias") == alias), key)
    return now.join(runs, "run_id", "left").select(
        *key, "version", "run_id", F.col("at").alias("promoted_at"),
        *[c for c in runs.columns if c not in ("run_id", *key)],
    )


# Outcomes of a retrain job.
SKIPPED, PROMOTED, NOT_PROMOTED, INSUFFICIENT_DATA = (
    "skipped", "promoted", "trained_not_promoted", "insufficient_data",
)


@dataclass(frozen=True)
class RetrainOutcome:
    """What a retrain did, with the rows to append to the events, run, gate and alias tables."""

    status: str
    due: DataFrame
    events: DataFrame | None = None
    runs: DataFrame | None = None
    decisions: DataFrame | None = None
    moves: DataFrame | None = None
    prune: DataFrame | None = None
    champion: models.Champion | None = None


def retrain(
    dataset: DataFrame, events: DataFrame, aliases: DataFrame, runs: DataFrame, model_name: str,
    now, owners: DataFrame | None = None, horizon: int = 24, validation_days: int = 60, params: dict | None = None,
    grid: dict | None = None, force: bool = False, cadence_days: float = CADENCE_DAYS, keep_days: int = KEEP_RUNS_DAYS,
    data_source: str = "ingested", dataset_version: str | None = None,
) -> RetrainOutcome:
    """Who is due, then train once, gate, clear their flags, mark success, list prunable runs. Runs jobs.

    ``owners`` (``series_id``; default: the series of the dataset) are asked in one job; the
    model is pooled over all series, so one training serves everyone who is due. Too little
    history is a reported outcome that leaves flags and markers alone, so the question is
    asked again.
    """
    known = (dataset if owners is None else owners).select("series_id").distinct()
    done = last_success(events.filter("pipeline = 'retrain_if_needed'"), now, ["series_id"])
    asked = retrain_due(known, retrain_flag(events), done, now, cadence_days, force=force)
    due = through_table(asked.filter("due"), "due")
    if due.isEmpty():
        return RetrainOutcome(SKIPPED, due)

    names = feature_names(horizon)
    features = through_table(make_features(dataset, horizon), "retrain-features")
    rows = through_table(chronological_split(features, validation_days, horizon), "retrain")
    if rows.filter("block = 'train'").isEmpty() or rows.filter("block = 'validation'").isEmpty():
        return RetrainOutcome(INSUFFICIENT_DATA, due)

    trained = training.train(
        rows, names, references(dataset), runs, model_name, horizon, params, grid,
        dataset_version=dataset_version, data_source=data_source, started_at=now,
    )
    champion = champion_metric(aliases.filter(F.col("model_name") == model_name), runs, "mape", data_source)
    decided = promotion_decision(trained.candidates.join(champion.select("model_name", "champion"), "model_name", "left"))
    decisions, moves = apply_gate(through_table(decided, "gate"), now)
    moved = moves.first()
    marks = due.select(
        "series_id", F.explode(F.array(
            F.struct(F.lit("retrain").alias("pipeline"), F.lit("clear").alias("event")),
            F.struct(F.lit("retrain_if_needed").alias("pipeline"), F.lit("success").alias("event")),
        )).alias("_m"), _instant(now).alias("at"),
    ).select("series_id", "_m.*", "at", F.lit(None).cast("string").alias("reason"))
    return RetrainOutcome(
        PROMOTED if moved else NOT_PROMOTED, due, marks, trained.runs, decisions, moves,
        # The aliases as they are after the move: the new champion's run stays, the old one may go.
        prunable_runs(runs, aliases.select(*moves.columns).unionByName(moves), now, keep_days),
        trained.by_version(moved["version"]) if moved else None,
    )


def record_retrain(outcome: RetrainOutcome, events_path: str, runs_path: str, decisions_path: str, aliases_path: str) -> None:
    """Append what a retrain did to its tables: runs first, the events that close it last."""
    for rows, path, schema in (
        (outcome.runs, runs_path, tables.RUNS), (outcome.decisions, decisions_path, tables.GATE_DECISIONS),
        (outcome.moves, aliases_path, tables.ALIASES), (outcome.events, events_path, tables.EVENTS),
    ):
        if rows is not None:
            tables.append(rows, path, schema)
