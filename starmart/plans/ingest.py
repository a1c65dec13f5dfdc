"""Loading the raw tables from a source, in full or behind the stored watermark."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession

from starmart.params import DEFAULT_LOOKBACK_DAYS, DEFAULT_WATERMARK
from starmart.sources import normalize, readers, sinks, watermark
from starmart.sources.registry import DATASETS, INCREMENTAL, Dataset


class TooManyRejects(ValueError):
    """A load was refused: in some column too large a share of the values did not parse."""


@dataclass(frozen=True)
class Load:
    """What a load did: its new watermark, if the dataset keeps one, and per column the values that came and that did
    not parse."""

    watermark: dt.date | dt.datetime | None
    rejects: dict[str, tuple[int, int]]


def load(
    spark: SparkSession,
    dataset: Dataset,
    source: readers.Source,
    root: str,
    batch_ts: dt.datetime | None = None,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    default_watermark: dt.datetime = DEFAULT_WATERMARK,
    most_rejected: float = 1.0,
) -> Load:
    """Load one dataset.

    Rejects are counted by the job that writes the rows. If in some column more than ``most_rejected`` of the values that
    came did not parse, TooManyRejects is raised and the batch is no part of the table. The rows are written first and the watermark after: a run that stops in between loads the same
    rows again, and staging keeps one copy of each.
    """
    batch_ts = batch_ts or dt.datetime.now(dt.timezone.utc)
    incremental = dataset.load_type == INCREMENTAL
    if incremental:
        watermark.create_watermark_log(spark, root)
        log = watermark.watermark_log(spark, root)
        known = watermark.get_watermark(log, dataset.target, default_watermark)
        rows = readers.extract_incremental(source, spark, dataset, known, lookback_days)
    else:
        rows = readers.extract_full(source, spark, dataset)
    rows, rejects = normalize.observe_rejects(rows, dataset.schema)
    batch = normalize.prepare(rows, dataset.schema, batch_ts)
    column = dataset.watermark_column if incremental else None

    def accept() -> None:
        bad = {name: f"{lost} of {came}" for name, (came, lost) in rejects().items() if lost > most_rejected * came}
        if bad:
            raise TooManyRejects(f"{dataset.target}: values that do not parse: {bad}")

    reached = sinks.write_batch(batch, root, dataset.target, dataset.load_type, column, accept)
    if incremental:
        watermark.update_watermark(spark, root, dataset.target, reached, batch_ts)
    return Load(reached, rejects())


def ingest(
    spark: SparkSession,
    dataset: Dataset,
    source: readers.Source,
    root: str,
    batch_ts: dt.datetime | None = None,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    default_watermark: dt.datetime = DEFAULT_WATERMARK,
) -> dt.date | dt.datetime | None:
    """Load one dataset and return its new watermark, if it keeps one."""
    return load(spark, dataset, source, root, batch_ts, lookback_days, default_watermark).watermark


def ingest_all(
    spark: SparkSession,
    source: readers.Source,
    root: str,
    batch_ts: dt.datetime | None = None,
    lookback_days: int = DEFAULT_LOOKBACK_DAYS,
    default_watermark: dt.datetime = DEFAULT_WATERMARK,
    most_rejected: float = 1.0,
) -> dict[str, Load]:
    """All six datasets, by name; an earlier ``default_watermark`` lets a first load reach further back."""
    return {
        name: load(spark, dataset, source, root, batch_ts, lookback_days, default_watermark, most_rejected)
        for name, dataset in DATASETS.items()
    }
