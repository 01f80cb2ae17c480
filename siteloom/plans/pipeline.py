"""The whole run: impressions in, a new snapshot of the result table out."""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import batching, cache, classify, fetch, impressions, upsert

#: Days before today at which a window starts that isn't given, and where today is.
BACK, ZONE = 10, "US/Central"


@dataclass(frozen=True)
class Config:
    """start and end of the window, the run's name and time, batch size and cap, and whether views are reconciled.

    With several, an address may have several bodies, and each one's answer gives a row; else that is an error.
    With closed_references, character references count in texts with their semicolon only.
    """

    start: str | None
    end: str | None = None
    run_id: str = "run"
    now: str = "2024-02-01 00:00:00"
    batch_size: int = 1000
    batch_cap: int = 900
    skip_reconcile: bool = False
    several: bool = False
    closed_references: bool = False


def new_run_id(now: datetime.datetime, token: str | None = None) -> str:
    """A run's name: its time and eight hexadecimal digits."""
    return f"{now.astimezone(datetime.UTC):%Y%m%dT%H%M%SZ}_{token or uuid.uuid4().hex[:8]}"


def resolved(conf: Mapping | None = None, params: Mapping | None = None, now: datetime.datetime | None = None, run_id: str | None = None) -> Config:
    """A run's settings: from conf, else from params, else the last BACK days to today and the defaults."""
    now = now or datetime.datetime.now(datetime.UTC)
    given = {**(params or {}), **(conf or {})}
    today = now.astimezone(ZoneInfo(ZONE)).date()
    return Config(
        start=given.get("start_date", str(today - datetime.timedelta(days=BACK))), end=given.get("end_date", str(today)), run_id=run_id or new_run_id(now),
        now=f"{now.astimezone(datetime.UTC):%Y-%m-%d %H:%M:%S}", batch_size=int(given.get("batch_size", 1000)), batch_cap=int(given.get("max_batches_cap", 900)),
        skip_reconcile=bool(given.get("skip_reconcile", False)))


def at(config: Config):
    return F.lit(config.now).cast("timestamp_ntz")


def written(rows: DataFrame, path: str) -> DataFrame:
    """rows as a table of the run, read back; what a retry finds there is replaced."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def run(log: DataFrame, results: DataFrame, bodies: Callable[[DataFrame], DataFrame], categories: Callable[[DataFrame], DataFrame], config: Config, folder: str) -> DataFrame:
    """The result table after the run.

    bodies adds `body` to staged rows, from clients or a store; categories adds that column to rows with page_text.
    New addresses, their texts and the classified rows are tables in a folder named after the run, so each address is
    asked for and each text classified once, however often later steps read them.
    """
    own = f"{folder.rstrip('/')}/{config.run_id}"
    valid, _ = urls.transform(impressions.dedupe_with_hits(log, config.start, config.end))
    fresh, touches = cache.split(written(valid, f"{own}/valid"), results)
    fresh = written(fresh, f"{own}/fresh")
    touched = upsert.touch(results, touches, at(config))
    size, _ = batching.plan(fresh.count(), config.batch_size, config.batch_cap)
    texts = written(fetch.with_text(bodies(batching.assign(fresh, size, config.run_id)), config.closed_references), f"{own}/texts")
    rows = written(classify.classified(categories(texts), at(config)), f"{own}/classified")
    loaded = upsert.best_confidence(touched, rows, at(config), config.several)
    if config.skip_reconcile:
        return loaded
    return upsert.reconcile(loaded, impressions.lifetime_hits(log, upsert.loadable(rows)), at(config))


def write_snapshot(results: DataFrame, root: str, version: str) -> str:
    """Writes a new version beside the one that the plan may read, and gives its path."""
    path = f"{root.rstrip('/')}/version={version}"
    results.write.mode("errorifexists").parquet(path)
    return path
