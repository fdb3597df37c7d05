"""Running pipelines to completion, incrementally or from scratch."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import zip_longest


# Streams that run at once; the others of a stage wait for their turn.
STREAMS_AT_ONCE = 16


class RefreshError(RuntimeError):
    """Streams that failed, each by its name, with what it raised in ``failures``."""

    def __init__(self, failures: list[tuple[str, Exception]]) -> None:
        super().__init__("; ".join(f"{name}: {failure}" for name, failure in failures))
        self.failures = failures


def refresh(*pipelines, full: bool = False, at_once: int = STREAMS_AT_ONCE) -> None:
    """Bring all tables of the pipelines up to date.

    Incremental: each stream reads what arrived since its checkpoint. Full:
    every file still in the landing area is read again, into new generations of
    the tables, which take the place of the old ones when all are complete. The
    tables can be read all the while, and stay as they are if a stream fails.
    Streams of one stage run side by side, ``at_once`` of them, across pipelines
    too, so many small file types share the cluster. Failures, to start as well
    as later, are raised together as RefreshError once all streams of their
    stage have ended; later stages are not started then.
    """
    fed = pipelines
    if full:
        fed = [pipeline.beside() for pipeline in pipelines]
        for table in (table for pipeline in fed for table in pipeline.tables()):
            table.drop(pipelines[0].spark)  # what a failed refresh left
    for stage in zip_longest(*(pipeline.stages() for pipeline in fed), fillvalue=()):
        failures = run_streams([start for starters in stage for start in starters], at_once)
        if failures:
            raise RefreshError(failures)
    if full:
        for pipeline, built in zip(pipelines, fed):
            pipeline.take_over(built)


def run_streams(starters: list, at_once: int) -> list[tuple[str, Exception]]:
    """Start streams, at most ``at_once`` at a time, await them all, and return what failed."""
    failures: list[tuple[str, Exception]] = []

    def run(start) -> None:
        name = getattr(start, "__qualname__", repr(start))
        try:
            query = start()
            if query is not None:  # None: the work is done already
                name = query.name or name
                query.awaitTermination()
        except Exception as failure:  # every stream is reported, whatever another one does
            failures.append((name, failure))

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        list(pool.map(run, starters))
    return failures
