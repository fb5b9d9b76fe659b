"""Logging of runs: one file with everything, the console with less, no secrets in either."""

from __future__ import annotations

import logging
import sys
from pathlib import Path

from sampleloom.run.outputs import sanitize

NAME = "sampleloom"


class Sanitized(logging.Filter):
    """Takes secrets and credentials out of every message."""

    def filter(self, record: logging.LogRecord) -> bool:
        record.msg, record.args = sanitize(record.getMessage(), 10_000), ()
        return True


def setup(path: str | Path | None, level: str = "INFO", quiet: bool = False) -> logging.Logger:
    """Logger of a run. The file gets all of ``level``; the console warnings alone if ``quiet``."""
    log = logging.getLogger(NAME)
    for h in list(log.handlers):
        log.removeHandler(h)
        h.close()
    log.setLevel(level)
    log.propagate = False
    handlers: list[logging.Handler] = [logging.StreamHandler(sys.stderr)]
    handlers[0].setLevel(logging.WARNING if quiet else level)
    if path is not None:
        handlers.append(logging.FileHandler(path, encoding="utf-8"))
    for h in handlers:
        h.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s %(message)s"))
        h.addFilter(Sanitized())
        log.addHandler(h)
    return log


def progress(spark, quiet: bool) -> None:
    """Spark's own progress bar on the console, or none."""
    spark.sparkContext.setLogLevel("ERROR" if quiet else "WARN")
