"""The model a running stream scores with, replaced between batches when a newer one appears."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tasteloom.plans.bundle import Bundle
from tasteloom.sources import registry

# Fixed value: seconds between two looks at the table of runs.
CHECK_EVERY = 3600

log = logging.getLogger(__name__)


class NoModel(LookupError):
    """The table of runs has no version of the model."""


class ModelCache:
    """Loads the highest version at once, and fails if there is none. Later looks happen at
    most once per ``check_every`` seconds; if one fails the model in use stays."""

    def __init__(
        self, spark: SparkSession, runs: str, name: str = registry.MODEL_NAME,
        check_every: float = CHECK_EVERY, clock: Callable[[], float] = time.monotonic,
        load: Callable[[SparkSession, str], Bundle] = Bundle.load,
    ):
        self._spark, self._runs, self._name = spark, runs, name
        self._check_every, self._clock, self._load = check_every, clock, load
        self.version: int | None = None
        self._bundle: Bundle | None = None
        self._refresh()

    def current(self) -> Bundle:
        if self._clock() - self._checked >= self._check_every:
            try:
                self._refresh()
            except Exception:
                log.exception("keeping model version %s", self.version)
        return self._bundle

    def _refresh(self) -> None:
        self._checked = self._clock()
        runs = registry.read(self._spark, self._runs).where(F.col("name") == self._name)
        newest = registry.latest(runs).first()
        if newest is None:
            raise NoModel(self._name)
        if newest["version"] == self.version:
            return
        fresh = self._load(self._spark, newest["path"]).persist()
        old, self._bundle, self.version = self._bundle, fresh, newest["version"]
        if old is not None:
            old.unpersist()
