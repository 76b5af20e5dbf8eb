"""The state of a store as numbered files, each created only if it is absent."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import SparkSession

from gaugeflow.sources import files


class Conflict(Exception):
    """Another writer changed what a change was based on."""


class CommitLog:
    """One small JSON document with a number; a change writes the next number.

    Two writers cannot create the same number: the one that comes second applies its change to the
    other's state. The last ``keep`` files stay, so a folder listing has a bounded length.
    """

    def __init__(self, spark: SparkSession, folder: str, keep: int = 50) -> None:
        self.spark = spark
        self.folder = folder
        self.keep = keep

    def _numbers(self) -> list[int]:
        found = (name.removesuffix(".json") for name in files.names(self.spark, self.folder))
        return sorted(int(name) for name in found if name.isdigit())

    def _file(self, number: int) -> str:
        return f"{self.folder}/{number:012d}.json"

    def read(self) -> tuple[int, dict]:
        """Number and state of the newest commit; 0 and an empty state before the first."""
        numbers = self._numbers()
        if not numbers:
            return 0, {}
        return numbers[-1], json.loads(files.read_text(self.spark, self._file(numbers[-1])))

    def commit(self, change: Callable[[dict], dict]) -> dict:
        """Applies ``change`` to the newest state until it could be written as the next one.

        ``change`` gets a state of its own to alter and may raise `Conflict`.
        """
        while True:
            number, state = self.read()
            new = change(state)
            if not files.create_text(self.spark, self._file(number + 1), json.dumps(new)):
                continue
            numbers = self._numbers()
            # A writer that slept while its number was used and removed has not committed.
            if numbers[-1] > number + self.keep // 2:
                files.delete(self.spark, self._file(number + 1))
                continue
            for old in numbers[: -self.keep]:
                files.delete(self.spark, self._file(old))
            return new
