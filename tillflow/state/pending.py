"""Runs that are under way, so that one that was cut off can be finished or undone.

A run puts a small file here before it writes its batch (``writing``), changes it when the
batch has passed its checks (``checked``, with the mark that it reached) and removes it
when the stored mark has moved. The ``run`` in the file is also in the batch's marks, so
a later run can see whether that very batch was published.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillflow.sinks.history import delete, names, read_json, write_json

WRITING, CHECKED = "writing", "checked"


class PendingRuns:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _file(self, run: str) -> str:
        return f"{self.path}/{run}.json"

    def put(self, run: str, **entry) -> None:
        write_json(self.spark, self._file(run), {"run": run, **entry})

    def remove(self, run: str) -> None:
        delete(self.spark, self._file(run))

    def entries(self) -> list[dict]:
        """The runs under way, oldest first. A file that was cut off itself says nothing
        and is left out: its run had written no row yet, or still has its older file."""
        found = []
        for name, changed in names(self.spark, self.path):
            if name.endswith(".json"):
                try:
                    found.append((changed, name, read_json(self.spark, f"{self.path}/{name}")))
                except ValueError:
                    continue
        return [entry for _, _, entry in sorted(found, key=lambda x: x[:2]) if entry]
