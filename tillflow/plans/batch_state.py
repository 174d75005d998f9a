"""What a derived state holds of the published batches."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tillflow.sinks import history


class BatchState:
    """A state below ``path`` that follows the batches of the order lines at ``lines``. Its
    manifest names each batch with the write of it that the state holds; the highest
    manifest that was written to its end counts."""

    def __init__(self, spark: SparkSession, path: str, lines: str):
        self.spark, self.path, self.lines = spark, path.rstrip("/"), lines

    @property
    def _folder(self) -> str:
        return f"{self.path}/_current"

    def _numbers(self) -> list[int]:
        return sorted((int(n.removesuffix(".json")) for n, _ in history.names(self.spark, self._folder)
                       if n.removesuffix(".json").isdigit()), reverse=True)

    def manifest(self) -> tuple[int, dict[str, str]]:
        """Its number (-1: there is none) and ``batch -> write``."""
        for n in self._numbers():
            try:
                return n, history.read_json(self.spark, f"{self._folder}/{n}.json")["batches"]
            except ValueError:
                continue
        return -1, {}

    def exists(self) -> bool:
        return self.manifest()[0] >= 0

    def changes(self) -> tuple[dict[str, str], list[str], list[str]]:
        """All published batches, those that the state has not or holds by another write,
        and those that are gone."""
        published = {b: history.run_of(m) for b, m in history.batches(self.spark, self.lines).items()}
        _, held = self.manifest()
        return published, sorted(b for b, run in published.items() if held.get(b) != run), sorted(b for b in held if b not in published)

    def store(self, number: int, batches: dict[str, str]) -> None:
        """Makes this the manifest; a second writer of the number fails."""
        history.write_json(self.spark, f"{self._folder}/{number}.json", {"batches": batches}, replace=False)
        for n in self._numbers():
            if n < number:
                history.delete(self.spark, f"{self._folder}/{n}.json")
