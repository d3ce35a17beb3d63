"""Folders of a stored table that merge upward, as a log-structured tree does.

Every micro-batch has a folder ``open/batch_id=N``. Finished batches are gathered into one folder
``closed/through=N``, ``merge_every`` of those into one of ``level-1``, and so on. Readers take of
each level only the folders beyond the last finished one of the level above, so a loss at any
point, also between writing a merged folder and deleting what went into it, shows no row twice and
hides none.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession

from footfall.sources import folders

#: Writes the rows of some folders as one folder.
Gather = Callable[[list[str], str], None]


@dataclass(frozen=True)
class Levels:
    """The folders of one table below ``path``."""

    path: str
    merge_every: int = 8

    def open(self, batch_id: int) -> str:
        """The folder of one micro-batch."""
        return f"{self.path}/open/batch_id={batch_id}"

    @staticmethod
    def _kind(level: int) -> str:
        return f"level-{level}" if level else "closed"

    def _highest(self, spark: SparkSession) -> int:
        kinds = [k for k in folders.children(spark, self.path) if k.startswith("level-")]
        return max((int(k.split("-")[1]) for k in kinds), default=0)

    def _numbers(self, spark: SparkSession, level: int) -> list[int]:
        return folders.numbers(spark, f"{self.path}/{self._kind(level)}")

    def gathered(self, spark: SparkSession) -> list[str]:
        """The folders of finished batches to read, from the highest level to the lowest."""
        found, last = [], -1
        for level in range(self._highest(spark), -1, -1):
            known = [n for n in self._numbers(spark, level) if n > last]
            found += [f"{self.path}/{self._kind(level)}/through={n}" for n in known]
            last = max([last, *known])
        return found

    def pending(self, spark: SparkSession, through: int | None = None) -> list[str]:
        """The open folders to read, up to a batch: those that no gathered folder has."""
        last = max((int(path.rsplit("=", 1)[1]) for path in self.gathered(spark)), default=-1)
        known = [n for n in folders.numbers(spark, f"{self.path}/open") if n > last]
        return [self.open(n) for n in known if through is None or n <= through]

    def close(self, spark: SparkSession, through: int, gather: Gather) -> None:
        """Gather the open folders up to ``through`` and merge the levels that are full."""
        target = f"{self.path}/closed/through={through}"
        paths = self.pending(spark, through)
        if paths and not folders.finished(spark, target):
            gather(paths, target)
        last = max((int(path.rsplit("=", 1)[1]) for path in self.gathered(spark)), default=-1)
        for n in folders.numbers(spark, f"{self.path}/open"):
            if n <= last:
                folders.remove(spark, self.open(n))
        known = [self._numbers(spark, level) for level in range(self._highest(spark) + 1)]
        level = 0
        while level < len(known):
            kind = self._kind(level)
            above = max((n for higher in known[level + 1 :] for n in higher), default=-1)
            for n in known[level]:
                if n <= above:  # merged before a loss, not yet deleted
                    folders.remove(spark, f"{self.path}/{kind}/through={n}")
            beyond = [n for n in known[level] if n > above]
            if len(beyond) >= self.merge_every:
                paths = [f"{self.path}/{kind}/through={n}" for n in beyond]
                gather(paths, f"{self.path}/{self._kind(level + 1)}/through={beyond[-1]}")
                for path in paths:
                    folders.remove(spark, path)
                known += [[]] if level + 1 == len(known) else []
                known[level + 1].append(beyond[-1])
            level += 1
