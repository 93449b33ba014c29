"""Small tables that each micro-batch writes anew: the newest complete version counts, a repeated batch replaces its own."""

from __future__ import annotations

import posixpath

from pyarrow import fs as files
from pyspark.sql import DataFrame, SparkSession

from docketlake.places import place_of

KEPT = 3


class Versions:
    """Versions ``seq=<n>/part=<name>`` of a table, each complete in itself; ``_SUCCESS`` marks those that were finished.

    ``part`` names the batch that wrote a version. When the same batch runs again, after a failure between its writes
    and the commit of its offsets, it starts from the version before its own and writes the same place.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def listed(self) -> list[tuple[int, str]]:
        system, root = place_of(self.path)
        if system.get_file_info(root).type != files.FileType.Directory:
            return []
        found = system.get_file_info(files.FileSelector(root, recursive=True))
        done = [posixpath.relpath(f.path, root).split("/") for f in found if f.base_name == "_SUCCESS"]
        return sorted((int(seq.removeprefix("seq=")), part.removeprefix("part=")) for seq, part, _ in done)

    def _read(self, version: tuple[int, str]) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/seq={version[0]:09d}/part={version[1]}")

    def before(self, part: str) -> tuple[DataFrame | None, int]:
        """The newest version that ``part`` did not write, and the number that its own gets."""
        listed = self.listed()
        own = [seq for seq, name in listed if name == part]
        older = [v for v in listed if v[1] != part and (not own or v[0] < own[0])]
        return (self._read(older[-1]) if older else None), (older[-1][0] + 1 if older else 1)

    def latest(self) -> DataFrame | None:
        listed = self.listed()
        return self._read(listed[-1]) if listed else None

    def wrote(self, part: str) -> bool:
        """Whether the version of ``part`` is there, or has been; versions grow old in the order of their writing."""
        return any(name == part for _, name in self.listed())

    def write(self, df: DataFrame, part: str, seq: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/seq={seq:09d}/part={part}")
        system, root = place_of(self.path)
        for old, _ in self.listed()[:-KEPT]:
            folder = posixpath.join(root, f"seq={old:09d}")
            if system.get_file_info(folder).type == files.FileType.Directory:
                system.delete_dir(folder)
