"""Which folders of a loaded table are live: small files of loads, merged files of dates.

A table ``target`` has
* ``open=<g>/fecha=…/load=…``: what loads wrote since generation ``g`` began;
* ``merged=<g>/fecha=…``: all rows of a date, merged when generation ``g`` began;
* ``_manifest/<g>.json``: the generation in which each merged date was merged last.

The manifest with the largest number counts.  It appears by one rename, so readers
see either the small files or the merged ones, never both and never neither.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from rotativa.session import folder_exists


@dataclass(frozen=True)
class Manifest:
    """The current generation, and for each merged date the generation whose files hold it."""

    generation: int = 0
    merged: dict[str, int] = field(default_factory=dict)

    def open_folder(self, target: str) -> str:
        return f"{target}/open={self.generation}"

    def merged_folders(self, target: str) -> dict[str, list[str]]:
        """For each folder of merged dates those of its subfolders that are live."""
        folders = defaultdict(list)
        for date, generation in sorted(self.merged.items()):
            root = f"{target}/merged={generation}"
            folders[root].append(f"{root}/fecha={date}")
        return dict(folders)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def read_manifest(spark: SparkSession, target: str) -> Manifest:
    """The live manifest; a table that was never compacted is in generation 0."""
    folder, system = _place(spark, f"{target}/_manifest")
    if not system.exists(folder):
        return Manifest()
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    numbers = [int(name.removesuffix(".json")) for name in names if name.removesuffix(".json").isdigit()]
    if not numbers:
        return Manifest()
    stream = system.open(_place(spark, f"{target}/_manifest/{max(numbers)}.json")[0])
    try:
        held = json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()
    return Manifest(held["generation"], held["merged"])


def swap_manifest(spark: SparkSession, target: str, following: Manifest) -> None:
    """Make ``following`` the live manifest; fails if another one took its number in the meantime."""
    path = f"{target}/_manifest/{following.generation}.json"
    draft, system = _place(spark, f"{target}/_manifest/.draft-{uuid.uuid4().hex}")
    stream = system.create(draft)
    try:
        stream.write(bytearray(json.dumps({"generation": following.generation, "merged": following.merged}).encode()))
    finally:
        stream.close()
    if folder_exists(spark, path) or not system.rename(draft, _place(spark, path)[0]):
        system.delete(draft, False)
        raise RuntimeError(f"generation {following.generation} of {target} exists: another compaction was faster")


def retired_folders(spark: SparkSession, target: str, live: Manifest, before: Manifest) -> list[str]:
    """Folders that neither of two manifests reads."""
    needed = {m.open_folder(target).rpartition("/")[2] for m in (live, before)}
    dates = {path for m in (live, before) for paths in m.merged_folders(target).values() for path in paths}
    found = []
    root, system = _place(spark, target)
    for status in system.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("open=") and name not in needed:
            found.append(f"{target}/{name}")
        elif name.startswith("merged="):
            children = [f"{target}/{name}/{s.getPath().getName()}" for s in system.listStatus(status.getPath())]
            held = [path for path in children if path in dates]
            found += [path for path in children if "/fecha=" in path and path not in dates] if held else [f"{target}/{name}"]
    return found
