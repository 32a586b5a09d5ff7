"""Run folders: what one run writes lies together, and readers see a whole run or the one before.

A run writes into a folder of its own, ``runs/<id>``. When all of it is there, a manifest that lists
its outputs is put beside the folders, by one rename. Readers go by the newest manifest; a run that
stopped midway has none and is never read. Ids begin with the time a run started, so that of two
runs the one begun later wins.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import SparkSession

FOLDERS = "runs"
MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Run:
    out_path: str
    run_id: str

    @property
    def folder(self) -> str:
        return f"{self.out_path}/{FOLDERS}/{self.run_id}"

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}"


def new_run(out_path: str) -> Run:
    """A run with a name of its own; nothing is written yet."""
    started = datetime.now(UTC).strftime("%Y%m%dT%H%M%S%f")
    return Run(out_path.rstrip("/"), f"{started}-{uuid.uuid4().hex[:8]}")


def _files(spark: SparkSession, path: str):
    """A path and its file system, whichever kind of store it names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, run: Run, outputs: Mapping[str, str]) -> None:
    """List the outputs of a finished run; from now on readers see it."""
    prefix = f"{run.folder}/"
    strange = [path for path in outputs.values() if not path.startswith(prefix)]
    if strange:
        raise ValueError(f"outputs outside the folder of the run: {strange}")
    # Kept relative, so that a copy of the whole output reads its own tables.
    listed = {name: path[len(run.out_path) + 1 :] for name, path in outputs.items()}
    text = json.dumps({"run_id": run.run_id, "outputs": listed}, sort_keys=True)
    draft, files = _files(spark, f"{run.out_path}/{MANIFESTS}/.{run.run_id}.draft")
    final, _ = _files(spark, f"{run.out_path}/{MANIFESTS}/{run.run_id}.json")
    stream = files.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not files.rename(draft, final):
        raise OSError(f"could not publish run {run.run_id}")


def published_runs(spark: SparkSession, out_path: str) -> list[str]:
    """Ids of the finished runs, oldest first."""
    place, files = _files(spark, f"{out_path.rstrip('/')}/{MANIFESTS}")
    if not files.exists(place):
        return []
    names = [status.getPath().getName() for status in files.listStatus(place)]
    return sorted(n.removesuffix(".json") for n in names if n.endswith(".json") and not n.startswith("."))


def published_outputs(spark: SparkSession, out_path: str, run_id: str | None = None) -> dict[str, str] | None:
    """Paths by name of a finished run, of the newest one by default; None where there is none."""
    out_path = out_path.rstrip("/")
    if run_id is None:
        finished = published_runs(spark, out_path)
        if not finished:
            return None
        run_id = finished[-1]
    place, files = _files(spark, f"{out_path}/{MANIFESTS}/{run_id}.json")
    if not files.exists(place):
        return None
    stream = files.open(place)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {name: f"{out_path}/{path}" for name, path in json.loads(text)["outputs"].items()}


def published_path(spark: SparkSession, path: str, name: str) -> str:
    """Where ``name`` is in the newest run under ``path``; ``path`` itself where it holds no runs."""
    outputs = published_outputs(spark, path)
    return path if outputs is None else outputs[name]


def discard(spark: SparkSession, run: Run) -> None:
    """Remove what an unfinished run has written; a finished one is left alone."""
    if run.run_id in published_runs(spark, run.out_path):
        raise ValueError(f"run {run.run_id} is published")
    place, files = _files(spark, run.folder)
    files.delete(place, True)


def expire_runs(spark: SparkSession, out_path: str, keep: int = 2) -> list[str]:
    """Remove all but the newest ``keep`` finished runs, manifest first; the ids of those removed.

    Unfinished runs stay, since another job may be writing them.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    old = published_runs(spark, out_path)[:-keep]
    for run_id in old:
        run = Run(out_path.rstrip("/"), run_id)
        for path in (f"{run.out_path}/{MANIFESTS}/{run_id}.json", run.folder):
            place, files = _files(spark, path)
            files.delete(place, True)
    return old
