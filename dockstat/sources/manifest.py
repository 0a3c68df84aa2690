"""Commit pointers: which folders make up the current state of a table.

A writer puts its files into folders of its own, which nobody reads yet, and then commits a
manifest that names every folder of the new state.  The manifest is one small file, written
under another name and renamed, so readers see the old state or the new one and never
half of it; folders of a run that failed before its commit belong to no state and are
replaced when the run is repeated.

Manifests are numbered; the newest is the current one, the earlier ones stay until
:func:`forget` removes them together with the folders that no remaining manifest names.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dockstat.sources.sinks import _folder, children, remove

LOG = "_manifests"


def _names(spark: SparkSession, path: str) -> list[str]:
    return [n for n in children(spark, f"{path}/{LOG}") if n.isdigit()]


def _read(spark: SparkSession, file: str) -> dict[str, Any]:
    fs, at = _folder(spark, file)
    stream = fs.open(at)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def manifest(spark: SparkSession, path: str) -> dict[str, Any] | None:
    """The current manifest of a table, or None before its first commit."""
    names = _names(spark, path)
    return _read(spark, f"{path}/{LOG}/{names[-1]}") if names else None


def commit(spark: SparkSession, path: str, state: dict[str, Any]) -> None:
    """Make ``state`` the current manifest, in one rename."""
    names = _names(spark, path)
    number = int(names[-1]) + 1 if names else 0
    fs, draft = _folder(spark, f"{path}/{LOG}/.draft-{number:010d}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    finally:
        out.close()
    _, final = _folder(spark, f"{path}/{LOG}/{number:010d}")
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another run has committed to {path}; nothing was changed")


def forget(spark: SparkSession, path: str, folders, keep: int = 7) -> list[str]:
    """Drop all but the newest ``keep`` manifests, and the folders none of those names.

    ``folders(state)`` gives the folders of a manifest, relative to ``path``.  Returns the
    folders removed.
    """
    names = _names(spark, path)
    old, kept = names[:-keep], names[-keep:]
    live = {f for n in kept for f in folders(_read(spark, f"{path}/{LOG}/{n}"))}
    gone = sorted({f for n in old for f in folders(_read(spark, f"{path}/{LOG}/{n}"))} - live)
    for f in gone:
        remove(spark, f"{path}/{f}")
    for n in old:
        remove(spark, f"{path}/{LOG}/{n}")
    return gone


VERSION = "version"
WHOLE = ""


def _folders(state: dict[str, Any]) -> list[str]:
    return [f"{VERSION}={v}/{part}".rstrip("/") for part, v in state["parts"].items()]


def publish_table(df: DataFrame, path: str, partition_by: str | None = None, keep: int = 7) -> None:
    """Rebuild a mart table, or those of its partitions that are present in ``df``.

    The rows go into a fresh ``version=`` folder; then one manifest makes it current, which names the
    version of every partition.  Without ``partition_by`` the new rows are the whole table; with it the other
    partitions stay where they are, so re-running a day replaces that day.  A run that fails
    before its commit changes nothing, and is simply repeated: its folder is written anew.  ``df``
    may read the table itself.  The folders of the newest ``keep`` states stay for readers.
    """
    spark, old = df.sparkSession, manifest(df.sparkSession, path)
    number = 0 if old is None else old["number"] + 1
    folder = f"{path}/{VERSION}={number}"
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(folder)
    if partition_by:
        kept = {} if old is None else {p: v for p, v in old["parts"].items() if p != WHOLE}
        parts = kept | {p: number for p in children(spark, folder) if p.startswith(f"{partition_by}=")}
    else:
        parts = {WHOLE: number}
    commit(spark, path, {"number": number, "parts": parts, "schema": df.schema.jsonValue()})
    forget(spark, path, _folders, keep)


def published(spark: SparkSession, path: str) -> bool:
    return manifest(spark, path) is not None


def read_published(spark: SparkSession, path: str, parts: list[str] | None = None) -> DataFrame:
    """The current state of a published table; ``parts`` picks partition folders (``column=value``) of it."""
    state = manifest(spark, path)
    if state is None:
        raise FileNotFoundError(f"nothing has been published to {path}")
    if parts is not None:
        state["parts"] = {p: v for p, v in state["parts"].items() if p in parts}
    schema = T.StructType.fromJson(state["schema"])
    if not state["parts"]:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path) \
        .parquet(*[f"{path}/{f}" for f in _folders(state)]).select(*schema.names)


def newest_part(spark: SparkSession, path: str, column: str) -> str | None:
    """The published partition with the greatest value of ``column``, as ``column=value``."""
    state = manifest(spark, path) or {"parts": {}}
    return max((p for p in state["parts"] if p.startswith(f"{column}=") and not p.endswith("__HIVE_DEFAULT_PARTITION__")),
               default=None)
