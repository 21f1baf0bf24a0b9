"""A job in stages whose results are kept, so that a second run starts at the first stage that is out of date.

A stage's fingerprint is made of its name, its version and parameters, and the fingerprints of what it reads; that of a
source is made of the names, sizes and times of its files. A result is written first and its manifest after it, so a
killed run leaves results that nobody reads and never half a result.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.sinks.manifests import SharedFiles, add_version, newest
from millrace.sinks.tables import dependency_order

MANIFESTS = "_stages"


@dataclass(frozen=True)
class Stage:
    """``run`` gets the frames of ``needs``, in order, and ``params`` by name. Raise ``version`` when its code changes."""

    name: str
    run: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    params: dict = field(default_factory=dict)
    version: int = 1


@dataclass(frozen=True)
class Source:
    """Files that stages read. ``read`` gets the session and the path."""

    name: str
    path: str
    read: Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class StagedRun:
    paths: dict[str, str]       # where each stage's result is
    executed: list[str]         # the stages that ran this time


def _digest(*parts) -> str:
    return hashlib.sha256(json.dumps(parts, sort_keys=True, default=str).encode()).hexdigest()


def run_stages(spark: SparkSession, root: str, sources: list[Source], stages: list[Stage]) -> StagedRun:
    """Run what is out of date below ``root``, in the order of what needs what."""
    files = SharedFiles(spark)
    by_name = {s.name: s for s in [*sources, *stages]}
    if len(by_name) < len(sources) + len(stages):
        raise ValueError("two sources or stages have one name")
    unknown = {need for s in stages for need in s.needs} - set(by_name)
    if unknown:
        raise ValueError(f"no source or stage is named {', '.join(sorted(unknown))}")
    prints = {s.name: _digest(s.name, files.sizes(s.path)) for s in sources}
    paths, executed = {}, []

    def frame(name: str) -> DataFrame:
        one = by_name[name]
        return one.read(spark, one.path) if isinstance(one, Source) else spark.read.parquet(paths[name])

    for name in dependency_order({s.name: s.needs for s in stages}):
        stage = by_name[name]
        prints[name] = _digest(name, stage.version, stage.params, [prints[need] for need in stage.needs])
        folder = f"{root}/{MANIFESTS}/{name}"
        last = newest(files, folder)
        if last and last[1]["fingerprint"] == prints[name] and files.exists(last[1]["path"]):
            paths[name] = last[1]["path"]
            continue
        path = f"{root}/{name}/{prints[name][:16]}-{uuid.uuid4().hex[:8]}"
        stage.run(*[frame(need) for need in stage.needs], **stage.params).write.parquet(path)
        add_version(files, folder, last[0] + 1 if last else 0, {"fingerprint": prints[name], "path": path})
        paths[name] = path
        executed.append(name)
    return StagedRun(paths, executed)
