"""Versions of the catalogue's state (blogs, issues, feed list): a job reads one and writes the next beside it.

A version is a folder with a table for each name, and a manifest, a small file with the version's number that is put
in place by a rename when all tables are written. A reader takes the last manifest and keeps its folder,
whatever is written meanwhile. A job that fails leaves the last version as it was, and of two jobs that started from one
version the later can't put its manifest in place: it has to start again from the new one. The rename must be atomic
and refuse an existing file, as it is in file systems; plain object stores need a committer that makes it so.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from feedmill.sources import tables as T


class Outdated(Exception):
    """Another job has written the next version."""


@dataclass(frozen=True)
class Version:
    """note: a few values that the writer keeps with the version."""

    number: int
    folder: str
    note: dict

    def table(self, name: str) -> str:
        return f"{self.folder}/{name}"


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _names(spark: SparkSession, path: str) -> list[str]:
    system, at = _files(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(at)) if system.exists(at) else []


def _read(spark: SparkSession, path: str) -> str:
    system, at = _files(spark, path)
    stream = system.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def latest(spark: SparkSession, path: str) -> Version | None:
    """The last complete version of a state; None before the first."""
    numbers = [n for n in _names(spark, f"{path}/manifests") if n.isdigit()]
    if not numbers:
        return None
    held = json.loads(_read(spark, f"{path}/manifests/{numbers[-1]}"))
    return Version(int(numbers[-1]), f"{path}/{held['folder']}", held["note"])


def commit(spark: SparkSession, path: str, base: Version | None, write: Callable[[str], None], note: dict | None = None) -> Version:
    """The version after base: write fills its folder, then the manifest is put in place. Raises Outdated if base isn't the last one any more.

    Where write fails, its folder is deleted and nothing has changed.
    """
    number, folder = (base.number if base else 0) + 1, f"version-{uuid.uuid4().hex}"
    system, at = _files(spark, f"{path}/{folder}")
    try:
        write(f"{path}/{folder}")
        manifest, draft = f"{path}/manifests/{number:012d}", f"{path}/manifests/.{folder}"
        if not system.exists(_files(spark, f"{path}/manifests")[1]):
            system.mkdirs(_files(spark, f"{path}/manifests")[1])
        out = system.create(_files(spark, draft)[1], False)
        out.write(json.dumps({"folder": folder, "note": note or {}}).encode())
        out.close()
        _rename(spark, draft, manifest)
    except BaseException:
        system.delete(at, True)
        raise
    return Version(number, f"{path}/{folder}", note or {})


def _rename(spark: SparkSession, draft: str, manifest: str) -> None:
    fs = spark._jvm.org.apache.hadoop.fs
    source, target = fs.Path(draft), fs.Path(manifest)
    context = fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(fs.Options.Rename, 1)
    options[0] = fs.Options.Rename.NONE
    try:
        context.rename(source, target, options)
    except Py4JJavaError as error:
        context.delete(source, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise Outdated(f"version {int(target.getName())} is there already") from error
        raise


def expire(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete all versions but the last keep, and what failed jobs left; returns how many folders went. Not while another job writes or reads an older one."""
    numbers = [n for n in _names(spark, f"{path}/manifests") if n.isdigit()]
    kept = {json.loads(_read(spark, f"{path}/manifests/{n}"))["folder"] for n in numbers[-keep:]}
    gone = [n for n in _names(spark, path) if n.startswith("version-") and n not in kept]
    for name in [f"manifests/{n}" for n in numbers[:-keep]] + gone:
        system, at = _files(spark, f"{path}/{name}")
        system.delete(at, True)
    return len(gone)


@dataclass
class State:
    """The tables of a version, and of what else it holds by name."""

    blogs: DataFrame
    issues: DataFrame
    feed_list: DataFrame
    others: dict[str, DataFrame]


def read_state(spark: SparkSession, version: Version) -> State:
    """blogs and feed_list with their numbers in file order; feed_list has line_no and url."""
    listed = T.read_feed_list(spark, version.table("feed_list")).withColumnRenamed("line", "url")
    others = {n.removeprefix("other-"): spark.read.parquet(version.table(n)) for n in _names(spark, version.folder) if n.startswith("other-")}
    return State(T.read_blogs_csv(spark, version.table("blogs")), T.read_issues(spark, version.table("issues")), listed, others)


def write_state(spark: SparkSession, path: str, base: Version | None, state: State, note: dict | None = None) -> Version:
    """The next version from whole tables, which may come from base itself."""

    def write(folder: str) -> None:
        T.write_blogs_csv(state.blogs, f"{folder}/blogs")
        T.write_issues(state.issues, f"{folder}/issues")
        T.write_feed_list(state.feed_list, f"{folder}/feed_list")
        for name, table in state.others.items():
            table.write.parquet(f"{folder}/other-{name}")

    return commit(spark, path, base, write, note)
