"""Atomic publication: data goes to fresh folders, and one small file, made only if it is not there yet, makes it visible.

A table under a root has ``data/part=…`` folders and numbered commits under ``_commits``. A commit names the folders that
hold the table's entries from then on, so readers see all of a write or none, a write that fails leaves nothing visible, and of two
writers at a time both get a number of their own and neither is lost. Data folders are never changed.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

#: A commit with such a number holds the whole state, so readers look at no more than so many.
STATE_EVERY = 50


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path and the path as its object."""
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def move_new(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a file or folder unless the target exists; false if it does."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop.fs
    fs, to = file_system(spark, target)
    if fs.exists(to):
        return False
    fs.mkdirs(to.getParent())
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(hadoop.Path(source), to, options)
    except Exception:
        # Lost to another writer, unless the target is not there either.
        if fs.exists(to):
            return False
        raise
    return True


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a whole file in one step unless it exists; false if it does.

    A local file is linked into its place, on other stores it is renamed there, so the store must rename in one step.
    """
    fs, target = file_system(spark, path)
    draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    if fs.getUri().getScheme() == "file":
        local, place = (file_system(spark, p)[1].toUri().getPath() for p in (draft, path))
        os.makedirs(os.path.dirname(place), exist_ok=True)
        with open(local, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(local, place)
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
        return True
    out = fs.create(file_system(spark, draft)[1], False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return move_new(spark, draft, path)


class CommitLog:
    """The commits of one table: which folder, relative to the root, holds each entry."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def draft(self) -> str:
        """A folder, relative to the root, that nothing has been written to."""
        return f"data/part={uuid.uuid4().hex}"

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def numbers(self) -> list[int]:
        fs, folder = file_system(self.spark, f"{self.root}/_commits")
        if not fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def _commit_path(self, number: int) -> str:
        return f"{self.root}/_commits/{number:012d}.json"

    def read(self, number: int) -> dict:
        """One commit: ``set`` and ``drop`` entries, ``note``, and in some the whole ``state``."""
        fs, path = file_system(self.spark, self._commit_path(number))
        stream = fs.open(path)
        try:
            return json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def state(self, numbers: list[int] | None = None) -> dict[str, str]:
        """The folder of every entry."""
        commits = []
        for number in reversed(self.numbers() if numbers is None else numbers):
            commits.append(self.read(number))
            if "state" in commits[-1]:
                break
        state: dict[str, str] = {}
        for commit in reversed(commits):
            state = dict(commit["state"]) if "state" in commit else _after(state, commit)
        return state

    def commit(self, entries: Mapping[str, str], drop: Iterable[str] = (), note: Mapping | None = None) -> int:
        """Make entries visible and others invisible, all at once; returns the commit's number.

        A commit says what changes, so what others commit meanwhile stays.
        """
        change = {"set": dict(entries), "drop": sorted(drop), "note": dict(note or {})}
        while True:
            numbers = self.numbers()
            number = numbers[-1] + 1 if numbers else 1
            content = dict(change)
            if number % STATE_EVERY == 0:
                content["state"] = _after(self.state(numbers), change)
            if create_once(self.spark, self._commit_path(number), json.dumps(content, default=str)):
                return number

    def frame(self, prefix: str = "") -> DataFrame:
        """The rows of all entries whose name begins with ``prefix``; their Parquet folders share a schema."""
        folders = sorted(self.path(f) for name, f in self.state().items() if name.startswith(prefix))
        if not folders:
            raise ValueError(f"nothing is published under {self.root}")
        return self.spark.read.option("basePath", f"{self.root}/data").parquet(*folders).drop("part")

    def unused(self) -> list[str]:
        """Data folders that no commit names any more, or not yet: of failed writes, of replaced entries, of writes going on."""
        fs, folder = file_system(self.spark, f"{self.root}/data")
        if not fs.exists(folder):
            return []
        named = {"/".join(f.split("/")[:2]) for f in self.state().values()}
        found = [f"data/{s.getPath().getName()}" for s in fs.listStatus(folder)]
        return sorted(f for f in found if f not in named)


def _after(state: Mapping[str, str], change: Mapping) -> dict[str, str]:
    return {k: v for k, v in state.items() if k not in set(change["drop"])} | dict(change["set"])
