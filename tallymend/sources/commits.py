"""A log of numbered commits below a folder, and what optimistic writers need.

A commit is one small file whose name is its number. It is created only if no
file of that name exists, so of two writers that want the same number one wins;
the other looks at what came between and decides whether its work still holds.
Data is written before its commit, in folders of its own, so nothing half
written is ever named. A file that a lost writer left incomplete names nothing.

The file system must create files exclusively, as HDFS and local disks do; on
an object store that takes a Hadoop connector which refuses to overwrite.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

EXISTS = "org.apache.hadoop.fs.FileAlreadyExistsException"


class Conflict(RuntimeError):
    """Another writer changed what this one's work rests on."""


class CommitLog:
    def __init__(self, spark: SparkSession, root: str):
        self.root, self._jvm = root, spark._jvm
        self._folder = self._jvm.org.apache.hadoop.fs.Path(f"{root}/commits")
        self._files = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    def numbers(self) -> list[int]:
        """Numbers that are taken, ascending."""
        if not self._files.exists(self._folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(self._folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")

    def latest(self) -> int:
        """The greatest number taken; 0 for none."""
        return max(self.numbers(), default=0)

    def _path(self, number: int):
        return self._jvm.org.apache.hadoop.fs.Path(self._folder, f"{number:020d}.json")

    def read(self, number: int) -> dict | None:
        """The facts of a commit; None if its file is incomplete."""
        stream = self._files.open(self._path(number))
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return json.loads(text)
        except ValueError:
            return None

    def newest_first(self) -> Iterator[tuple[int, dict]]:
        for number in reversed(self.numbers()):
            facts = self.read(number)
            if facts is not None:
                yield number, facts

    def folders(self, name: str) -> list[str]:
        """Names of the folders in folder ``name`` below the root, which exists."""
        within = self._files.listStatus(self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}"))
        return sorted(f.getPath().getName() for f in within if f.isDirectory())

    def try_commit(self, number: int, facts: dict) -> bool:
        """Create commit ``number``; False if another writer has it."""
        try:
            stream = self._files.create(self._path(number), False)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getName() == EXISTS:
                return False
            raise
        stream.write(bytearray(json.dumps(facts).encode()))
        stream.close()
        return True

    def commit(self, facts: dict, based_on: int | None = None, conflicts=None) -> int:
        """Create the next commit and return its number.

        With ``based_on``, the newest commit that the work has seen,
        ``conflicts`` is asked about every later one: a commit it objects to raises Conflict, any
        other is passed over and the next number is tried.
        """
        seen = self.latest() if based_on is None else based_on
        while True:
            for number in [n for n in self.numbers() if n > seen]:
                other = self.read(number)
                if conflicts and other is not None and conflicts(other):
                    raise Conflict(f"commit {number} came in between: {other}")
                seen = number
            if self.try_commit(seen + 1, facts):
                return seen + 1


def new_folder(name: str) -> str:
    """A folder's name that no other writer uses."""
    return f"{name}-{uuid.uuid4().hex}"
