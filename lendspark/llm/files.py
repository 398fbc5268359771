"""Files that tasks write and read piecewise in the cluster's shared folder."""

from __future__ import annotations

from pyarrow import fs
from pyspark import TaskContext


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder named by a URI or by an absolute path."""
    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def attempt_name(suffix: str) -> str:
    """A file name that no other task and no other attempt at this task uses.

    Whoever commits the rows that name the file, commits the file; what failed or
    speculative attempts left is named nowhere.
    """
    task = TaskContext.get()
    return f"part-{task.partitionId():05d}-{task.stageId()}-{task.taskAttemptId()}{suffix}"
