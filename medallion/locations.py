"""Where the pipeline reads and writes, and where intermediate tables go."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Paths:
    """Input and output locations of one pipeline; any Hadoop file system URI works."""

    gen_info_raw: str
    readmissions_raw: str
    gen_info: str
    readmissions: str
    gold: str
    snapshot: str

    @classmethod
    def under(cls, root: str) -> Paths:
        root = root.rstrip("/")
        return cls(
            gen_info_raw=f"{root}/raw/gen_info",
            readmissions_raw=f"{root}/raw/readmissions",
            gen_info=f"{root}/silver/gen_info",
            readmissions=f"{root}/silver/readmissions",
            gold=f"{root}/gold/merged",
            snapshot=f"{root}/snapshot",
        )

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Paths:
        """``MEDALLION_ROOT`` plus an optional ``MEDALLION_<FIELD>`` for each single location."""
        default = cls.under(env.get("MEDALLION_ROOT", "medallion-data"))
        return cls(
            **{
                field: env.get(f"MEDALLION_{field.upper()}", getattr(default, field))
                for field in cls.__dataclass_fields__
            }
        )


def scratch_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for intermediate tables, deleted when the application ends.

    It lies in the shared folder named by ``spark.checkpoint.dir``, so that tables in it outlive
    lost executors. Only a local session, whose executors all see the same disk, may do without.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        folder = f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix=f"medallion-{purpose}-")
    else:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path, file_system = _hadoop(spark, folder)
    file_system.mkdirs(path)
    file_system.deleteOnExit(path)
    return folder


def discard(spark: SparkSession, folder: str) -> None:
    """Delete a scratch folder before the application ends."""
    path, file_system = _hadoop(spark, folder)
    file_system.delete(path, True)


def exists(spark: SparkSession, place: str) -> bool:
    """Whether a file or folder is there."""
    path, file_system = _hadoop(spark, place)
    return file_system.exists(path)


def make_folder(spark: SparkSession, folder: str) -> None:
    """Create a folder and those above it, unless it is there."""
    path, file_system = _hadoop(spark, folder)
    file_system.mkdirs(path)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a full URI, so that two spellings of a place compare equal."""
    path, file_system = _hadoop(spark, folder)
    return file_system.makeQualified(path).toString().rstrip("/")


def subfolders(spark: SparkSession, folder: str) -> list[str]:
    """Full URIs of the folders right below ``folder``."""
    path, file_system = _hadoop(spark, folder)
    if not file_system.exists(path):
        return []
    return [str(s.getPath()) for s in file_system.listStatus(path) if s.isDirectory()]


def write_text(spark: SparkSession, place: str, text: str) -> None:
    """Replace a small file."""
    path, file_system = _hadoop(spark, place)
    stream = file_system.create(path, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def read_text(spark: SparkSession, place: str) -> str | None:
    """A small file as text; None where there is none."""
    path, file_system = _hadoop(spark, place)
    if not file_system.exists(path):
        return None
    stream = file_system.open(path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def file_states(spark: SparkSession, folder: str) -> dict[str, tuple[int, int]]:
    """Name of each file right in ``folder``, with its length and time of change."""
    path, file_system = _hadoop(spark, folder)
    if not file_system.exists(path):
        return {}
    files = [s for s in file_system.listStatus(path) if s.isFile()]
    return {s.getPath().getName(): (s.getLen(), s.getModificationTime()) for s in files}


def can_join_files(spark: SparkSession, folder: str) -> bool:
    """Whether the file system of ``folder`` can make one file of several."""
    path, file_system = _hadoop(spark, folder)
    if file_system.getScheme() == "file":
        return True
    return file_system.hasPathCapability(path, "fs.capability.paths.concat")


def join_files(spark: SparkSession, sources: list[str], target: str) -> None:
    """One file of the sources' bytes, in their order; the sources may be gone after.

    A distributed file system links the sources' blocks behind those of the first. The local one
    copies bytes through a small buffer.
    """
    path, file_system = _hadoop(spark, target)
    file_system.mkdirs(path.getParent())
    if file_system.getScheme() == "file":
        out = file_system.create(path, True)
        try:
            for source in sources:
                stream = file_system.open(_hadoop(spark, source)[0])
                spark._jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, 1 << 20, False)
                stream.close()
        finally:
            out.close()
        return
    file_system.rename(_hadoop(spark, sources[0])[0], path)
    if rest := sources[1:]:
        paths = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(rest))
        for k, source in enumerate(rest):
            paths[k] = _hadoop(spark, source)[0]
        file_system.concat(path, paths)


def replace_folder(spark: SparkSession, folder: str, target: str) -> None:
    """Move a folder to a place and delete what was there."""
    path, file_system = _hadoop(spark, folder)
    place = _hadoop(spark, target)[0]
    file_system.delete(place, True)
    file_system.mkdirs(place.getParent())
    if not file_system.rename(path, place):
        raise OSError(f"{folder} could not be moved to {target}")


def _hadoop(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
