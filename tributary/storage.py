"""Paths, small driver-side files and the shared work folder."""

from __future__ import annotations

import json
import os
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a local path or a ``scheme://`` URI."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    scheme, mark, rest = path.partition("://")
    # Spark's names for the store that pyarrow calls s3.
    return fs.FileSystem.from_uri(f"s3://{rest}" if mark and scheme in ("s3a", "s3n") else path)


def folder_bytes(path: str) -> int:
    """Bytes of the files below ``path``."""
    system, inner = resolve(path)
    entries = system.get_file_info(fs.FileSelector(inner, recursive=True))
    return sum(e.size for e in entries if e.is_file)


def file_names(path: str) -> list[str]:
    """Names of the files directly in ``path``, sorted; none if it is absent."""
    system, inner = resolve(path)
    entries = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(e.base_name for e in entries if e.is_file)


def folder_names(path: str) -> list[str]:
    """Names of the folders directly in ``path``."""
    system, inner = resolve(path)
    entries = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(e.base_name for e in entries if e.type == fs.FileType.Directory)


def remove_folder(path: str) -> None:
    """Remove a folder and all in it; no error if it is absent."""
    system, inner = resolve(path)
    if system.get_file_info(inner).type != fs.FileType.NotFound:
        system.delete_dir(inner)


def remove_file(path: str) -> None:
    system, inner = resolve(path)
    system.delete_file(inner)


def read_json(path: str) -> dict:
    system, inner = resolve(path)
    with system.open_input_stream(inner) as source:
        return json.loads(source.read())


def create_json(folder: str, name: str, value: dict) -> None:
    """Write a new small file in one step; a name in use is an error.

    Of several writers of one name exactly one succeeds: on a local disk by a
    hard link, elsewhere by Hadoop's rename, which does not overwrite (HDFS; an
    object store's rename is no single step, there one writer at a time is up to
    the caller).
    """
    system, inner = resolve(folder)
    system.create_dir(inner, recursive=True)
    target = f"{inner}/{name}"
    draft = f".{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(f"{inner}/{draft}") as sink:
        sink.write(json.dumps(value, sort_keys=True).encode())
    taken = FileExistsError(f"{folder}/{name} was written by another run")
    try:
        if isinstance(system, fs.LocalFileSystem):
            try:
                os.link(f"{inner}/{draft}", target)
            except FileExistsError:
                raise taken from None
        elif system.get_file_info(target).type != fs.FileType.NotFound or not _renamed(f"{folder}/{draft}", f"{folder}/{name}"):
            raise taken
    finally:
        if system.get_file_info(f"{inner}/{draft}").type != fs.FileType.NotFound:
            system.delete_file(f"{inner}/{draft}")


def _renamed(old: str, new: str) -> bool:
    """Rename by the session's Hadoop file system; false if ``new`` is there."""
    session = SparkSession.getActiveSession()
    hadoop = session._jvm.org.apache.hadoop.fs
    source = hadoop.Path(old)
    return source.getFileSystem(session._jsc.hadoopConfiguration()).rename(source, hadoop.Path(new))


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that all executors can reach.

    It lies in the folder named by ``spark.checkpoint.dir``. Only a local
    session, whose tasks share the driver's disk, may do without the setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="tributary-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
