"""Single objects of a store, read and written by the tasks themselves.

Spark's readers take folders; a blob is fetched by its digest. The file systems are those of
pyarrow: local paths, ``s3://``, ``gs://`` and ``hdfs://``, with the credentials that the machine has.
"""

from __future__ import annotations

import contextlib
import uuid

from pyarrow import fs


def open_root(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a root and the path of it there. ``s3a`` is ``s3``; a bare path is local."""
    scheme, mark, rest = root.partition("://")
    if not mark:
        return fs.LocalFileSystem(), root.removeprefix("file:").rstrip("/")
    if scheme == "file":
        return fs.LocalFileSystem(), rest.rstrip("/")
    system, path = fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")
    return system, path.rstrip("/")


def get(system: fs.FileSystem, path: str) -> bytes | None:
    """The bytes of an object; None if there is none."""
    try:
        with system.open_input_stream(path, compression=None) as stream:
            return stream.read()
    except FileNotFoundError:
        return None


def put(system: fs.FileSystem, path: str, data: bytes) -> bool:
    """Store an object unless it is there; whether it was stored. Readers see all of it or nothing: an
    object store does that by itself, elsewhere a file of another name is moved to its place."""
    if system.get_file_info(path).type == fs.FileType.File:
        return False
    whole = system.type_name in ("s3", "gcs")
    target = path if whole else f"{path}.{uuid.uuid4().hex}.part"
    if not whole:
        system.create_dir(path.rpartition("/")[0], recursive=True)
    with system.open_output_stream(target, compression=None) as stream:
        stream.write(data)
    if not whole:
        system.move(target, path)
    return True


def drop(system: fs.FileSystem, path: str) -> None:
    with contextlib.suppress(FileNotFoundError):
        system.delete_file(path)


def names(system: fs.FileSystem, path: str) -> list[str]:
    """Names of the folders in one, in order; [] if it is not there."""
    found = system.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(info.base_name for info in found if info.type == fs.FileType.Directory)
