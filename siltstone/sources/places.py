"""File systems as tasks reach them: pyarrow's, for paths that it knows (local and mounted folders, HDFS, S3, GCS)."""

from __future__ import annotations

import posixpath
import re

from pyarrow import fs as pafs


def plain(path: str) -> str:
    """A path without the scheme of local files, however many slashes it has."""
    return re.sub(r"^file:/*", "/", path)


def reach(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path and the path in it."""
    path = plain(path)
    return (pafs.LocalFileSystem(), path) if path.startswith("/") else pafs.FileSystem.from_uri(path)


def reachable(path: str) -> bool:
    """Whether tasks can reach a path without Spark's readers."""
    try:
        reach(path)
    except Exception:  # a scheme, or a client library, that pyarrow has not
        return False
    return True


def files_below(path: str, suffix: str = "") -> list[tuple[str, int]]:
    """(path below the root, size) of the files whose name ends so, sorted."""
    where, root = reach(path)
    found = where.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
    return sorted((posixpath.relpath(f.path, root), f.size) for f in found if f.is_file and f.base_name.endswith(suffix))


def put(where: pafs.FileSystem, path: str, content: bytes) -> None:
    """A file, with the folders above it."""
    where.create_dir(posixpath.dirname(path), recursive=True)
    with where.open_output_stream(path) as out:
        out.write(content)


def replace(where: pafs.FileSystem, old: str, new: str, made: set[str] | None = None) -> None:
    """Move a file over whatever stands at its new place, in one step where the file system can. made: folders that are known to be there."""
    there = where.get_file_info(new).type
    if there == pafs.FileType.Directory:
        where.delete_dir(new)
    elif there == pafs.FileType.File and where.type_name not in ("local", "s3", "gcs"):
        where.delete_file(new)
    above = posixpath.dirname(new)
    if made is None or above not in made:
        where.create_dir(above, recursive=True)
        if made is not None:
            made.add(above)
    where.move(old, new)
