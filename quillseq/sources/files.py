"""Files by path, local or in a store that Arrow's file systems reach, for code that runs in tasks."""

from __future__ import annotations

import re
import uuid

from pyarrow import fs as arrow_fs


def local(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def at(path: str) -> tuple[arrow_fs.FileSystem, str]:
    """The file system of a path, and the path in it."""
    if re.match(r"[a-z][a-z0-9+.-]+://", path) and not path.startswith("file:"):
        return arrow_fs.FileSystem.from_uri(path)
    return arrow_fs.LocalFileSystem(), local(path)


def size(path: str) -> int:
    fs, p = at(path)
    return fs.get_file_info(p).size or 0


def exists(path: str) -> bool:
    fs, p = at(path)
    return fs.get_file_info(p).type != arrow_fs.FileType.NotFound


def listed(path: str, *endings: str) -> list[str]:
    """Files of a folder whose names have one of the endings, in order of name; folders within are not entered."""
    fs, p = at(path)
    info = fs.get_file_info(arrow_fs.FileSelector(p, allow_not_found=True))
    scheme = path[: len(path) - len(p)] if path.endswith(p) else ""
    return sorted(scheme + x.path for x in info if x.is_file and (not endings or x.path.endswith(endings)))


def remove(path: str) -> None:
    fs, p = at(path)
    fs.delete_file(p)


def is_dir(path: str) -> bool:
    fs, p = at(path)
    return fs.get_file_info(p).type == arrow_fs.FileType.Directory


def copied(parts: list[str], target: str, last: bytes = b"", piece: int = 8 << 20) -> int:
    """Joins parts, in order, to a file in a folder that is there: under another name first, so that a task that ends early leaves no half of it."""
    fs, to = at(target)
    folder, _, name = to.rpartition("/")
    held, n = f"{folder}/.{name}.{uuid.uuid4().hex}", 0
    with fs.open_output_stream(held, compression=None) as out:
        for part in parts:
            source, p = at(part)
            with source.open_input_stream(p, compression=None) as f:
                while b := f.read(piece):
                    out.write(b)
                    n += len(b)
        if last:
            out.write(last)
    fs.move(held, to)
    return n + len(last)
