"""Where files are: the file system and path of a uri, for what is done to whole files outside of Spark's readers."""

from __future__ import annotations

from urllib.parse import unquote, urlsplit

from pyarrow import fs as files


def place_of(path: str) -> tuple[files.FileSystem, str]:
    """The file system and the path in it, of a local path or a uri."""
    if path.startswith("file:"):
        path = unquote(urlsplit(path).path)
    return files.FileSystem.from_uri(path) if "://" in path else (files.LocalFileSystem(), path)


def remove_folder(path: str) -> bool:
    """Whether there was one."""
    system, root = place_of(path)
    if system.get_file_info(root).type != files.FileType.Directory:
        return False
    system.delete_dir(root)
    return True
