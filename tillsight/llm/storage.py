"""Files in the shared folder, opened by URI from any executor."""

from __future__ import annotations

import uuid

import pyarrow.fs as pafs


def locate(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it; plain paths are local ones."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    return pafs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    fs, path = locate(uri)
    fs.create_dir(path, recursive=True)


def unique(folder: str, stem: str, suffix: str) -> str:
    """A name that no other attempt of the same task uses.

    Only names that a committed manifest lists are ever read, so what a lost or
    repeated attempt leaves behind is never seen.
    """
    return f"{folder}/{stem}-{uuid.uuid4().hex[:12]}{suffix}"
