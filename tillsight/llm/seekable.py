"""Seekable Zstandard files: independent frames and a trailing seek table.

Layout of the public seekable format: data frames, then one skippable frame that
holds (compressed size, decompressed size, checksum) of each data frame and ends in
the number of frames, a descriptor byte and a magic number. Any zstd tool can still
decompress the file from start to end.
"""

from __future__ import annotations

import struct

import xxhash
import zstandard

from tillsight.llm.storage import locate

# Fixed values of the format.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

ENTRY = "<III"
FOOTER = "<IBI"
FOOTER_SIZE, ENTRY_SIZE = struct.calcsize(FOOTER), struct.calcsize(ENTRY)


def checksum(data: bytes) -> int:
    return xxhash.xxh64_intdigest(data) & 0xFFFFFFFF


class SeekableWriter:
    """Writes frames; ``size`` is the number of bytes so far."""

    def __init__(self, uri: str, level: int = 3):
        fs, path = locate(uri)
        self.uri, self.size, self.entries = uri, 0, []
        self.out = fs.open_output_stream(path, compression=None)
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)

    def add(self, data: bytes) -> int:
        """Appends one frame and returns its number."""
        packed = self.packer.compress(data)
        self.out.write(packed)
        self.size += len(packed)
        self.entries.append((len(packed), len(data), checksum(data)))
        return len(self.entries) - 1

    def close(self) -> None:
        table = b"".join(struct.pack(ENTRY, *e) for e in self.entries)
        table += struct.pack(FOOTER, len(self.entries), WITH_CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.out.close()


class SeekableReader:
    """Reads single frames of a file, each checked against its checksum."""

    def __init__(self, uri: str):
        fs, path = locate(uri)
        self.file, self.uri = fs.open_input_file(path), uri
        size = self.file.size()
        frames, _, magic = struct.unpack(FOOTER, self.file.read_at(FOOTER_SIZE, size - FOOTER_SIZE))
        if magic != SEEKABLE:
            raise ValueError(f"{uri} has no seek table")
        length = frames * ENTRY_SIZE
        table = self.file.read_at(length, size - FOOTER_SIZE - length)
        self.entries = list(struct.iter_unpack(ENTRY, table))
        self.starts = [0]
        for packed, _, _ in self.entries:
            self.starts.append(self.starts[-1] + packed)
        self.unpacker = zstandard.ZstdDecompressor()

    def frame(self, number: int) -> bytes:
        packed, length, want = self.entries[number]
        raw = self.file.read_at(packed, self.starts[number])
        data = self.unpacker.decompress(raw, max_output_size=length) if length else b""
        if len(data) != length or checksum(data) != want:
            raise ValueError(f"frame {number} of {self.uri} is damaged")
        return data

    def close(self) -> None:
        self.file.close()
