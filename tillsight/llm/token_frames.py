"""Token ids in seekable binary files, in ascending order of documents.

Method: documents are range-partitioned by id and sorted; every task encodes its
documents and appends them to frames of its own files. A frame is one independent
zstd frame with its own checksum and holds whole documents:

    number of documents (u32), a flag and an id for each (u8, i64),
    number of ids of each (u32), all ids (u32), little endian

The file ends in a seek table, so a reader decompresses only the frames that it wants.
The manifest, a Parquet table with one row per frame, is what commits the files: frames
of lost or repeated attempts are not listed there. Positions in the whole sequence are
running sums over the manifest: inside a file, then over one row per file.

Null and empty texts have no ids but the end id. Documents with equal ids keep one place
each, ordered by their text; a null id comes first. An empty table gives no files.
"""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tillsight.llm.arrowio import partitions_for, remembered, split, texts
from tillsight.llm.seekable import SeekableReader, SeekableWriter
from tillsight.llm.storage import make_folder, unique
from tillsight.session import cut_lineage, shared_folder

FRAME_IDS = 1 << 16  # a frame is closed after this many ids
FILE_BYTES = 256 << 20  # a file is closed after this many bytes
FRAMES_PER_TASK = 256  # read back by one task
TEXTS = 1024  # texts that are encoded at once
CACHE_WORDS = 1_000_000  # words whose ids a worker remembers

# Characters whose lower case was not checked to be the tokenizer's.
UNUSUAL = re.compile(r"[^\x00-\x7FÀ-ÖØ-öø-ÿ]")

MARKS = ".,;:!?%*&$#"
PLAIN = re.compile(r"[a-zß-öø-ÿ]+").fullmatch

MANIFEST = (
    "part int, file string, file_no int, frame int, documents long, ids long, first_doc long, last_doc long"
)


class WordEncoder:
    """Encodes texts with the tokenizers library, each remembered word once.

    The pre-tokenizer drops white space and joins nothing across it, so the ids of a text
    are those of its words in a row. Plain texts are lower-cased before, as the tokenizer
    does anyway, which makes fewer words.
    """

    def __init__(self, vocabulary: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        self.symbols = byte_symbols()
        self.end = b"" if end_id is None else struct.pack("<I", end_id)
        self.known: dict[str, bytes] = {}

    def plain(self, text: str) -> str:
        if not UNUSUAL.search(text):
            low = text.lower()
            if not any(x in low for x in self.added):
                text = low
        return text.replace("\n", " ")

    def encode(self, batch: list[str]) -> list[bytes]:
        """Each text's ids as bytes. The batch's words are numbered first, so that each
        distinct one is looked up once."""
        if not batch:
            return []
        words = pc.split_pattern(pa.array([self.plain(t) for t in batch], pa.large_string()), " ")
        numbered = words.flatten().dictionary_encode()
        names, which = numbered.dictionary.to_numpy(zero_copy_only=False).tolist(), numbered.indices.to_numpy()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        ids = list(map(self.known.get, names))
        gaps = [i for i, x in enumerate(ids) if x is None]
        self.learn([names[i] for i in gaps])
        for i in gaps:
            ids[i] = self.known[names[i]]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        flat = np.frombuffer(b"".join(ids), "<u4")
        # The places of each word's ids, one word of the texts after the other.
        spans = sizes[which]
        ends = np.cumsum(spans)
        at = np.repeat(starts[which] - (ends - spans), spans) + np.arange(ends[-1] if len(ends) else 0)
        found = flat[at]
        cuts = np.concatenate([[0], ends])[words.offsets.to_numpy() - words.offsets[0].as_py()]
        return [found[x:y].tobytes() + self.end for x, y in zip(cuts, cuts[1:])]

    def learn(self, words: list[str]) -> None:
        """Remembers words. Letters and the marks after them are separate tokens before any
        merge, so such words are put together from both."""
        cut, rest = [], set()
        for word in words:
            letters = word.rstrip(MARKS)
            if PLAIN(letters):
                cut.append((word, letters, word[len(letters) :]))
                rest.add(word[len(letters) :])
            else:
                rest.add(word)
        rest = list(rest - self.known.keys())
        for start in range(0, len(rest), 1024):
            part = rest[start : start + 1024]
            for word, got in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False)):
                self.known[word] = struct.pack(f"<{len(got)}I", *got.ids)
        for word, letters, marks in cut:
            self.known[word] = (self.known.get(letters) or self.merge(letters)) + self.known[marks]

    def merge(self, letters: str) -> bytes:
        """The ids of one run of letters, which is a single token before any merge."""
        symbols = letters if letters.isascii() else "".join([self.symbols[b] for b in letters.encode()])
        ids = [t.id for t in self.tokenizer.model.tokenize(symbols)]
        self.known[letters] = packed = struct.pack(f"<{len(ids)}I", *ids)
        return packed


def byte_symbols() -> list[str]:
    """The character that byte-level vocabularies write for each byte: its own if it is a
    visible one of Latin 1, else the next one from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in visible else spare))
        spare += byte not in visible
    return out


def pack_frame(documents: list[tuple[int | None, bytes]]) -> bytes:
    n = len(documents)
    flags = np.array([d is not None for d, _ in documents], dtype="u1")
    ids = np.array([d or 0 for d, _ in documents], dtype="<i8")
    counts = np.array([len(x) // 4 for _, x in documents], dtype="<u4")
    return b"".join([struct.pack("<I", n), flags.tobytes(), ids.tobytes(), counts.tobytes(), *(x for _, x in documents)])


def unpack_frame(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    (n,) = struct.unpack_from("<I", data)
    flags = np.frombuffer(data, "u1", n, 4)
    ids = np.frombuffer(data, "<i8", n, 4 + n)
    counts = np.frombuffer(data, "<u4", n, 4 + 9 * n)
    at = 4 + 13 * n
    for flag, doc, count in zip(flags, ids, counts):
        yield (int(doc) if flag else None), np.frombuffer(data, "<u4", count, at)
        at += 4 * int(count)


class FileSet:
    """The rolling files of one task, and the manifest rows of their frames."""

    def __init__(self, folder: str, part: int):
        self.folder, self.part, self.number = folder, part, 0
        self.writer: SeekableWriter | None = None
        self.waiting: list[tuple[int | None, bytes]] = []
        self.ids = 0
        self.rows: list[tuple] = []

    def add(self, doc: int | None, ids: bytes) -> None:
        self.waiting.append((doc, ids))
        self.ids += len(ids) // 4
        if self.ids >= FRAME_IDS:
            self.flush()

    def flush(self) -> None:
        if not self.waiting:
            return
        if self.writer is None:
            self.writer = SeekableWriter(unique(self.folder, f"ids-{self.part:06d}-{self.number:04d}", ".zst"), level=1)
        frame = self.writer.add(pack_frame(self.waiting))
        docs = [d for d, _ in self.waiting if d is not None]
        self.rows.append(
            (self.part, self.writer.uri, self.number, frame, len(self.waiting), self.ids, min(docs, default=None), max(docs, default=None))
        )
        self.waiting, self.ids = [], 0
        if self.writer.size >= FILE_BYTES:
            self.close()

    def close(self) -> None:
        self.flush()
        if self.writer is not None:
            self.writer.close()
            self.writer, self.number = None, self.number + 1


def write_tokens(docs: DataFrame, vocabulary: str, end_id: int | None = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Writes the ids of all documents in ascending order; returns the manifest, with
    ``start``: the number of ids before each frame in the whole sequence."""
    spark = docs.sparkSession
    folder = shared_folder(spark, unique("", "tokens", "").lstrip("/"))
    make_folder(folder)
    names = [x.split()[0] for x in MANIFEST.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = remembered(("words", vocabulary, end_id), lambda: WordEncoder(vocabulary, end_id))
        files = FileSet(folder, TaskContext.get().partitionId())
        for batch in batches:
            for piece in split(batch, TEXTS):
                for doc, ids in zip(piece.column(0).to_pylist(), encoder.encode(texts(piece.column(1)))):
                    files.add(doc, ids)
        files.close()
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*files.rows) if files.rows else [[]] * 8, KINDS)], names
        )

    rows = docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).cast("string").alias("text"))
    rows = rows.repartitionByRange("doc").sortWithinPartitions("doc", "text")
    manifest = cut_lineage(rows.mapInArrow(run, MANIFEST))
    inside = Window.partitionBy("file").orderBy("frame").rowsBetween(Window.unboundedPreceding, -1)
    # One row per file: a few for each task, however large the corpus is.
    across = Window.orderBy("part", "file_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.groupBy("part", "file_no", "file").agg(F.sum("ids").alias("ids"))
    bases = bases.select("file", F.coalesce(F.sum("ids").over(across), F.lit(0)).alias("base"))
    before = F.coalesce(F.sum("ids").over(inside), F.lit(0))
    return cut_lineage(manifest.withColumn("before", before).join(bases, "file").select(
        *names, (F.col("base") + F.col("before")).alias("start")
    ))


KINDS = [pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, ids as little-endian u32 bytes) of every document in the listed frames."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        for batch in batches:
            for row in batch.to_pylist():
                if reader is None or reader.uri != row["file"]:
                    if reader:
                        reader.close()
                    reader = SeekableReader(row["file"])
                at, out = row["start"], ([], [], [])
                for doc, ids in unpack_frame(reader.frame(row["frame"])):
                    for column, value in zip(out, (doc, at, ids.tobytes())):
                        column.append(value)
                    at += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.binary())],
                    ["doc_id", "start", "ids"],
                )
        if reader:
            reader.close()

    frames = manifest.select("file", "frame", "start")
    frames = frames.repartition(partitions_for(frames, frames.count(), FRAMES_PER_TASK), "file", "frame")
    return frames.sortWithinPartitions("file", "frame").mapInArrow(run, "doc_id long, start long, ids binary")


def fetch(manifest: DataFrame, wanted: list[int]) -> DataFrame:
    """Only the wanted documents: frames whose id range holds none of them stay compressed."""
    hit = F.exists(F.array(*[F.lit(x).cast("long") for x in wanted]), lambda x: x.between(F.col("first_doc"), F.col("last_doc")))
    return read_tokens(manifest.filter(hit)).filter(F.col("doc_id").isin(wanted))


def op3_token_frames(spark: SparkSession, folder: str) -> DataFrame:
    """The digest of the contract, made from what the written files hold."""
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    manifest = write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return read_tokens(manifest).select(
        "doc_id", "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
