"""Exact SentencePiece encoding of merge-type models by backtracking, and decoding.

Method: an Aho-Corasick automaton of the vocabulary finds, for each position, the longest
piece that starts there. Pieces are taken greedily; a piece may follow another one only
if merging both texts again from single characters gives just these two (the pairs' verdicts
are kept). Where nothing fits, the position is marked in a bitfield, the last piece is
taken back and its next shorter prefix is tried. A text has one sequence of pairwise
compatible pieces, and that is what merging by score gives, so a position that failed
once fails for good and the search stays linear in practice.

No piece continues after a blank or crosses a character that occurs in no longer piece, so
texts are cut there and each distinct chunk that a worker remembers is encoded once. Characters without
a piece become byte pieces. Decoding is the library's own.

Null is the empty text, whose ids are the begin and end id alone. Repeated rows are
encoded as often as they occur; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tillsight.llm.arrowio import map_batches, remembered, texts

BLANK = "▁"  # stands for a blank inside pieces
NEVER = float("inf")  # rank of what is no piece
NONE = -1  # no piece
CACHE_CHUNKS = 300_000  # chunks whose ids a worker remembers
CACHE_PAIRS = 250_000  # and pairs of pieces


class PieceEncoder:
    """For models with a dummy blank in front, no other normalisation, and byte fallback."""

    def __init__(self, model: str):
        import ahocorasick
        import sentencepiece

        self.processor = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        kinds = (sp.is_control, sp.is_unknown, sp.is_byte, sp.is_unused)
        self.ids = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if not any(k(i) for k in kinds)}
        self.ranks = {p: -sp.get_score(i) for p, i in self.ids.items()}
        self.bytes = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.begin, self.end = sp.bos_id(), sp.eos_id()
        joined = {c for p in self.ids if len(p) > 1 for c in p}
        if missing := joined - self.ids.keys():
            raise ValueError(f"characters without a piece of their own: {sorted(missing)[:5]}")
        self.longest = ahocorasick.Automaton()
        for piece in self.ids:
            self.longest.add_word(piece, (len(piece) - 1, self.ids[piece]))
        self.longest.make_automaton()
        self.chunks = self.chunker(joined)
        self.known: dict[str, bytes] = {}
        self.names = {i: p for p, i in self.ids.items()}
        self.characters = frozenset(p for p in self.ids if len(p) == 1)
        self.pairs: dict[int, bool] = {}
        self.prefixes: dict[int, int] = {}

    def chunker(self, joined: set[str]) -> Callable[[str], list[str]]:
        if any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.ids):
            return lambda text: [text]
        if "\n" in joined:
            return re.compile(r" *[^ ]+| +").findall
        return re.compile(r"\n| *[^ \n]+| +").findall

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers, without begin and end."""
        if not text:
            return b""
        known, out = self.known, []
        for chunk in self.chunks(" " + text.replace(BLANK, " ")):
            ids = known.get(chunk)
            if ids is None:
                if len(known) >= CACHE_CHUNKS:
                    known.clear()
                ids = known[chunk] = self.encode_chunk(chunk.replace(" ", BLANK))
            out.append(ids)
        return b"".join(out)

    def encode_chunk(self, text: str) -> bytes:
        if self.characters.issuperset(text):
            return np.array(self.search(text), dtype="<u4").tobytes()
        ids, run = [], 0
        for at, char in enumerate(text):
            if char not in self.characters:
                ids += self.search(text[run:at])
                ids += [self.bytes[b] for b in char.encode()]
                run = at + 1
        return np.array(ids + self.search(text[run:]), dtype="<u4").tobytes()

    def search(self, text: str) -> list[int]:
        """The pieces of a text whose characters all have pieces, by backtracking."""
        size = len(text)
        longest, back = [NONE] * size, [0] * size
        for last, (less, piece) in self.longest.iter(text):  # ends ascend: a longer piece overwrites
            longest[last - less] = piece
        failed = bytearray(size // 8 + 1)
        taken: list[int] = []
        pairs, at, before = self.pairs, 0, NONE
        while at < size:
            piece = longest[at]
            while True:
                if piece == NONE:  # nothing fits here: go back by one piece
                    failed[at >> 3] |= 1 << (at & 7)
                    at = back[at]
                    piece = self.shorter(taken.pop())
                    before = taken[-1] if taken else NONE
                    continue
                end = at + len(self.names[piece])
                fits = pairs.get(before << 32 | piece)
                if fits is None:
                    fits = self.judge(before, piece)
                if fits and not failed[end >> 3] >> (end & 7) & 1:
                    break
                piece = self.shorter(piece)
            taken.append(piece)
            if end < size:
                back[end] = at
            at, before = end, piece
        return taken

    def judge(self, before: int, piece: int) -> bool:
        """Whether merging leaves the two pieces (or the first one alone) as they are."""
        if len(self.pairs) >= CACHE_PAIRS:
            self.pairs.clear()
        pair = [self.names[i] for i in (before, piece) if i != NONE]
        fits = self.pairs[before << 32 | piece] = self.merge("".join(pair)) == pair
        return fits

    def shorter(self, piece: int) -> int:
        """The longest piece that is a proper prefix."""
        if piece not in self.prefixes:
            name = self.names[piece]
            self.prefixes[piece] = next((self.ids[name[:n]] for n in range(len(name) - 1, 0, -1) if name[:n] in self.ids), NONE)
        return self.prefixes[piece]

    def merge(self, text: str) -> list[str]:
        """Plain merging of a short text: the best score first, the leftmost of equals."""
        parts = list(text)
        ranks = [self.ranks.get(x + y, NEVER) for x, y in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < NEVER:
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = self.ranks.get(parts[i - 1] + parts[i], NEVER)
            if i < len(ranks):
                ranks[i] = self.ranks.get(parts[i] + parts[i + 1], NEVER)
        return parts


def encode_decode(docs: DataFrame, model: str, text_column: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, ids with begin and end id as little-endian u32 bytes, the text that they decode to)."""

    def make() -> Callable[[pa.RecordBatch], pa.RecordBatch]:
        coder = remembered(("pieces", model), lambda: PieceEncoder(model))
        head, tail = (np.array([x], dtype="<u4").tobytes() for x in (coder.begin, coder.end))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [head + coder.encode(t) + tail for t in texts(batch.column(1))]
            decoded = [coder.processor.decode(np.frombuffer(x, "<u4").tolist()) for x in ids]
            return pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array(decoded, pa.string())], [id_column, "ids", "decoded"]
            )

        return run

    rows = docs.select(F.col(id_column), F.col(text_column).cast("string").alias("text"))
    kind = rows.schema[0].dataType.simpleString()
    return map_batches(rows, make, f"`{id_column}` {kind}, ids binary, decoded string")


def digests(encoded: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return encoded.select(
        id_column, (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op6_pieces(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    return digests(encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model")))
