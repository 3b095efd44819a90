"""Archives, token files and pieces against the libraries and against what was written."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from odd_rows import docs, empty, rows, small  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tillsight.llm import pieces, seekable, token_frames, warc

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_seekable_file_is_plain_zstd_and_finds_damage(tmp_path):
    path = str(tmp_path / "f.zst")
    writer = seekable.SeekableWriter(path)
    blocks = [b"a" * 1000, b"", b"xyz"]
    assert [writer.add(b) for b in blocks] == [0, 1, 2]
    writer.close()
    reader = seekable.SeekableReader(path)
    assert [reader.frame(i) for i in (2, 0, 1)] == [b"xyz", b"a" * 1000, b""]
    data = open(path, "rb").read()
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(blocks)
    at = reader.starts[2] + 9
    open(path, "wb").write(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])
    with pytest.raises((ValueError, zstandard.ZstdError)):
        seekable.SeekableReader(path).frame(2)


@pytest.fixture(scope="module")
def pages(spark):
    rows = [(1, "u1", "<p>a</p>"), (2, "u\r\nX: 2", "<p>a</p>"), (3, None, None), (4, "u", ""), (5, "u", "é" * 300_000), (6, "u", "<p>a</p>"),
            (6, "u", "<p>a</p>"), (None, "u", "<p>a</p>"), (None, "u", "only"), (7, "u", "\r\n\r\nWARC/1.1\r\n")]
    return spark.createDataFrame([(*r, "x", 9) for r in rows], "page_id long, url string, html string, file string, offset int")


def test_archive_round_trip(pages):
    index = warc.write_archive(pages)
    got = warc.read_archive(index).collect()
    rows = [(r.page_id, r.url, (r.html or "").encode()) for r in pages.collect()]
    largest = {}
    for page, _, payload in rows:
        if page is not None:
            largest[payload] = max(page, largest.get(payload, page))
    want = []
    for page, url, payload in rows:
        revisit = payload in largest and largest[payload] != page
        sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        url = url and url.replace("\r", "%0D").replace("\n", "%0A")
        want.append((str(page), url, len(payload), sha, "revisit" if revisit else "response", largest[payload] if revisit else None, None if revisit else payload))
    key = lambda r: tuple(map(str, r))
    assert sorted(((str(r[0]), *r[1:-1], r[-1] and bytes(r[-1]) if r[-1] else r[-1]) for r in got), key=key) == sorted(
        (w[:-1] + (w[-1] or w[-1],) for w in want), key=key
    )
    assert [bytes(r.payload) for r in warc.lookup(index, [5]).collect()] == [("é" * 300_000).encode()]


def test_archive_of_nothing(pages):
    assert warc.read_archive(warc.write_archive(pages.limit(0))).count() == 0


def test_one_payload_on_most_pages(spark):
    pages = spark.range(3000).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("html"))
    got = warc.read_archive(warc.write_archive(pages))
    assert got.count() == 3000 and got.filter("record_type = 'revisit' AND refers_to = 2997").count() == 999


def test_token_files_hold_the_library_ids(docs, rows, monkeypatch):
    monkeypatch.setattr(token_frames, "FRAME_IDS", 500)
    library = Tokenizer.from_file(WORD_BPE)
    at, want = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((doc, at, np.array(ids, "<u4").tobytes()))
        at += len(ids)
    manifest = token_frames.write_tokens(docs, WORD_BPE)
    got = [(r.doc_id, r.start, bytes(r.ids)) for r in token_frames.read_tokens(manifest).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    assert manifest.select("file", "frame").distinct().count() > 3
    some = {r.doc_id: bytes(r.ids) for r in token_frames.fetch(manifest, [11, 30]).collect()}
    assert some == {d: x for d, _, x in want if d in (11, 30)}


def test_token_query(spark, small):
    from tillsight.llm.queries import QUERIES

    library = Tokenizer.from_file(WORD_BPE)
    at, want = 0, []
    for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").collect():
        ids = library.encode(r.text, add_special_tokens=False).ids + [2]
        want.append((r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = QUERIES["op3_token_frames"](spark, small).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_token_files_of_nothing(empty):
    assert token_frames.read_tokens(token_frames.write_tokens(empty, WORD_BPE)).count() == 0


ODD = ["the", "don", "'", "'s", " ", "\n", "\t", "A", "é", "é", "̈", "ß", "0", ".", "!!", "<|", "日", "Σ", "²", "_", "-", "\x00", "\xa0", "🙂", "▁", "  ", "ing", "<s>", "."]


def odd_texts(n):
    rng = random.Random(3)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_word_encoder_on_odd_texts():
    library, encoder = Tokenizer.from_file(WORD_BPE), token_frames.WordEncoder(WORD_BPE, None)
    found = odd_texts(4000)
    for text, ids in zip(found, encoder.encode(found)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_piece_encoder_on_odd_texts():
    library, encoder = sentencepiece.SentencePieceProcessor(model_file=PIECES), pieces.PieceEncoder(PIECES)
    for text in [*odd_texts(4000), "a" * 5000, "ab" * 3000, "▁" * 100, "x1" * 2000]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text), repr(text)


def test_piece_encoder_goes_back():
    """Greedy longest pieces are not always right: some texts need failed positions."""
    encoder = pieces.PieceEncoder(PIECES)
    taken_back = []
    plain = encoder.shorter
    encoder.shorter = lambda p: taken_back.append(p) or plain(p)
    rng = random.Random(1)
    encoder.encode(" ".join("".join(rng.choice("aeinrst") for _ in range(12)) for _ in range(300)))
    assert taken_back


def test_pieces_as_the_library(docs, rows):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for doc, text in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        want.append((str(doc), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    got = pieces.digests(pieces.encode_decode(docs, PIECES)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_pieces_of_nothing(empty):
    assert pieces.encode_decode(empty, PIECES).count() == 0
