"""Token ids in seekable binary files.

One file for each range of doc_ids: independent zstandard frames of about
``FRAME_BYTES`` of ids, then two skippable frames - the document index, and the
seek table of the public "Zstandard seekable format" (compressed size, size and
checksum of each frame).  A reader loads the tail, and then only the frames
that hold the documents it was asked for.

Document index, little-endian: count u32, then for each document its id i64,
known u8 (0: the id is null), frame u32, place in the frame u32, ids u32.

Files are written under a name of their own attempt and renamed, so a task that
runs again leaves one whole file.  ``pyarrow.fs`` opens the shared folder, so
any store it knows can hold the files.

Defined results: null text = empty text = the end id alone; a null doc_id sorts
first; repeated ids stay side by side, ordered by text; an empty table gives no
documents; a wrong checksum raises ``ValueError``.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LETTERS, NOT_PLAIN

FRAME_BYTES = 256 * 1024
#: Text of a file at most, on average, and what a document counts besides its text.
FILE_BYTES, ROW_BYTES = 256 << 20, 32
SEEK_MAGIC, INDEX_MAGIC, TAIL_MAGIC = 0x184D2A5E, 0x184D2A5D, 0x8F92EAB1
INDEX = np.dtype([("doc_id", "<i8"), ("known", "u1"), ("frame", "<u4"), ("at", "<u4"), ("n", "<u4")])
TABLE = np.dtype([("packed", "<u4"), ("size", "<u4"), ("check", "<u4")])
#: Matches remembered in each of two generations.
MEMO = 300_000
#: What the tokenizer's own pattern matches in lower-case texts without characters that ``NOT_PLAIN`` finds.
PIECES = re.compile(rf"[{LETTERS}]+|'(?:[stmd]|re|ve|ll)|[0-9]|[^\s0-9{LETTERS}]+")


def byte_alphabet() -> dict[int, str]:
    """The public byte-level alphabet: printable bytes as themselves, the others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


ALPHABET = byte_alphabet()


class WordEncoder:
    """Ids of a text by the tokenizers library.

    The tokenizer lowers case, drops white space and encodes each match of its
    pattern by itself, so a match has the same ids wherever it stands; a
    bounded table remembers them.  A text with characters for which Python's
    own classes might differ, or with the string of an added token, goes
    through the library as a whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = sorted({form for t in self.tokenizer.get_added_tokens_decoder().values() for form in (t.content, t.content.lower())})
        self.odd = re.compile("|".join([NOT_PLAIN.pattern, *map(re.escape, added)]))
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def piece(self, piece: str) -> bytes:
        """Ids of a match that the newer table doesn't have."""
        out = self.older.get(piece)
        if out is None:
            letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(ALPHABET)
            ids = [t.id for t in self.model.tokenize(letters)]
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self.memo) >= MEMO:
                self.memo, self.older = {}, self.memo
            self.memo[piece] = out
        return out

    def encode(self, text: str) -> bytes:
        if self.odd.search(text):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
            return np.array(ids, "<u4").tobytes()
        memo, make = self.memo, self.piece
        return b"".join([memo.get(p) or make(p) for p in PIECES.findall(text.lower())])


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    """One for each Python worker, so that later tasks find what earlier ones remember."""
    return WordEncoder(path)


class Writer:
    """Frames, document index and seek table, to an open binary file."""

    def __init__(self, out):
        self.out, self.index, self.table, self.held, self.size = out, [], [], [], 0
        self.pack = zstandard.ZstdCompressor(level=1, write_content_size=True).compress

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.index.append((doc_id or 0, doc_id is not None, len(self.table), self.size // 4, len(ids) // 4))
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= FRAME_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.held:
            data = b"".join(self.held)
            packed = self.pack(data)
            self.out.write(packed)
            self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self.held, self.size = [], 0

    def close(self) -> None:
        self.flush()
        index = struct.pack("<I", len(self.index)) + np.array(self.index, INDEX).tobytes()
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self.table, TABLE).tobytes() + struct.pack("<IBI", len(self.table), 0x80, TAIL_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(table)) + table)


class Reader:
    """Random access: reads the tail, then one frame at a time."""

    def __init__(self, file):
        self.file, end = file, file.size()
        n, _, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != TAIL_MAGIC:
            raise ValueError("not a token file: the seek table is missing")
        self.table = np.frombuffer(self._at(end - 9 - n * TABLE.itemsize, n * TABLE.itemsize), TABLE)
        self.starts = np.concatenate([[0], np.cumsum(self.table["packed"], dtype="i8")])
        index_at = int(self.starts[-1])  # the index follows the last frame
        _, size = struct.unpack("<II", self._at(index_at, 8))
        self.index = np.frombuffer(self._at(index_at + 8, size)[4:], INDEX)
        self.held = (-1, b"")

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def frame(self, k: int) -> bytes:
        if self.held[0] != k:
            data = zstandard.ZstdDecompressor().decompress(self._at(int(self.starts[k]), int(self.table["packed"][k])))
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.table["check"][k]:
                raise ValueError(f"frame {k} doesn't match its checksum")
            self.held = (k, data)
        return self.held[1]

    def __iter__(self) -> Iterator[tuple[int | None, bytes]]:
        for doc_id, known, frame, at, n in self.index.tolist():
            yield (doc_id if known else None), self.frame(frame)[4 * at : 4 * (at + n)]

    def get(self, doc_id: int | None) -> list[bytes]:
        """The ids of the documents of that id; only their frames are decompressed."""
        same = self.index["known"] == 0 if doc_id is None else (self.index["known"] == 1) & (self.index["doc_id"] == doc_id)
        return [self.frame(f)[4 * at : 4 * (at + n)] for _, _, f, at, n in self.index[same].tolist()]


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", make: Callable[[str], WordEncoder] = word_encoder, file_bytes: int = FILE_BYTES) -> list[tuple[int, str, int, int]]:
    """Write the files, in ascending doc_id order; returns (part, path, documents, ids) of each.

    There are as many files as shuffle partitions, and more where a file would hold more than ``file_bytes`` of text,
    so that a file and its index stay of one size as the corpus grows.  The list has one entry for each file.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(text_col).cast("long") + ROW_BYTES)).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // file_bytes))
    ordered = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end, writer = make(tokenizer_path), struct.pack("<I", end_id), None
        first, count, total = None, 0, 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                doc_id = None if doc_id is None or doc_id != doc_id else int(doc_id)
                if writer is None:
                    first = doc_id
                    store, root = pafs.FileSystem.from_uri(folder)
                    store.create_dir(root, recursive=True)
                    name = f"{root}/{uuid.uuid4().hex}"
                    out = store.open_output_stream(name + ".part", compression=None)
                    writer = Writer(out)
                ids = encoder.encode(text or "") + end
                writer.add(doc_id, ids)
                count, total = count + 1, total + len(ids) // 4
        if writer is not None:
            writer.close()
            out.close()
            store.move(name + ".part", name + ".zst")
            yield pd.DataFrame({"first": pd.array([first], "Int64"), "path": [f"{folder}/{name.rpartition('/')[2]}.zst"], "docs": [count], "ids": [total]})

    files = ordered.mapInPandas(write, "first long, path string, docs long, ids long").collect()
    files.sort(key=lambda f: (f["first"] is not None, f["first"] or 0))
    return [(k, f["path"], f["docs"], f["ids"]) for k, f in enumerate(files)]


def read_tokens(spark: SparkSession, files: list[tuple[int, str, int, int]]) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids (binary), ids_crc32."""
    rows, before = [], 0
    for _, path, _, n in files:
        rows.append((path, before))
        before += n
    listed = spark.createDataFrame(rows, "path string, before long").repartition(max(1, len(rows)), "path")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["before"].tolist()):
                store, name = pafs.FileSystem.from_uri(path)
                with store.open_input_file(name) as file:
                    held: list[tuple] = []
                    size = 0
                    for doc_id, ids in Reader(file):
                        held.append((doc_id, start, len(ids) // 4, ids, zlib.crc32(ids)))
                        start, size = start + len(ids) // 4, size + len(ids)
                        if size > 8 << 20:
                            yield _frame(held)
                            held, size = [], 0
                    if held:
                        yield _frame(held)

    return listed.mapInPandas(read, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["doc_id", "start", "n_tokens", "ids", "ids_crc32"])
    return out.assign(doc_id=pd.array([r[0] for r in rows], "Int64"))
