"""Token ids as fixed-width bit-packed files, written in id order and read at random.

A file holds a header, blocks of ``BLOCK`` ids of the vocabulary's fewest bits, the
offset of every block, and the documents with their token counts.  Blocks unpack
with one numpy call each, so any span of ids costs the blocks that it touches.
"""

from __future__ import annotations

import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fastbpe import encoder, vocabulary_of
from .staging import fresh_path, open_folder, put_file, stage

END = 2
BLOCK = 8192
#: Roll to a new file after so many ids.
FILE_IDS = 16_000_000
#: magic, bits, ids in a block, ids, documents, blocks, place of the offsets
HEAD = struct.Struct("<8sIIQQQQ")
MAGIC = b"BITIDS01"


def width_of(vocabulary: int) -> int:
    """The fewest bits that hold ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids one after another, ``bits`` each, lowest bit first; an id that doesn't fit is an error."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError(f"id {ids.max()} doesn't fit into {bits} bits")
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, n: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", n).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little", count=n * bits)
    return flat.reshape(n, bits).astype(np.uint32) @ (np.uint32(1) << np.arange(bits, dtype=np.uint32))


class Writer:
    """Collects ids and writes whole blocks as they fill."""

    def __init__(self, bits: int):
        self.bits, self.blocks, self.n = bits, [], 0
        self.missing, self.docs, self.sizes = array("B"), array("q"), array("q")
        self.held: list[bytes] = []
        self.waiting = 0

    def add(self, doc: int | None, raw: bytes) -> None:
        self.missing.append(doc is None)
        self.docs.append(doc or 0)
        self.sizes.append(len(raw) // 4)
        self.held.append(raw)
        self.waiting += len(raw) // 4
        self.n += len(raw) // 4
        if self.waiting >= 16 * BLOCK:
            self.cut(self.waiting - self.waiting % BLOCK)

    def cut(self, n: int) -> None:
        ids = np.frombuffer(b"".join(self.held), "<u4")
        self.blocks += [pack_bits(ids[k : k + BLOCK], self.bits) for k in range(0, n, BLOCK)]
        self.held, self.waiting = [ids[n:].tobytes()], len(ids) - n

    def write(self, out) -> None:
        if self.waiting:
            self.cut(self.waiting)
        sizes = [len(b) for b in self.blocks]
        offsets = HEAD.size + np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)[: len(sizes)]
        out.write(HEAD.pack(MAGIC, self.bits, BLOCK, self.n, len(self.docs), len(sizes), HEAD.size + sum(sizes)))
        for b in self.blocks:
            out.write(b)
        out.write(offsets.astype("<i8").tobytes())
        out.write(np.array(self.missing, np.uint8).tobytes())
        out.write(np.array(self.docs, "<i8").tobytes())
        out.write(np.array(self.sizes, "<i8").tobytes())


class Reader:
    """Random access to one file; holds its index and one run of blocks at a time."""

    def __init__(self, folder: str, name: str):
        store, path = open_folder(folder)
        self.file = store.open_input_file(f"{path}/{name}")
        magic, self.bits, self.block, self.n, docs, blocks, at = HEAD.unpack(self.file.read(HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"{name} is no token file")
        self.file.seek(at)
        self.offsets = np.frombuffer(self.file.read(8 * blocks), "<i8")
        self.missing = np.frombuffer(self.file.read(docs), np.uint8).astype(bool)
        self.docs = np.frombuffer(self.file.read(8 * docs), "<i8")
        self.sizes = np.frombuffer(self.file.read(8 * docs), "<i8")
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.end = at
        self.held = (0, np.zeros(0, np.uint32))

    def ids(self, start: int, n: int) -> np.ndarray:
        """The ids from ``start``, from the blocks that hold them."""
        begin, held = self.held
        if not (begin <= start and start + n <= begin + len(held)):
            lo, hi = start // self.block, -(-(start + n) // self.block)
            hi = min(max(hi, lo + 16), len(self.offsets))
            last = self.offsets[hi] if hi < len(self.offsets) else self.end
            self.file.seek(int(self.offsets[lo]))
            data = self.file.read(int(last - self.offsets[lo]))
            count = min(hi * self.block, self.n) - lo * self.block
            # Whole blocks end on a byte, as BLOCK is a multiple of 8.
            self.held = begin, held = lo * self.block, unpack_bits(data, self.bits, count)
        return held[start - begin : start - begin + n]


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, vocabulary: int | None = None, lower: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text whole, end it with the end id, and write the files.

    Returns the manifest (part, number, file, n_docs, n_tokens): files in ascending
    id order.  Null ids come first; rows that repeat an id stand together, ordered
    by text.  A null or empty text is the end id alone.  Files are at most FILE_IDS
    ids and a document long, and appear only when whole.  Ids take the bits of
    ``vocabulary`` ids, by default of the tokenizer's.  Strings of special tokens in
    a text become those tokens, as the library has it.
    """
    bits = width_of(vocabulary or vocabulary_of(tokenizer))

    def run(batches):
        from pyspark import TaskContext

        part, number, writer, enc = TaskContext.get().partitionId(), 0, Writer(bits), encoder(tokenizer, lower)

        def close():
            name = f"ids-{part:06d}-{number:04d}.bin"
            put_file(folder, name, writer.write)
            return pa.record_batch([pa.array([x]) for x in (part, number, name, len(writer.docs), writer.n)], ["part", "number", "file", "n_docs", "n_tokens"])

        for b in batches:
            for doc, raw in zip(b.column(0).to_pylist(), enc.each(b.column(1).to_pylist())):
                writer.add(doc, raw + END.to_bytes(4, "little"))
                if writer.n >= FILE_IDS:
                    yield close()
                    number, writer = number + 1, Writer(bits)
        if writer.docs:
            yield close()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    laid = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return stage(laid.mapInArrow(run, "part long, number long, file string, n_docs long, n_tokens long"), "manifest")


def read_tokens(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document, read back from the files.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian
    unsigned 32-bit integers.  The manifest has a row per file (FILE_IDS ids), so its
    running sum is small."""
    files = manifest.orderBy("part", "number").collect()
    before, rows = 0, []
    for f in files:
        rows.append((f["file"], before))
        before += f["n_tokens"]
    spark = manifest.sparkSession
    listed = spark.createDataFrame(rows, "file string, before long")
    listed = listed.repartition(max(1, len(rows)), "file") if rows else listed

    def run(batches):
        for b in batches:
            for name, ahead in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                reader = Reader(folder, name)
                for k in range(0, len(reader.docs), 256):
                    starts, sizes = reader.starts[k : k + 256], reader.sizes[k : k + 256]
                    docs = pa.array(reader.docs[k : k + 256], mask=reader.missing[k : k + 256])
                    ids = [reader.ids(int(s), int(n)).astype("<u4").tobytes() for s, n in zip(starts, sizes)]
                    yield pa.record_batch([docs, pa.array(starts + ahead), pa.array(sizes), pa.array(ids, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def crc32_of(ids: bytes) -> int:
    return zlib.crc32(ids)


def round_trip(docs: DataFrame, tokenizer: str, vocabulary: int | None = None, **how) -> DataFrame:
    """Write the files into a fresh shared folder, then read them back."""
    folder = fresh_path(docs.sparkSession, "token-files")
    return read_tokens(write_tokens(docs, folder, tokenizer, vocabulary, **how), folder)
