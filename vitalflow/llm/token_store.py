"""A store of token ids: one zstandard frame per document over a shared dictionary.

A file holds, in this order: a magic number, a JSON header with the SHA-256 of the dictionary,
the width of an id and the length of the dictionary, the dictionary, one frame per document in
ascending doc_id order, and an index (doc_id, known, place, length, tokens of each document)
whose own place stands at the end. One document is read by one seek and one frame.

The dictionary is trained on the serialized ids of at most SAMPLE_DOCS documents, those with
the smallest hashes of doc_id, of each at most SAMPLE_BYTES; it only affects size. Files hold
ranges of doc_id cut at quantiles of all ids, so the files in order of number hold all
documents in order. A task streams its documents and keeps only the index in memory. Each
attempt writes a file with a name of its own, and only files of finished tasks are listed.

Nulls: a null text is empty (only the end id); a null doc_id sorts first. Rows with one doc_id
are all kept, in the order of their bytes. An empty table gives no file. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import RowWriter, bounded_sample
from .tokens import encoder

MAGIC = b"VFTOKEN1"
SAMPLE_DOCS, SAMPLE_BYTES, DICTIONARY_BYTES = 2000, 8192, 65536
ROWS_A_FILE = 1_000_000
LEVEL = 3
FRAMES = "file long, doc_id long, frame binary, n_tokens long"
FILES = "file long, url string, n_docs long, n_tokens long"
DOCS = "doc_id long, start long, n_tokens long, ids_crc32 long"
_INDEX = np.dtype(
    [("doc_id", "<i8"), ("known", "u1"), ("place", "<u8"), ("length", "<u8"), ("tokens", "<u8")]
)


def _fields(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([pa.field(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def serialize(ids: bytes, width: int) -> bytes:
    """Little-endian unsigned 32-bit ids in `width` bytes each."""
    return ids if width == 4 else np.frombuffer(ids, "<u4").astype(f"<u{width}").tobytes()


def deserialize(data: bytes, width: int) -> bytes:
    return data if width == 4 else np.frombuffer(data, f"<u{width}").astype("<u4").tobytes()


def train_dictionary(docs: DataFrame, tokenizer: str, width: int) -> bytes:
    """Trained on the driver on a bounded sample; empty if there is too little to train on."""
    import zstandard

    sample = bounded_sample(docs.select("doc_id", "text"), docs["doc_id"], SAMPLE_DOCS)

    def ids(batches):
        encode = encoder(tokenizer).encode
        for batch in batches:
            out = [serialize(encode(t.as_py()), width)[:SAMPLE_BYTES] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["ids"])

    samples = sorted(bytes(r[0]) for r in sample.mapInArrow(ids, "ids binary").collect())
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, [s for s in samples if s]).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b""


def _write_files(place: str, dictionary: bytes, width: int, end_id: int):
    schema = _fields(FILES)

    def run(batches):
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(place)
        system.create_dir(root, recursive=True)
        current = stream = None
        header = json.dumps(
            {
                "dictionary_sha256": hashlib.sha256(dictionary).hexdigest(),
                "dictionary_bytes": len(dictionary),
                "width": width,
                "end_id": end_id,
            }
        ).encode()

        def close():
            at = stream.tell()
            table = np.array(index, _INDEX)
            stream.write(table.tobytes())
            stream.write(struct.pack("<QQ", at, len(table)) + MAGIC)
            stream.close()
            row = [[current], [name], [len(table)], [int(table["tokens"].sum())]]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema
            )

        for batch in batches:
            numbers, ids, frames, tokens = (batch.column(i).to_pylist() for i in range(4))
            for number, doc, frame, n in zip(numbers, ids, frames, tokens):
                if number != current:
                    if stream:
                        yield close()
                    current, index = number, []
                    name = f"{place}/{number:06d}-{uuid.uuid4().hex}.tokens"
                    stream = system.open_output_stream(f"{root}/{name.rpartition('/')[2]}")
                    stream.write(MAGIC + struct.pack("<Q", len(header)) + header + dictionary)
                index.append((doc or 0, doc is not None, stream.tell(), len(frame), n))
                stream.write(frame)
        if stream:
            yield close()

    return run


def write(
    docs: DataFrame, tokenizer: str, place: str, end_id: int = 1, files: int | None = None
) -> list[tuple[int, str, int, int]]:
    """Writes all documents; (number, url, documents, ids) of each file in order."""
    spark = docs.sparkSession
    docs = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    width = 2 if max(encoder(tokenizer).size, end_id + 1) <= 65536 else 4
    dictionary = train_dictionary(docs, tokenizer, width)
    rows = docs.count()
    parallel = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = files or max(parallel, -(-rows // ROWS_A_FILE))
    steps = [i / files for i in range(1, files)]
    cuts = (
        docs.agg(F.percentile_approx("doc_id", steps, 100 * files)).first()[0] if steps else None
    ) or []
    bounds = np.array(cuts, np.int64)
    end = int(end_id).to_bytes(4, "little")
    schema = _fields(FRAMES)

    def encode_all(batches):
        import zstandard

        encode = encoder(tokenizer).encode
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        for batch in batches:
            out = RowWriter(schema)
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py()) + end
                number = 0 if doc is None else int(np.searchsorted(bounds, doc, "left"))
                out.add(number, doc, pack(serialize(ids, width)), len(ids) // 4)
            yield out.take()

    frames = docs.mapInArrow(encode_all, FRAMES).repartition(files, "file")
    ordered = frames.sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), "frame")
    listed = ordered.mapInArrow(_write_files(place, dictionary, width, end_id), FILES).collect()
    return sorted(tuple(r) for r in listed)


class TokenFile:
    """Random access to one file."""

    def __init__(self, url: str):
        import zstandard
        from pyarrow import fs

        system, path = fs.FileSystem.from_uri(url)
        self.file = system.open_input_file(path)
        tail = len(MAGIC) + 16
        end = self.file.size()
        at, n = struct.unpack("<QQ", self._read(end - tail, 16))
        if self._read(end - len(MAGIC), len(MAGIC)) != MAGIC or self._read(0, len(MAGIC)) != MAGIC:
            raise ValueError(f"{url} is not a token file")
        (length,) = struct.unpack("<Q", self._read(len(MAGIC), 8))
        self.header = json.loads(self._read(len(MAGIC) + 8, length))
        dictionary = self._read(len(MAGIC) + 8 + length, self.header["dictionary_bytes"])
        if hashlib.sha256(dictionary).hexdigest() != self.header["dictionary_sha256"]:
            raise ValueError(f"{url}: the dictionary does not have its hash")
        self.index = np.frombuffer(self._read(at, n * _INDEX.itemsize), _INDEX)
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self._unpack = zstandard.ZstdDecompressor(dict_data=shared).decompress

    def _read(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def __len__(self) -> int:
        return len(self.index)

    def doc_id(self, i: int) -> int | None:
        return int(self.index["doc_id"][i]) if self.index["known"][i] else None

    def ids(self, i: int) -> bytes:
        """Ids of the i-th document as little-endian unsigned 32-bit integers."""
        row = self.index[i]
        data = self._unpack(self._read(int(row["place"]), int(row["length"])))
        return deserialize(data, self.header["width"])


def read(spark: SparkSession, files: list[tuple[int, str, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens and checksum of every document, from the files themselves.

    The starts of files are sums over the list of files, which the driver holds.
    """
    starts, total = [], 0
    for _, url, _, tokens in files:
        starts.append((url, total))
        total += tokens
    schema = _fields(DOCS)

    def run(batches):
        out = RowWriter(schema)
        for batch in batches:
            for url, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = TokenFile(url)
                for i in range(len(file)):
                    ids = file.ids(i)
                    out.add(file.doc_id(i), start, len(ids) // 4, zlib.crc32(ids))
                    start += len(ids) // 4
                    if out.full():
                        yield out.take()
        yield out.take()

    listed = spark.createDataFrame(starts, "url string, start long").repartition(max(1, len(files)))
    return listed.mapInArrow(run, DOCS)
