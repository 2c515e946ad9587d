"""Token-id corpora as length-delimited binary records with a separate offset index.

Record file, repeated per document (little-endian):

    uint64 length of the payload
    uint32 masked crc32 of those 8 bytes
    payload: uint8 bytes per id (2 or 4), uint8 1 if the id is null, int64 document id, token ids
    uint32 masked crc32 of the payload

Index file, one entry per record: uint64 offset of the record, uint64 token
count, so a reader can visit records in any order.  Ids take two bytes when
the vocabulary allows it.

Documents are range-partitioned and sorted by id, each task writes one file
pair under a name of its own and reports it; the reports of the tasks that
succeeded are the manifest, so files of lost or repeated attempts are never
read.
"""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barlake.llm.segments import SegmentCache, WordCache, encode_batch, encode_runs
from barlake.llm.shared import col, shared_path, stored, text_of

# Fixed value: what the record checksums are masked with.
MASK_DELTA = 0xA282EAD8
LENGTH, CHECKSUM, HEAD, ENTRY = struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<BBq"), struct.Struct("<QQ")
# The characters with the Unicode property White_Space.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
SPACES = frozenset(re.findall(f"[{WHITE_SPACE}]", "".join(map(chr, range(0x3001)))))
END_ID = 0
ROWS_AT_ONCE = 2000


def masked(data: bytes) -> bytes:
    crc = zlib.crc32(data)
    return CHECKSUM.pack((((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF)


class Encoder:
    """Batch encoder of one tokenizer in one Python worker.

    Byte-level pieces never reach over the start of a white-space run, so
    texts are encoded by segment; other tokenizers get whole texts.  Strings
    of added tokens in a text are cut out first and get the token's id, or,
    with ``special_as_text``, those of special tokens are ordinary text.
    ``encode`` takes a column of texts, of which those without such strings
    are cut and looked up as columns.
    """

    def __init__(self, spec: str, special_as_text: bool = True):
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = special_as_text
        top = json.loads(spec)
        added = [t for t in top.get("added_tokens") or [] if not (special_as_text and t["special"])]
        pre = top.get("pre_tokenizer") or {}
        by_segment = (top.get("normalizer") is None and pre.get("type") == "ByteLevel"
                      and pre.get("use_regex", True) and not pre.get("add_prefix_space", True)
                      and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added))
        pattern = f"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+" if by_segment else r"(?s).+"
        self.cache = SegmentCache(pattern, self._segments, added=[t["content"] for t in added] if by_segment else ())
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4

        self.ids = self.tokenizer.get_vocab_size()
        # byte-level pieces are spelled with one character per byte
        self.piece_bytes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(self.ids)])
        self.added = frozenset(t["content"] for t in added)
        self.by_segment = by_segment
        self.words = WordCache(self._segments)

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a column without nulls, in order."""
        apart = np.full(len(texts), not self.by_segment)
        if self.by_segment:
            for a in self.added:
                apart |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        if not apart.any():
            return self.words.encode(texts)
        ways = (self.words.encode(texts.filter(pa.array(~apart))),
                self.cache.encode(texts.filter(pa.array(apart)).to_pylist()))
        return (next(ways[a]) for a in apart.astype(int))

    def _segments(self, segments: list[str]) -> list[bytes]:
        """Words led by white space are encoded in runs; first words, trailing spaces and added tokens alone."""
        run = [s for s in segments if self.by_segment and s[0] in SPACES and s[-1] not in SPACES and s not in self.added]
        known = dict(zip(run, encode_runs(self.tokenizer, run, self.piece_bytes, threads=False)))
        alone = [s for s in segments if s not in known]
        known.update((s, x.tobytes()) for s, x in zip(alone, encode_batch(self.tokenizer, alone, threads=False)))
        return [known[s] for s in segments]


@lru_cache(maxsize=2)
def encoder(spec: str) -> Encoder:
    """The worker's encoder of a tokenizer as its file says; kept over batches and tasks."""
    return Encoder(spec, special_as_text=False)


class ShardWriter:
    """A record file and its index, opened with the first record."""

    def __init__(self, folder: str, name: str):
        self.system, base = fs.FileSystem.from_uri(folder)
        self.base, self.folder, self.name = f"{base}/{name}", base, name
        self.out = self.index = None
        self.bytes = self.docs = self.tokens = 0

    def add(self, doc: int | None, ids: np.ndarray, width: int) -> None:
        if self.out is None:
            self.system.create_dir(self.folder, recursive=True)
            self.out, self.index = (self.system.open_output_stream(self.base + x) for x in ("", ".idx"))
        payload = HEAD.pack(width, doc is None, doc or 0) + ids.astype(f"<u{width}").tobytes()
        size = LENGTH.pack(len(payload))
        self.out.write(size + masked(size) + payload + masked(payload))
        self.index.write(ENTRY.pack(self.bytes, len(ids)))
        self.bytes += record_size(payload)
        self.docs, self.tokens = self.docs + 1, self.tokens + len(ids)

    def close(self) -> bool:
        """True if there is a file."""
        if self.out is None:
            return False
        self.out.close()
        self.index.close()
        return True


def record_size(payload: bytes) -> int:
    return len(payload) + LENGTH.size + 2 * CHECKSUM.size


def write_records(docs: DataFrame, tokenizer_path: str, folder: str | None = None, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int = END_ID) -> DataFrame:
    """Encode every whole text and write record and index files; returns the manifest.

    Manifest: ``shard`` (files in ascending id order), ``path`` (record file;
    the index is ``path`` + ``.idx``), ``docs``, ``tokens``, ``bytes``.
    ``folder`` defaults to a new one in the shared folder and must be one
    that pyarrow's file systems open on every executor.

    The id must be an integer.  Null ids come first; null text counts as
    empty; every document gets ``end_id`` appended, so none has no ids.
    Repeated ids are all written, ordered by the text's hash.  The string of
    an added token in a text gets that token's id, as the tokenizer does by
    default.  Texts of any length are encoded whole.  Other columns are not
    written, whatever they are called.  An empty table writes no file and
    gives an empty manifest.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())  # one vocabulary, a few MB
    target = folder or shared_path(spark, "records")
    rows = docs.select(col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"),
                       F.xxhash64(text_of(text_col)).alias("tie"))
    order = [F.col("id").asc_nulls_first(), F.col("tie").asc()]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(spec.value)
        shard = TaskContext.get().partitionId()
        writer = ShardWriter(target, f"shard-{shard:06d}-{uuid.uuid4().hex[:12]}.rec")
        end = np.array([end_id], dtype="<u4")
        for b in batches:
            for doc, ids in zip(b.column("id").to_pylist(), own.encode(b.column("text"))):
                writer.add(doc, np.append(np.frombuffer(ids, dtype="<u4"), end), own.width)
        if writer.close():
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([shard], pa.int32()), "path": [f"{target.rstrip('/')}/{writer.name}"],
                "docs": [writer.docs], "tokens": [writer.tokens], "bytes": [writer.bytes]})

    return stored(ordered.mapInArrow(of, "shard int, path string, docs bigint, tokens bigint, bytes bigint"),
                  "manifest")


def frame(stream) -> bytes:
    """The payload of the next record; raises if a checksum differs."""
    size = stream.read(LENGTH.size)
    if masked(size) != stream.read(CHECKSUM.size):
        raise ValueError("record length is damaged")
    payload = stream.read(LENGTH.unpack(size)[0])
    if masked(payload) != stream.read(CHECKSUM.size):
        raise ValueError("record is damaged")
    return payload


def sequence(payload: bytes) -> tuple[int | None, np.ndarray]:
    """(document id, token ids as unsigned 32-bit) of a payload."""
    width, no_id, doc = HEAD.unpack_from(payload)
    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=HEAD.size)
    return None if no_id else doc, ids.astype("<u4")


def read_at(path: str, numbers: list[int]) -> Iterator[tuple[int | None, np.ndarray]]:
    """Records of one file by their number, in the order asked for, found through the index."""
    system, base = fs.FileSystem.from_uri(path)
    with system.open_input_file(f"{base}.idx") as index, system.open_input_file(base) as records:
        for n in numbers:
            index.seek(n * ENTRY.size)
            records.seek(ENTRY.unpack(index.read(ENTRY.size))[0])
            yield sequence(frame(records))


def read_shard(path: str, docs: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of one file in order; raises unless index, lengths and checksums agree."""
    system, base = fs.FileSystem.from_uri(path)
    with system.open_input_stream(base) as records, system.open_input_stream(f"{base}.idx") as index:
        at = 0
        for _ in range(docs):
            offset, n = ENTRY.unpack(index.read(ENTRY.size))
            payload = frame(records)
            doc, ids = sequence(payload)
            if offset != at or n != len(ids):
                raise ValueError("index and records differ")
            at += record_size(payload)
            yield doc, ids


def read_records(spark: SparkSession, manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """Read all record files back, one task per file, with every checksum verified.

    Columns: ``doc_id``, ``start`` (ids of all documents before it),
    ``n_tokens``, ``ids_crc32`` and, ``with_ids``, ``ids``.  The driver holds
    one row per file to add up where each file starts.
    """
    files, start = [], 0
    for r in sorted(manifest.collect(), key=lambda r: r["shard"]):
        files.append((r["path"], r["docs"], start))
        start += r["tokens"]
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + (", ids array<bigint>" if with_ids else "")
    if not files:
        return spark.createDataFrame([], schema)
    names = schema.replace(",", "").split()[::2]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, docs, begin in zip(*(b.column(i).to_pylist() for i in range(3))):
                rows, held = [], 0
                for doc, ids in read_shard(path, docs):
                    rows.append((doc, begin, len(ids), zlib.crc32(ids.tobytes()), *([ids.tolist()] if with_ids else [])))
                    begin += len(ids)
                    held += len(ids)
                    if len(rows) >= ROWS_AT_ONCE or held > 1 << 20:
                        yield pack(rows)
                        rows, held = [], 0
                if rows:
                    yield pack(rows)

    def pack(rows: list[tuple]) -> pa.RecordBatch:
        arrays = [pa.array(list(c), pa.list_(pa.int64()) if n == "ids" else pa.int64())
                  for n, c in zip(names, zip(*rows))]
        return pa.RecordBatch.from_arrays(arrays, names)

    asked = spark.createDataFrame(files, "path string, docs bigint, start bigint").repartition(len(files))
    return asked.mapInArrow(of, schema)
