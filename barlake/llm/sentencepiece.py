"""SentencePiece models on the tokenizers library: encode, decode and verify.

The model protobuf is read field by field and rebuilt as a tokenizers
pipeline: normaliser (its precompiled character map, space collapsing, dummy
prefix, space to the metaspace marker), a Unigram model with the pieces'
scores or a BPE model whose merges follow them, byte fallback, and a decoder.

Pieces hold the marker at their start only (verified when the model is
read), so ids of a text are the ids of its marker-led segments; distinct
segments are encoded once, in multithreaded batches, and compared with the
SentencePiece library's own ids.  A model that breaks this rule is encoded
in whole texts.
"""

from __future__ import annotations

import array
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, decoders, models, normalizers

from barlake.llm.segments import RUN, SegmentCache, encode_batch, encode_runs
from barlake.llm.shared import col, text_of

MARK = "▁"
# Cached segments per generation: less than usual, as two tokenizers and the library's model live there too.
CACHED = 150_000
# Fixed values of the SentencePiece protobuf: field numbers and enum values.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
PIECE, SCORE, KIND = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
MODEL_TYPE, UNIGRAM, BPE = 3, 1, 2
CHARSMAP, DUMMY_PREFIX, ONE_SPACE, ESCAPE = 2, 3, 4, 5


def _varint(b: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = b[at]
        at += 1
        value |= (byte & 127) << shift
        shift += 7
        if byte < 128:
            return value, at


def _fields(b: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protobuf message; nested messages stay bytes."""
    at = 0
    while at < len(b):
        key, at = _varint(b, at)
        wire = key & 7
        if wire == 0:
            value, at = _varint(b, at)
        else:
            size = {1: 8, 5: 4}.get(wire)
            if size is None:
                size, at = _varint(b, at)
            value, at = b[at:at + size], at + size
        yield key >> 3, value


class Model:
    """A SentencePiece model as parsed from its file."""

    def __init__(self, data: bytes):
        self.pieces: list[tuple[str, float, int]] = []
        trainer: dict = {}
        norm: dict = {}
        for field, value in _fields(data):
            if field == PIECES:
                p = dict(_fields(value))
                score = struct.unpack("<f", p[SCORE])[0] if SCORE in p else 0.0
                self.pieces.append((p[PIECE].decode("utf-8"), score, p.get(KIND, NORMAL)))
            elif field == TRAINER:
                trainer = dict(_fields(value))
            elif field == NORMALIZER:
                norm = dict(_fields(value))
        self.kind = trainer.get(MODEL_TYPE, UNIGRAM)
        self.charsmap = norm.get(CHARSMAP, b"")
        self.dummy_prefix = bool(norm.get(DUMMY_PREFIX, 1))
        self.one_space = bool(norm.get(ONE_SPACE, 1))
        self.escape = bool(norm.get(ESCAPE, 1))
        self.byte_fallback = any(k == BYTE for _, _, k in self.pieces)
        self.unk = next((i for i, (_, _, k) in enumerate(self.pieces) if k == UNKNOWN), None)
        if self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if not self.escape:
            raise ValueError("models that keep plain spaces are not supported")
        if any(k == USER for _, _, k in self.pieces):
            raise ValueError("models with user-defined pieces are not supported")
        # No piece has the marker after another character: texts may be cut before marker runs.
        self.by_segment = not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, k in self.pieces if k == NORMAL)

    def merges(self) -> list[tuple[str, str]]:
        """BPE merges: best score first; of equal scores the longer result, as the leftmost pair grows first."""
        rank = {p: (-s, -len(p)) for p, s, k in self.pieces if k == NORMAL}
        pairs = [(rank[p], p[:i], p[i:]) for p in rank for i in range(1, len(p))
                 if p[:i] in rank and p[i:] in rank]
        return [(a, b) for _, a, b in sorted(pairs)]

    def normalizer(self):
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.one_space:
            steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Replace(Regex("^ | $"), "")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK))
        return normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])

    def tokenizer(self) -> Tokenizer:
        """The whole pipeline: normaliser, model, decoder."""
        if self.kind == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            model = models.BPE(vocab=vocab, merges=self.merges(), fuse_unk=True, byte_fallback=self.byte_fallback,
                               unk_token=None if self.unk is None else self.pieces[self.unk][0])
        else:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], unk_id=self.unk,
                                   byte_fallback=self.byte_fallback)
        tok = Tokenizer(model)
        tok.normalizer = self.normalizer()
        strip = [decoders.Strip(" ", 1, 0)] if self.dummy_prefix else []
        tok.decoder = decoders.Sequence(
            [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *strip])
        return tok


class Codec:
    """Batch encoder and decoder of one model in one Python worker."""

    def __init__(self, data: bytes):
        self.model = Model(data)
        self.whole = self.model.tokenizer()
        self.bare = self.model.tokenizer()  # for segments that are normalised already
        self.bare.normalizer = normalizers.Sequence([])
        self.norm = self.whole.normalizer
        self.own = sentencepiece.SentencePieceProcessor(model_proto=data)
        pattern = f"{MARK}*[^{MARK}]+|{MARK}+" if self.model.by_segment else r"(?s).+"
        self.cache = SegmentCache(pattern, self._segments, limit=CACHED)
        self.compare_segments = not self.model.charsmap and not self.model.one_space and self.model.dummy_prefix
        self.odd: set[str] = set()  # segments whose ids differ from the library's
        parts = [bytes([int(p[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else p.replace(MARK, " ").encode()
                 for p, _, k in self.model.pieces]
        self.blob = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.size = np.array([len(p) for p in parts], dtype=np.int64)
        self.at = np.cumsum(self.size) - self.size

        # Merges of a BPE model never reach over a marker, so marker-led segments may be encoded as one
        # text; a unigram model's sums could round otherwise in a longer text.
        self.in_runs = (self.model.kind == BPE and self.model.by_segment and self.model.byte_fallback
                        and any(p == MARK for p, _, _ in self.model.pieces))
        self.piece_bytes = np.array([1 if k == BYTE else len(p.encode()) for p, _, k in self.model.pieces])

    def _segments(self, segments: list[str]) -> list[bytes]:
        led = [s for s in segments if len(s) > 1 and s[0] == MARK and s[-1] != MARK] if self.in_runs else []
        known = dict(zip(led, encode_runs(self.bare, led, self.piece_bytes, threads=True)))
        alone = [s for s in segments if s not in known]
        known.update((s, x.tobytes()) for s, x in zip(alone, encode_batch(self.bare, alone, threads=True)))
        ids = [known[s] for s in segments]
        self._compare(segments, ids)
        return ids

    def _compare(self, segments: list[str], ids: list[bytes]) -> None:
        """Parity of segments, by run where a run's ids are those of its segments, else and on a difference one by one.

        A segment is given to the library without its first marker, which is the library's dummy prefix.
        """
        if not self.compare_segments:
            return
        marker = array.array("I", [self.own.piece_to_id(MARK)]).tobytes()
        self.odd.update(s for s, x in zip(segments, ids) if s == MARK and x != marker)
        led = [k for k, s in enumerate(segments) if s != MARK]
        tight = [k for k in led if segments[k][-1] != MARK] if self.in_runs else []
        runs = [tight[k:k + RUN] for k in range(0, len(tight), RUN)]
        theirs = self.own.encode(["".join([segments[k] for k in r])[1:].replace(MARK, " ") for r in runs], num_threads=1)
        same = {k for r, x in zip(runs, theirs) if array.array("I", x).tobytes() == b"".join([ids[k] for k in r]) for k in r}
        rest = [k for k in led if k not in same]
        theirs = self.own.encode([segments[k][1:].replace(MARK, " ") for k in rest], num_threads=1)
        self.odd.update(segments[k] for k, x in zip(rest, theirs) if array.array("I", x).tobytes() != ids[k])

    def normalised(self, text: str) -> str:
        return self.norm.normalize_str(text)

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[bool], list[str]]:
        """Ids, parity and normalised text of each text."""
        if self.model.charsmap or self.model.one_space:
            clean = [self.normalised(t) for t in texts]
        else:
            lead = MARK if self.model.dummy_prefix else ""
            clean = [lead + t.replace(" ", MARK) if t else "" for t in texts]
        ids = [np.frombuffer(x, dtype="<u4") for x in self.cache.encode(clean)]
        if not self.compare_segments:  # the library normalises otherwise than by its prefix alone: whole texts
            return ids, [x == y.tolist() for x, y in zip(self.own.encode(texts, num_threads=1), ids)], clean
        if self.odd:
            same = [self.odd.isdisjoint(self.cache.split(t)) for t in clean]
        else:
            same = [True] * len(texts)
        if texts:  # whole texts, one of each batch
            same[0] = same[0] and self.own.encode(texts[0]) == ids[0].tolist()
        return ids, same, clean

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; the dummy prefix goes, bytes that are no UTF-8 become U+FFFD."""
        size = self.size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        raw = self.blob[np.repeat(self.at[ids] - (ends - size), size) + np.arange(total)].tobytes()
        text = raw.decode("utf-8", errors="replace")
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text


@lru_cache(maxsize=2)
def codec(data: bytes) -> Codec:
    """The worker's codec of a model; kept over batches and tasks."""
    return Codec(data)


ENCODED = "n_tokens bigint, ids_crc32 bigint, round_trip boolean, parity boolean"


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """Encode and decode every whole text.

    Columns: the id, ``n_tokens``, ``ids_crc32`` (unsigned crc32 of the ids as
    little-endian unsigned 32-bit integers), ``round_trip`` (the decoded text
    is the normalised text), ``parity`` (each segment's ids equal the
    SentencePiece library's, or the whole text's where the model's normaliser
    does not let segments be compared) and, ``with_ids``, ``ids``.

    Null text counts as empty and has no ids.  Repeated rows give repeated
    rows; null ids stay null; other columns are not used.  The model file is
    read on the driver and broadcast: its size is that of one vocabulary.
    """
    with open(model_path, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(data.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                ids, same, clean = own.encode(b.column("text").to_pylist())
                back = [own.decode(x) == (c[1:] if own.model.dummy_prefix else c).replace(MARK, " ")
                        for x, c in zip(ids, clean)]
                cols = {"id": b.column("id"), "n_tokens": pa.array([len(x) for x in ids], pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                        "round_trip": pa.array(back, pa.bool_()), "parity": pa.array(same, pa.bool_())}
                if with_ids:
                    ends = np.cumsum([0, *map(len, ids)])
                    flat = np.concatenate(ids).astype(np.int32) if ids else np.empty(0, np.int32)
                    cols["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_pydict(cols)

    rows = docs.select(col(id_col).alias("id"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(of, f"id {kind}, {ENCODED}" + (", ids array<int>" if with_ids else ""))
    return out.withColumnRenamed("id", id_col)
