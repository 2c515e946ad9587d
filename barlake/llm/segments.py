"""Encode texts by their distinct segments: each segment goes through the tokenizer once per cache.

A tokenizer whose pieces never cross certain boundaries gives the same ids
for a text as for its segments one after another.  Words repeat, so a bounded
cache per Python worker answers most segments, and the misses of many texts
go to the tokenizer as one batch, which it encodes on all its threads.

Where white space bounds the segments, a column of texts is cut, looked up and
put together again by numpy and Arrow; Python sees unknown segments only.
"""

from __future__ import annotations

import array
import itertools
import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# Cached segments per generation (about 250 bytes each), longest cached segment,
# characters of text looked up at a time, and segments encoded as one run.
CACHE_SEGMENTS = 400_000
CACHE_CHARS = 64
TEXT_AT_ONCE = 1 << 20
RUN = 1024
# The same for columns: cached words (about 50 bytes each), bytes of text looked up at a
# time, and unknown words encoded at a time (the tokenizer holds over 100 bytes per piece).
CACHE_WORDS = 1_000_000
COLUMN_AT_ONCE = 1 << 23
WORDS_AT_ONCE = 1 << 14
# ASCII white space, and the last byte and the one before it of other
# white-space characters in UTF-8 (U+0085 to U+3000); a few other characters share both.
IS_SPACE = np.isin(np.arange(256), list(b"\t\n\v\f\r "))
LAST = np.isin(np.arange(256), [*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF])
BEFORE_LAST = np.isin(np.arange(256), [0xC2, 0x9A, 0x80, 0x81])


def encode_batch(tokenizer: Tokenizer, segments: list[str], threads: bool) -> list[array.array]:
    """Ids of many segments as arrays of unsigned 32-bit numbers.

    ``threads`` encodes the batch on all the tokenizer's threads; where the
    tasks already fill the cores, one thread each costs less CPU time.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads else "false"
    return [array.array("I", e.ids) for e in tokenizer.encode_batch_fast(segments, add_special_tokens=False)]


def encode_runs(tokenizer: Tokenizer, segments: list[str], piece_bytes: np.ndarray, threads: bool) -> list[bytes]:
    """Ids of segments that may follow one another: encoded in runs and cut again where a segment's bytes end.

    One encoding of a run costs about half of one per segment.  No piece may
    reach over a segment's start; ``piece_bytes`` has the bytes of text that
    each id stands for.  A run whose pieces do not end where its segments do
    is encoded segment by segment.
    """
    runs = [segments[k:k + RUN] for k in range(0, len(segments), RUN)]
    out: list[bytes] = []
    for run, ids in zip(runs, encode_batch(tokenizer, ["".join(r) for r in runs], threads)):
        ends = np.cumsum([len(s.encode("utf-8")) for s in run])
        reached = np.cumsum(piece_bytes[np.frombuffer(ids, dtype="<u4")])
        last = np.searchsorted(reached, ends)
        if len(reached) == 0 or last[-1] != len(reached) - 1 or (reached[last] != ends).any():
            out += [x.tobytes() for x in encode_batch(tokenizer, run, threads)]
            continue
        raw, cuts = ids.tobytes(), [0, *(4 * (last + 1)).tolist()]
        out += [raw[a:z] for a, z in zip(cuts, cuts[1:])]
    return out


def splitter(pattern: str, added: Sequence[str] = ()) -> Callable[[str], list[str]]:
    """Split a text at the strings of ``added``, the longest first, and what is between them by ``pattern``."""
    find = re.compile(pattern).findall
    if not added:
        return find
    cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")").split

    def split(text: str) -> list[str]:
        if not any(a in text for a in added):
            return find(text)
        return [s for i, part in enumerate(cut(text)) for s in ([part] if i % 2 else find(part))]

    return split


class SegmentCache:
    """``encode_many(segments) -> list of id bytes`` behind a cache of two generations.

    Segments that are asked for again move to the young generation; when that
    holds ``limit`` segments it becomes the old one and the old one goes.
    """

    def __init__(self, pattern: str, encode_many: Callable[[list[str]], list[bytes]], limit: int = CACHE_SEGMENTS,
                 added: Sequence[str] = ()):
        self.split = splitter(pattern, added)
        self.encode_many = encode_many
        self.limit = limit
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        parts = [self.split(t) for t in texts]
        missing = set(itertools.chain.from_iterable(parts)).difference(self.young)
        fresh = {s: self.old[s] for s in missing if s in self.old}
        unknown = list(missing.difference(fresh))
        if unknown:
            fresh.update(zip(unknown, self.encode_many(unknown)))
        self.young.update(fresh)
        out = [b"".join(map(self.young.__getitem__, p)) for p in parts]
        for s in fresh:
            if len(s) > CACHE_CHARS:
                del self.young[s]
        if len(self.young) > self.limit:
            self.old, self.young = (self.young if len(self.young) <= 2 * self.limit else {}), {}
        yield from out  # last, as a caller may stop at the last text

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text, in order."""
        held, size = [], 0
        for t in texts:
            held.append(t)
            size += len(t)
            if size >= TEXT_AT_ONCE:
                yield from self._group(held)
                held, size = [], 0
        yield from self._group(held)


def offsets_of(column: pa.Array) -> np.ndarray:
    """Where the values of a column of large strings or bytes start, and where the last one ends."""
    held = column.buffers()[1]
    return np.frombuffer(held, np.int64)[column.offset:column.offset + len(column) + 1] if held else np.zeros(1, np.int64)


def run_starts(data: np.ndarray) -> np.ndarray:
    """Which UTF-8 bytes start a run of ASCII white space, as booleans.

    One whose character before may be white space outside ASCII, by its last
    two bytes, is left out: it may be inside a run.
    """
    starts = IS_SPACE[data]
    starts[1:] &= ~starts[:-1]
    at = np.flatnonzero(starts)
    at = at[at > 1]
    starts[at[LAST[data[at - 1]] & BEFORE_LAST[data[at - 2]]]] = False
    return starts


class WordCache:
    """Ids of texts by words, for tokenizers whose pieces never reach over the start of a white-space run.

    Known words and their ids are two Arrow columns; long words are not kept.
    When they hold more than ``limit`` words, the half of that used most stays,
    with half its uses, so what is no longer used goes in time.
    """

    def __init__(self, encode_many: Callable[[list[str]], list[bytes]], limit: int = CACHE_WORDS):
        self.encode_many = encode_many
        self.limit = limit
        self.words, self.ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        self.uses = np.zeros(0, np.float32)

    def _ids(self, words: pa.LargeStringArray, uses: np.ndarray) -> pa.LargeBinaryArray:
        """The ids of distinct words that are used so many times."""
        at = pc.index_in(words, value_set=self.words)
        unknown = words.filter(at.is_null())
        at = at.to_numpy(zero_copy_only=False)
        new = np.isnan(at) if len(unknown) else np.zeros(len(at), bool)
        at = np.where(new, len(self.words) + np.cumsum(new) - 1, at).astype(np.int64)
        if len(unknown):
            self.words = pa.concat_arrays([self.words, unknown])
            self.ids = pa.concat_arrays([self.ids, *(
                pa.array(self.encode_many(unknown.slice(k, WORDS_AT_ONCE).to_pylist()), pa.large_binary())
                for k in range(0, len(unknown), WORDS_AT_ONCE))])
            self.uses = np.append(self.uses, np.zeros(len(unknown), np.float32))
        self.uses[at] += uses
        found = self.ids.take(pa.array(at))
        self._trim()
        return found

    def _trim(self) -> None:
        kept = np.flatnonzero(pc.utf8_length(self.words).to_numpy() <= CACHE_CHARS)
        if len(kept) > self.limit:
            kept = kept[np.sort(np.argsort(self.uses[kept], kind="stable")[len(kept) - self.limit // 2:])]
            self.uses /= 2
        if len(kept) < len(self.words):
            self.words, self.ids = (x.take(pa.array(kept)) for x in (self.words, self.ids))
            self.uses = self.uses[kept]

    def _texts(self, texts: pa.LargeStringArray) -> Iterator[bytes]:
        offsets = offsets_of(texts)
        first, last = offsets[0], offsets[-1]
        if first == last:
            yield from [b""] * len(texts)
            return
        starts = run_starts(np.frombuffer(texts.buffers()[2], np.uint8)[first:last])
        starts[offsets[offsets < last] - first] = True
        cuts = np.append(np.flatnonzero(starts) + first, last)
        words = pa.LargeStringArray.from_buffers(len(cuts) - 1, pa.py_buffer(cuts), texts.buffers()[2]).dictionary_encode()
        ids = self._ids(words.dictionary, np.bincount(words.indices.to_numpy())).take(words.indices)
        ends = offsets_of(ids)[np.searchsorted(cuts, offsets)].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        yield from (raw[a:z].tobytes() for a, z in itertools.pairwise(ends))

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of a column without nulls, in order."""
        texts = texts.cast(pa.large_string())
        at, offsets = 0, offsets_of(texts)
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + COLUMN_AT_ONCE, "right")) - 1)
            yield from self._texts(texts.slice(at, stop - at))
            at = stop
