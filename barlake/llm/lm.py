"""Bigram language model with deleted interpolation, counted and scored over the whole corpus.

``P(w|u) = a_b c(u,w)/c(u) + b_b c(w)/N + c_b /(V+1)``, where the weights of
bucket ``b`` (the power of two of the context's count) are learned by
expectation-maximisation on held-out counts: every training token is scored
by the counts of all the *other* training tokens (its own one is deleted).

The model has a row for every word pair of the corpus, so it is never in one
place.  Documents are cut into chunks; each chunk asks for the counts of its
own distinct words and pairs:

1. A chunk's texts become token numbers of a chunk-local vocabulary.
2. The chunk sends its distinct 64-bit keys with its own training counts,
   packed per key range.  Counts are added up level by level: a node adds one
   key range over a group of senders, then sends its sums on in as many finer
   ranges to a node of a wider group, until the group is the whole corpus.
   Every sender has at most ``FAN`` receivers and a node about as many keys
   as one range holds, so messages grow with the corpus and keep their
   size; a frequent word costs one entry per sender.  Totals return by the same way.
3. The answers are joined to their chunk.  One pass gathers the held-out
   statistics in a fixed grid of cells (all the driver ever sees), another
   one scores the documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from barlake.llm.shared import col, stored, text_of

# Characters per chunk (one longer text is a chunk of its own), keys per node and receivers per sender.
CHUNK_CHARS = 1 << 22
KEYS_PER_RANGE = 1_000_000
FAN = 1024
SEED = 7
END, START = b"\n", b"\n\n"  # no word contains white space
ONE = np.uint64(1)
# Grid of the held-out statistics: context buckets, and quarter octaves of a probability.
BUCKETS, LEVELS, PER_OCTAVE = 40, 160, 4
ROUNDS = 200
ADD = 0.1


def packed(values: np.ndarray) -> bytes:
    """Unsigned integers as compressed byte planes, the least significant first."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize).T.tobytes()
    return values.dtype.str.encode() + len(values).to_bytes(8, "little") + pa.compress(
        planes, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    kind, n = np.dtype(data[:3].decode()), int.from_bytes(data[3:11], "little")
    planes = pa.decompress(data[11:], n * kind.itemsize, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).reshape(-1).view(kind)


def pair_keys(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """64-bit keys of pairs of word hashes."""
    x = before * np.uint64(0x9E3779B97F4A7C15) + np.bitwise_xor(word, word >> np.uint64(31)) * np.uint64(0xC2B2AE3D27D4EB4F)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(token numbers, tokens per text with its end, vocabulary); the end is the number after the last word."""
    lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.ascii_lower(pa.array(texts, pa.large_string()))))
    words, ends = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    full = np.concatenate([[0], np.cumsum(pc.binary_length(words).to_numpy() > 0)])
    sizes = np.diff(full[ends])
    coded = words.filter(pc.greater(pc.binary_length(words), 0)).dictionary_encode()
    vocab = coded.dictionary.to_pylist()
    out = np.full(int(sizes.sum()) + len(texts), len(vocab), dtype=np.int64)
    last = np.cumsum(sizes + 1) - 1
    place = np.ones(len(out), dtype=bool)
    place[last] = False
    out[place] = coded.indices.to_numpy(zero_copy_only=False)
    return out, sizes + 1, vocab


def chunks(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    """Token chunks: ``chunk``, ``ids``, ``held``, ``sizes``, ``numbers``, ``hashes`` and its training totals."""
    rows = docs.select(col(id_col).alias("id"), held_out.alias("held"), text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, texts, size, number = [], [], [], 0, 0

        def chunk() -> pa.RecordBatch:
            nums, sizes, vocab = tokens(texts)
            hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=SEED), itertools.chain(
                map(str.encode, vocab), [END])), dtype=np.uint64, count=len(vocab) + 1)
            train = ~np.array(held)
            state = Chunk(nums, sizes, hashes, train)
            one = {"chunk": pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
                   "ids": pa.array([ids], pa.list_(id_type)), "held": pa.array([held], pa.list_(pa.bool_())),
                   "sizes": [packed(sizes.astype(np.uint32))], "numbers": [packed(nums.astype(np.uint32))],
                   "hashes": [hashes.tobytes()],
                   "train_docs": [int(train.sum())], "train_tokens": [int(sizes[train].sum())],
                   "n_words": [len(hashes)], "n_pairs": [len(state.pairs)]}
            return pa.RecordBatch.from_pydict(one)

        for b in batches:
            id_type = b.schema.field("id").type
            for i, h, t in zip(*(b.column(c).to_pylist() for c in ("id", "held", "text"))):
                ids.append(i)
                held.append(h)
                texts.append(t)
                size += len(t)
                if size >= CHUNK_CHARS:
                    yield chunk()
                    ids, held, texts, size, number = [], [], [], 0, number + 1
        if ids:
            yield chunk()

    return stored(rows.mapInArrow(of, (
        f"chunk bigint, ids array<{kind}>, held array<boolean>, sizes binary, numbers binary, hashes binary, "
        "train_docs bigint, train_tokens bigint, n_words bigint, n_pairs bigint")), "lm-chunks")


class Chunk:
    """A chunk's tokens with its distinct words and pairs in key order."""

    def __init__(self, numbers: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, train: np.ndarray):
        self.sizes, self.hashes, self.train = sizes, hashes, train
        self.word = numbers.astype(np.int64)
        self.first = np.cumsum(sizes) - sizes
        self.before = np.roll(self.word, 1)
        self.start = len(hashes)  # context number of a text's start
        self.before[self.first] = self.start
        self.token_train = np.repeat(train, sizes)
        width = self.start + 1
        self.pairs, self.pair_of = np.unique(self.before * width + self.word, return_inverse=True)
        self.left, self.right = self.pairs // width, self.pairs % width
        contexts = np.append(hashes, np.uint64(xxhash.xxh64_intdigest(START, seed=SEED)))
        # The last bit tells the keys of pairs from those of words.
        self.keys = np.concatenate([hashes >> ONE << ONE, pair_keys(contexts[self.left], hashes[self.right]) | ONE])

    def asked(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys of words and pairs, own training counts."""
        own = np.concatenate([np.bincount(of[self.token_train], minlength=n)
                              for of, n in ((self.word, len(self.hashes)), (self.pair_of, len(self.pairs)))])
        order = np.argsort(self.keys, kind="stable")
        return self.keys[order], own[order].astype(np.uint32)

    def answered(self, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Totals in key order back into the order of the words, and of the pairs."""
        back = np.empty(len(totals), dtype=np.int64)
        back[np.argsort(self.keys, kind="stable")] = totals
        return back[:len(self.hashes)], back[len(self.hashes):]


def row_chunk(row: dict) -> Chunk:
    return Chunk(unpacked(row["numbers"]), unpacked(row["sizes"]).astype(np.int64),
                 np.frombuffer(row["hashes"], dtype=np.uint64), ~np.array(row["held"], dtype=bool))


MESSAGE = pa.schema([("grp", pa.int64()), ("part", pa.int64()), ("src", pa.int64()),
                     ("keys", pa.binary()), ("own", pa.binary())])
NODE = pa.schema([("grp", pa.int64()), ("part", pa.int64()), ("srcs", pa.list_(pa.int64())),
                  ("places", pa.list_(pa.binary())), ("keys", pa.binary()), ("own", pa.binary())])
ANSWER = pa.schema([("src", pa.int64()), ("part", pa.int64()), ("totals", pa.binary()), ("types", pa.int64())])


def ddl(schema: pa.Schema) -> str:
    names = {"int64": "bigint", "binary": "binary", "list<item: int64>": "array<bigint>",
             "list<item: binary>": "array<binary>"}
    return ", ".join(f"{f.name} {names[str(f.type)]}" for f in schema)


def levels(units: int, fan: int) -> tuple[int, int]:
    """(levels, receivers per sender) that reach ``units`` key ranges with at most ``fan`` receivers each."""
    n = 1
    while fan ** n < units:
        n += 1
    width = 1
    while width ** n < units:
        width += 1
    return n, width


def messages(group: int, part: int, src: int, keys: np.ndarray, own: np.ndarray, width: int, ranges: int) -> pa.RecordBatch:
    """A sender's sorted keys, cut into the ``width`` finer ranges of its range ``part``; ``ranges`` in all."""
    limits = np.array([(k << 64) // ranges for k in range(part * width + 1, (part + 1) * width)], dtype=np.uint64)
    cut = [0, *np.searchsorted(keys, limits).tolist(), len(keys)]
    out = [(group, part * width + k, src, packed(np.diff(keys[a:z], prepend=np.uint64(0))), packed(own[a:z]))
           for k, (a, z) in enumerate(itertools.pairwise(cut)) if z > a]
    return pa.RecordBatch.from_pylist([dict(zip(MESSAGE.names, row)) for row in out], MESSAGE)


def from_chunks(chunked: DataFrame, groups: int, width: int) -> DataFrame:
    """First level: the messages of every chunk; a group holds the chunks that hash to it."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                yield messages(row["grp"], 0, row["chunk"], *row_chunk(row).asked(), width, width)
    grp = F.pmod(F.xxhash64("chunk"), F.lit(groups)).alias("grp")
    return chunked.select(grp, "chunk", "numbers", "sizes", "hashes", "held").mapInArrow(of, ddl(MESSAGE))


def from_nodes(nodes: DataFrame, width: int, ranges: int) -> DataFrame:
    """A further level: the messages of every node; ``width`` neighbouring groups make a wider one."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                keys = np.cumsum(unpacked(row["keys"]), dtype=np.uint64)
                yield messages(row["grp"] // width, row["part"], row["grp"], keys, unpacked(row["own"]), width, ranges)
    return nodes.select("grp", "part", "keys", "own").mapInArrow(of, ddl(MESSAGE))


def added(table: pa.Table) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """One node's messages: distinct keys in order, their sums, and where each message's keys stand."""
    keys = [np.cumsum(unpacked(x.as_py()), dtype=np.uint64) for x in table.column("keys")]
    own = np.concatenate([unpacked(x.as_py()) for x in table.column("own")])
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(place, weights=own, minlength=len(distinct)).astype(np.uint64)
    cut = np.cumsum([0, *map(len, keys)])
    return distinct, total, [place[a:z] for a, z in itertools.pairwise(cut)]


def as_node(table: pa.Table) -> pa.Table:
    """A node below the top: its sums to send on, and what it needs to answer its senders."""
    distinct, total, places = added(table)
    return pa.Table.from_pylist([{
        "grp": table.column("grp")[0].as_py(), "part": table.column("part")[0].as_py(),
        "srcs": table.column("src").to_pylist(),
        "places": [packed(np.diff(p, prepend=0).astype(np.uint32)) for p in places],
        "keys": packed(np.diff(distinct, prepend=np.uint64(0))), "own": packed(total)}], NODE)


def top(table: pa.Table) -> pa.Table:
    """A node of the top level: answers to its senders; ``types`` (words seen) on the first row."""
    distinct, total, places = added(table)
    seen = int(((total > 0) & (distinct & ONE == 0)).sum())
    return pa.table([table.column("src"), table.column("part"), pa.array([packed(total[p]) for p in places], pa.binary()),
                     pa.array([seen] + [0] * (len(places) - 1), pa.int64())], ANSWER)


def handed_down(nodes: DataFrame, answers: DataFrame, width: int) -> DataFrame:
    """Answers to a level's nodes, handed on to the senders of each."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                total = in_order(row["answers"])
                yield pa.RecordBatch.from_pylist([
                    {"src": s, "part": row["part"], "types": 0,
                     "totals": packed(total[np.cumsum(unpacked(p), dtype=np.int64)])}
                    for s, p in zip(row["srcs"], row["places"])], ANSWER)
    # One list per node, of at most ``width`` answers.
    back = (answers.groupBy(F.col("src").alias("grp"), F.expr(f"part div {width}").alias("node"))
            .agg(F.collect_list(F.struct("part", "totals")).alias("answers")).withColumnRenamed("node", "part"))
    return nodes.select("grp", "part", "srcs", "places").join(back, ["grp", "part"]).mapInArrow(of, ddl(ANSWER))


def in_order(answers: list) -> np.ndarray:
    return np.concatenate([unpacked(t) for _, t in sorted((a["part"], a["totals"]) for a in answers)])


def totals_of(chunked: DataFrame, keys: int, keys_per_range: int) -> tuple[DataFrame, int]:
    """(answers to every chunk: ``src``, ``part``, ``totals``; number of words seen in training)."""
    depth, width = levels(max(1, -(-keys // keys_per_range)), FAN)
    sent, nodes = from_chunks(chunked, width ** (depth - 1), width), []
    for n in range(1, depth):
        nodes.append(stored(sent.groupBy("grp", "part").applyInArrow(as_node, ddl(NODE)), "lm-nodes", free_shuffles=True))
        sent = from_nodes(nodes[-1], width, width ** (n + 1))
    answers = stored(sent.groupBy("grp", "part").applyInArrow(top, ddl(ANSWER)), "lm-answers", free_shuffles=True)
    types = int(answers.agg(F.coalesce(F.sum("types"), F.lit(0))).first()[0])
    for level_nodes in reversed(nodes):
        answers = stored(handed_down(level_nodes, answers, width), "lm-answers", free_shuffles=True)
    return answers, types


def with_totals(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, Chunk, np.ndarray, np.ndarray]]:
    """(row, chunk, training counts of its words, of its pairs) of each joined row."""
    for b in rows:
        for i in range(b.num_rows):
            row = b.slice(i, 1).to_pylist()[0]
            state = row_chunk(row)
            yield row, state, *state.answered(in_order(row["answers"]))


def level(p: np.ndarray) -> np.ndarray:
    """Grid level of a probability: 0 for 0, then quarter octaves down from 1."""
    with np.errstate(divide="ignore"):
        octave = np.floor(-np.log2(p) * PER_OCTAVE)
    return np.where(p > 0, 1 + np.clip(octave, 0, LEVELS - 2), 0).astype(np.int64)


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for an unseen context, else 1 + the power of two of its count."""
    return np.where(count > 0, 1 + np.floor(np.log2(np.maximum(count, 1))), 0).clip(0, BUCKETS - 1).astype(np.int64)


def held_out_cells(joined: DataFrame, n: int, docs: int) -> list:
    """Training tokens by (context bucket, level of the pair estimate, of the word estimate), all deleted by one."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, state, words, pairs in with_totals(batches):
            weight = np.bincount(state.pair_of[state.token_train], minlength=len(state.pairs))
            used = weight > 0
            weight = weight[used].astype(float)
            context = np.append(words, docs)[state.left[used]] - 1
            p2 = np.where(context > 0, (pairs[used] - 1) / np.maximum(context, 1), 0.0)
            p1 = (words[state.right[used]] - 1) / max(n - 1, 1)
            cell = (bucket(context) * LEVELS + level(p2)) * LEVELS + level(p1)
            distinct, place = np.unique(cell, return_inverse=True)
            sums = [np.bincount(place, weights=weight * x, minlength=len(distinct)) for x in (1.0, p2, p1)]
            yield pa.RecordBatch.from_arrays([pa.array(distinct), *map(pa.array, sums)], ["cell", "n", "s2", "s1"])

    cells = joined.mapInArrow(of, "cell bigint, n double, s2 double, s1 double")
    # At most BUCKETS x LEVELS x LEVELS rows, whatever the corpus.
    return cells.groupBy("cell").agg(F.sum("n"), F.sum("s2"), F.sum("s1")).collect()


def mixture(cells: list, types: int) -> np.ndarray:
    """EM over the cells: weights (pair, word, uniform) of each context bucket."""
    weights = np.tile([0.0, 0.5, 0.5], (BUCKETS, 1))
    table = np.array([tuple(c) for c in cells], dtype=float).reshape(-1, 4)
    if not len(table):  # nothing learned: every word is as likely
        return np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    at = table[:, 0].astype(np.int64) // (LEVELS * LEVELS)
    for b in range(BUCKETS):
        own = table[at == b]
        if not len(own):
            continue
        n = own[:, 1]
        p = np.column_stack([own[:, 2] / n, own[:, 3] / n, np.full(len(n), 1 / (types + 1))])
        w = np.full(3, 1 / 3)
        for _ in range(ROUNDS):
            share = p * w
            new = (n[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            if np.abs(new - w).max() < 1e-9:
                break
            w = new
        weights[b] = np.maximum(w, [0, 0, 1e-9])
    weights[0] = [0.0, *(weights[0, 1:] / max(weights[0, 1:].sum(), 1e-300))]  # nothing follows an unseen context
    seen = [b for b in range(1, BUCKETS) if (at == b).any()]
    for b in range(1, BUCKETS):  # a bucket without held-out tokens takes its nearest neighbour's weights
        if seen and b not in seen:
            weights[b] = weights[min(seen, key=lambda s: abs(s - b))]
    return weights / weights.sum(axis=1, keepdims=True)


RESULT = "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    keys_per_range: int = KEYS_PER_RANGE) -> DataFrame:
    """Log10 probability of every whole text under the model of all rows that are not held out.

    Columns: the id, ``held_out``, ``n_tokens`` (words and one end),
    ``n_known`` (tokens seen in training), ``train_tokens``, ``base_score``
    (add-0.1 unigram) and ``score`` (interpolated bigram).  Other columns are
    not returned, whatever they are called.

    A text is never cut: one above ``CHUNK_CHARS`` is a chunk of its own.
    Null text counts as empty: one end token.  Repeated rows are counted and
    scored each; null ids stay null.  If nothing is left to learn from, both
    scores follow from zero counts; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    chunked = chunks(docs, held_out, id_col, text_col)
    t = chunked.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("train_docs", "train_tokens", "n_words", "n_pairs")]).first()
    n_docs, n = int(t[0]), int(t[1])
    answers, types = totals_of(chunked, int(t[2]) + int(t[3]), keys_per_range)
    # One list per chunk, of at most FAN answers.
    by_chunk = answers.groupBy(F.col("src").alias("chunk")).agg(F.collect_list(F.struct("part", "totals")).alias("answers"))
    joined = stored(chunked.select("chunk", "ids", "held", "sizes", "numbers", "hashes")
                    .join(by_chunk, "chunk"), "lm-joined", free_shuffles=True)
    weights = mixture(held_out_cells(joined, n, n_docs), types)
    id_type = to_arrow_type(docs.schema[id_col].dataType)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, state, words, pairs in with_totals(batches):
            context = np.append(words, n_docs)[state.left]
            w = weights[bucket(context)]
            p = (w[:, 0] * np.where(context > 0, pairs / np.maximum(context, 1), 0.0)
                 + w[:, 1] * words[state.right] / max(n, 1) + w[:, 2] / (types + 1))
            base = np.log10((words + ADD) / (n + ADD * (types + 1)))
            token = (np.log10(p)[state.pair_of], base[state.word], (words > 0)[state.word].astype(np.int64))
            score, plain, known = (np.add.reduceat(x, state.first) for x in token)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], id_type), pa.array(row["held"], pa.bool_()), pa.array(state.sizes),
                 pa.array(known), pa.array(np.full(len(known), n)), pa.array(plain), pa.array(score)],
                ["id", "held_out", *[f.split()[0] for f in RESULT.split(", ")]])

    return joined.mapInArrow(of, f"id {kind}, held_out boolean, {RESULT}").withColumnRenamed("id", id_col)
