"""SimHash near-duplicate groups, linked through sharded BK-trees.

1. Every text becomes a 64-bit fingerprint (majority bits of its shingles'
   XXH64) and the distinct fingerprints are taken: copies are one node.
2. Shards: with 64 bits cut into ``b`` blocks, two fingerprints at most ``r``
   bits apart agree in at least ``b - r`` blocks, so each fingerprint joins
   one shard per choice of ``b - r`` blocks and every link is inside a shard.
3. Each shard becomes BK-trees of at most ``TREE_ITEMS`` fingerprints.  A
   shard above that is split into several trees, and each tree is sent to
   the query chunks of its shard: the work of a hot shard spreads over tasks.
   Children are keyed by integer distance to their parent and a query
   follows only the edges within the radius.
4. A task turns the links it found into stars (member, smallest member), so
   a dense group yields edges in proportion to its members, not its pairs.
5. The stars are merged by alternating large-star and small-star rounds,
   each cut by a checkpoint; labels never pass through the driver.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlake.llm.shared import col, shared_root, stored, text_of

SHINGLE = 3
RADIUS = 3
SEED = 42
# Fingerprints per BK-tree, and entries of a tree kept as one bucket.
TREE_ITEMS = 2048
BUCKET = 32
# Hashes whose bits are counted at a time, so that a very long text needs no more.
BITS_AT_ONCE = 1 << 16
# A fingerprint with more than one in so many rows is heavy: at most so many are.
HEAVY_SHARE = 1000
# Mean shard size aimed at when the number of blocks is chosen.
MEAN_SHARD = 256


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64-bit SimHash; a bit is set if set in over half of the shingle hashes."""
    words = text.encode("utf-8").lower().split()  # bytes: A-Z only, ASCII space only
    if not words:
        return 0
    if len(words) < shingle:
        runs = iter([b" ".join(words)])
        n = 1
    else:
        runs = map(b" ".join, zip(*(itertools.islice(words, k, None) for k in range(shingle))))
        n = len(words) - shingle + 1
    hashes = map(xxhash.xxh64_intdigest, runs, itertools.repeat(SEED))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, BITS_AT_ONCE):
        h = np.fromiter(itertools.islice(hashes, BITS_AT_ONCE), dtype="<u8", count=min(BITS_AT_ONCE, n - at))
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id``, ``key`` (hash of the raw text) and ``fp`` (the 64 bits as a long) per row."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in map(str, b.column("text"))),
                             dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("key"), pa.array(fp.view(np.int64))], ["id", "key", "fp"])

    rows = docs.select(col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("key"),
                       text_of(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(of, f"id {kind}, key bigint, fp bigint")


class BKTree:
    """BK-tree over 64-bit fingerprints that answers many queries in one walk."""

    def __init__(self, items: np.ndarray, places: np.ndarray):
        self.bucket = None
        if len(items) <= BUCKET:
            self.bucket = (items, places)
            return
        self.root, self.place = items[0], int(places[0])
        far = np.bitwise_count(items[1:] ^ self.root)
        self.children = [(int(d), BKTree(items[1:][far == d], places[1:][far == d])) for d in np.unique(far)]

    def links(self, queries: np.ndarray, asked: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query place, item place) at most ``radius`` bits apart."""
        if self.bucket is not None:
            items, places = self.bucket
            q, i = np.nonzero(np.bitwise_count(queries[:, None] ^ items[None, :]) <= radius)
            yield asked[q], places[i]
            return
        far = np.bitwise_count(queries ^ self.root).astype(np.int16)
        near = asked[far <= radius]
        yield near, np.full(len(near), self.place)
        for d, child in self.children:
            on = np.abs(far - d) <= radius
            if on.any():
                yield from child.links(queries[on], asked[on], radius)


def stars(tree: np.ndarray, queries: np.ndarray, same: bool, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between a tree's items and the queries, as (member, smallest member) edges."""
    nodes = tree if same else np.concatenate([tree, queries])
    asked = np.arange(len(nodes)) if same else np.arange(len(tree), len(nodes))
    pairs = list(BKTree(tree, np.arange(len(tree))).links(nodes[asked], asked, radius))
    a, b = (np.concatenate(x) for x in zip(*pairs))
    a, b = a[a != b], b[a != b]
    order = np.argsort(nodes.view(np.int64), kind="stable")
    label = np.empty(len(nodes), dtype=np.int64)
    label[order] = np.arange(len(nodes))  # rank by value, so the least label is the least fingerprint
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[order[label]]
        if (label == before).all():
            break
    roots = nodes[order[label]]
    moved = roots != nodes
    return nodes[moved], roots[moved]


def link_units(radius: int):
    """mapInArrow body over rows sorted by unit (shard, i, j): the stars of each unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        unit = None

        def flush():
            fp = np.concatenate([x[0] for x in held]).view(np.uint64)
            chunk = np.concatenate([x[1] for x in held])
            first = chunk == unit[1]
            a, b = stars(fp[first], fp[~first], unit[1] == unit[2], radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["u", "v"])

        for batch in batches:
            shard, i, j, chunk, fp = (batch.column(n).to_numpy(zero_copy_only=False)
                                      for n in ("shard", "i", "j", "chunk", "fp"))
            if not len(fp):
                continue
            cut = np.flatnonzero((np.diff(shard) != 0) | (np.diff(i) != 0) | (np.diff(j) != 0)) + 1
            for a, z in zip([0, *cut.tolist()], [*cut.tolist(), len(fp)]):
                now = (int(shard[a]), int(i[a]), int(j[a]))
                if unit is not None and now != unit:
                    yield flush()
                    held = []
                unit = now
                held.append((fp[a:z], chunk[a:z]))
        if held:
            yield flush()
    return run


def shard_keys(fp: Column, blocks: int, radius: int) -> Column:
    """One key per choice of ``blocks - radius`` blocks: its number and the blocks' bits."""
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(itertools.combinations(range(blocks), blocks - radius)):
        value, width = F.lit(0).cast("bigint"), 0
        for k in chosen:
            size = edges[k + 1] - edges[k]
            part = F.shiftrightunsigned(fp, edges[k]).bitwiseAND(F.lit((1 << size) - 1))
            value, width = value.bitwiseOR(F.shiftleft(part, width)), width + size
        keys.append(value.bitwiseOR(F.lit(number << width)))
    return F.array(*keys)


def blocks_for(n: int, radius: int) -> int:
    """Fewest blocks whose shards hold ``MEAN_SHARD`` of ``n`` fingerprints on average."""
    blocks = radius + 1
    while n >> (64 * (blocks - radius) // blocks) > MEAN_SHARD and blocks < radius + 4:
        blocks += 1
    return blocks


def links(fps: DataFrame, radius: int, tree_items: int = TREE_ITEMS) -> DataFrame:
    """Star edges ``u`` -> ``v`` (v < u) that connect all fingerprints within the radius."""
    keys = fps.select("fp", F.explode(shard_keys(F.col("fp"), blocks_for(fps.count(), radius), radius)).alias("shard"))
    sized = keys.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = (keys.join(sized, "shard")
              .withColumn("trees", F.ceil(F.col("n") / tree_items).cast("int"))
              .withColumn("chunk", F.pmod(F.xxhash64("fp"), F.col("trees")).cast("int")))
    pairs = F.transform(F.sequence(F.lit(0), F.col("trees") - 1), lambda k: F.struct(
        F.least(k, F.col("chunk")).alias("i"), F.greatest(k, F.col("chunk")).alias("j")))
    units = placed.select("shard", "fp", "chunk", F.inline(pairs))
    dealt = units.repartition("shard", "i", "j").sortWithinPartitions("shard", "i", "j")
    return dealt.mapInArrow(link_units(radius), "u bigint, v bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node`` -> ``root`` (smallest of its component) for every node of an edge.

    Alternates large-star and small-star until the edges are stars.  Only a
    count and a checksum of the edges reach the driver.
    """
    shared_root(edges.sparkSession)
    mark = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct().checkpoint()
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(least, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where(F.col("u") != F.col("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        edges = small.checkpoint()
        now = tuple(edges.agg(F.count(F.lit(1)), mark).first())
        if now == seen:
            break
        seen = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionByName(nodes.select(F.col("root").alias("node"), "root").distinct())


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS, tree_items: int = TREE_ITEMS) -> DataFrame:
    """One row per row of ``docs``: ``id``, ``key``, ``fp`` and ``first``.

    ``first`` is the component's smallest ``struct(no_id, id, key)``: the
    smallest id reachable over links of at most ``radius`` bits, null ids
    last, then the hash of the raw text.  Null text counts as empty; texts
    without words have fingerprint zero and are linked like any other.
    Repeated rows get repeated, equal results.  An empty table gives none.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "key")
    fps = rows.groupBy("fp").agg(F.min(order).alias("least"), F.count(F.lit(1)).alias("n"))
    roots = components(links(fps.select("fp"), radius, tree_items))
    member = fps.join(roots, F.col("fp") == F.col("node"))
    best = member.groupBy("root").agg(F.min("least").alias("best"))
    linked = roots.join(best, "root").select(F.col("node").alias("fp"), "best")
    first = stored(fps.join(linked, "fp", "left").select("fp", "n", F.coalesce("best", "least").alias("first")), "first")
    # fewer than HEAVY_SHARE fingerprints can hold more than that share of the rows: those are settled map-side
    heavy = F.col("n") > rows.count() / HEAVY_SHARE
    many = F.broadcast(first.where(heavy).select(F.col("fp").alias("_fp"), F.col("first").alias("_first")))
    split = rows.join(many, F.col("fp") == F.col("_fp"), "left")
    columns = ["fp", *[c for c in rows.columns if c != "fp"]]
    settled = split.where("_fp IS NOT NULL").select(*columns, F.col("_first").alias("first"))
    rest = split.where("_fp IS NULL").select(*columns).join(first.where(~heavy).select("fp", "first"), "fp")
    return settled.unionByName(rest)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each near-duplicate group, with the columns of ``docs``.

    The group's first document stays (smallest id, null ids last, then text
    hash).  Rows that repeat id and text are one document and stay together.
    """
    group = near_groups(docs, id_col, text_col, **options)
    lost = (group.where(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))))
            .select(F.col("id").alias("_lost_id"), F.col("key").alias("_lost_key")).distinct())
    same = col(id_col).eqNullSafe(F.col("_lost_id")) & (F.xxhash64(text_of(text_col)) == F.col("_lost_key"))
    return docs.join(lost.hint("shuffle_hash"), same, "left_anti")
