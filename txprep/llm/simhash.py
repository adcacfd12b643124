"""SimHash near-duplicates: fingerprints linked by Hamming distance, exactly.

Fingerprint: a bit is 1 if it is set in more than half of the XXH64 hashes of
the text's word shingles. Documents collapse to distinct fingerprints first, so
copies cost nothing.

Search by vantage-point trees. A single tree over all 64 bits prunes nothing at
a radius of 4: distances to any vantage point concentrate at 32 with a deviation
of 4, so nearly every shard overlaps every boundary. So the bits are cut in
``blocks``, and a tree is built over the projection on every choice of
``blocks - max_bits`` of them: two fingerprints within ``max_bits`` differ in at
most ``max_bits`` blocks, so in some projection their distance, and with it the
radius that the triangle bounds must keep, is 0. (With fewer blocks than
``max_bits`` + 1 the radius is 1 or more and boundary overlaps are visited.)

The sending trees are multiway: a level has a vantage point and a branch for
every distance to it, so at radius 0 the triangle bounds leave one branch a
level, and the path is the list of distances. A shard (leaf) is one Spark
group; its points meet exactly in a second tree in the task, binary, over the
full 64 bits with radius ``max_bits``, where the shells that the triangle bounds
let overlap meet across each boundary. A shard gives links that span its
components, at most one per point, so a dense group costs no quadratic output.
Links become components by alternating minimum steps, each written to the shared
folder; nothing but counts reaches the driver.

Defined results: a null text is empty; a text without words has fingerprint 0
and links like any other; repeated rows and equal texts share a fingerprint and
so a component; a null ``doc_id`` takes part, and a component's id is the
smallest id that is not null; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import text_or_empty, written

SHINGLE = 4
MAX_BITS = 4
SEED = 42
#: A shard up to this size is compared directly; larger ones by the tree.
LEAF = 256


def shingles(text: str, k: int = SHINGLE) -> list[bytes]:
    """Word shingles of a text, A-Z in lower case, repeats included; the whole
    sequence if there are fewer than ``k`` words, none without words."""
    w = text.encode().lower().split()          # splits at 0x20 and 0x09-0x0D
    if len(w) < k:
        return [b" ".join(w)] if w else []
    return [b" ".join(s) for s in zip(*[w[i:] for i in range(k)])]


def fingerprint(text: str, k: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text, as an unsigned 64-bit number."""
    from xxhash import xxh64_intdigest
    hashes = np.array([xxh64_intdigest(s, seed) for s in shingles(text, k)], dtype="<u8")
    if not len(hashes):
        return 0
    counts = np.zeros(64, dtype=np.int64)
    for lo in range(0, len(hashes), 4096):
        part = hashes[lo:lo + 4096]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, k, seed) for t in batch.column("text").to_pylist()], dtype=np.uint64)
            ids = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*map(batch.column, ids), pa.array(fps.view(np.int64))], names=[*ids, "fp"])
    return run


def fingerprints(docs: DataFrame, k: int = SHINGLE, seed: int = SEED, id_col: str = "doc_id",
                 text_col: str = "text", hashed: bool = False) -> DataFrame:
    """``doc_id, fp`` (the 64 bits as a signed long) per document; if ``hashed``
    also ``doc_hash``, that of its text."""
    text = text_or_empty(text_col)
    hashes = [F.xxhash64(text).alias("doc_hash")] if hashed else []
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), *hashes, text.alias("text"))
    return rows.mapInArrow(_fingerprints(k, seed), f"doc_id long, {'doc_hash long, ' if hashed else ''}fp long")


def distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class _Sets:
    """Union-find over the places of an array, joined towards the smallest."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = int(self.up[i])
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _compare(fps: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, sets: _Sets) -> None:
    for lo in range(0, len(a), LEAF):
        part = a[lo:lo + LEAF]
        rows, cols = np.nonzero(distance(fps[part][:, None], fps[b][None, :]) <= radius)
        for i, j in zip(part[rows].tolist(), b[cols].tolist()):
            sets.join(i, j)


def _cross(fps: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int, sets: _Sets, depth: int) -> None:
    """Pairs between two sets, by a vantage point of the larger one."""
    if not len(a) or not len(b):
        return
    if min(len(a), len(b)) <= LEAF or depth > 40:
        return _compare(fps, a, b, radius, sets)
    v = fps[(a if len(a) >= len(b) else b)[0]]
    da, db = distance(fps[a], v).astype(np.int16), distance(fps[b], v).astype(np.int16)
    m = int(np.median(np.concatenate([da, db])))
    if m >= max(da.max(), db.max()):
        m = max(int(da.max()), int(db.max())) - 1
    if m < min(da.min(), db.min()):
        return _compare(fps, a, b, radius, sets)
    # same sides meet whole; other sides only within the radius of the boundary
    _cross(fps, a[da <= m], b[db <= m], radius, sets, depth + 1)
    _cross(fps, a[da > m], b[db > m], radius, sets, depth + 1)
    _cross(fps, a[(da <= m) & (da > m - radius)], b[(db > m) & (db <= m + radius)], radius, sets, depth + 1)
    _cross(fps, a[(da > m) & (da <= m + radius)], b[(db <= m) & (db > m - radius)], radius, sets, depth + 1)


def _within(fps: np.ndarray, at: np.ndarray, radius: int, sets: _Sets) -> None:
    """Pairs within a set, by a vantage-point tree: inside, outside, and the
    two shells that the triangle bounds let meet across the boundary."""
    while True:
        if len(at) <= LEAF:
            return _compare(fps, at, at, radius, sets)
        d = distance(fps[at], fps[at[0]]).astype(np.int16)
        m = int(np.median(d))
        if m >= d.max():
            m = int(d.max()) - 1
        inside, outside = at[d <= m], at[d > m]
        if not len(inside) or not len(outside):      # all at one distance
            return _compare(fps, at, at, radius, sets)
        _cross(fps, at[(d <= m) & (d > m - radius)], at[(d > m) & (d <= m + radius)], radius, sets, 0)
        small, at = (inside, outside) if len(inside) < len(outside) else (outside, inside)
        _within(fps, small, radius, sets)


def spanning_links(fps: np.ndarray, radius: int) -> np.ndarray:
    """For each of distinct ``fps``, ascending, the smallest place that links
    within ``radius`` reach."""
    sets = _Sets(len(fps))
    _within(fps, np.arange(len(fps)), radius, sets)
    return np.array([sets.find(i) for i in range(len(fps))], dtype=np.int64)


def projections(max_bits: int, blocks: int) -> list[int]:
    """Masks of every choice of ``blocks - max_bits`` blocks of the 64 bits."""
    edges = np.linspace(0, 64, blocks + 1).astype(int)
    masks = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(edges, edges[1:])]
    return [sum(c) for c in itertools.combinations(masks, blocks - max_bits)]


def blocks_for(n: int, max_bits: int) -> int:
    """The fewest blocks whose projections have more values than there are
    fingerprints; exact for any number, this only sets the size of shards."""
    for blocks in range(max_bits + 1, 2 * max_bits + 3):
        if 64 * (blocks - max_bits) // blocks >= max(8, n.bit_length()):
            return blocks
    return 2 * max_bits + 2


def _shard_links(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by (tree, path); each run of one path is a shard."""
        def links(tree_path: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
            edges = np.flatnonzero(np.any(tree_path[1:] != tree_path[:-1], axis=1)) + 1
            bounds = np.concatenate([[0], edges, [len(fps)]])
            sizes = np.diff(bounds)
            src, dst = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
            two = bounds[:-1][sizes == 2]              # most shards with a pair have just one
            two = two[distance(fps[two], fps[two + 1]) <= max_bits]
            src.append(fps[two + 1])
            dst.append(fps[two])
            for a, n in zip(bounds[:-1][sizes > 2], sizes[sizes > 2]):
                part = np.sort(fps[a:a + n])
                low = spanning_links(part, max_bits)
                linked = low != np.arange(n)
                src.append(part[linked])
                dst.append(part[low[linked]])
            return pa.RecordBatch.from_pydict({"src": pa.array(np.concatenate(src).view(np.int64)),
                                               "dst": pa.array(np.concatenate(dst).view(np.int64))})

        keys, fps = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            k = np.column_stack([batch.column("tree").to_numpy(zero_copy_only=False).astype(np.int64),
                                 batch.column("path").to_numpy(zero_copy_only=False)])
            f = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            keys, fps = np.concatenate([keys, k]), np.concatenate([fps, f])
            # the last shard may go on in the next batch
            other = np.flatnonzero(np.any(keys != keys[-1], axis=1)) if len(keys) else []
            if len(other):
                cut = int(other[-1]) + 1
                yield links(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(fps):
            yield links(keys, fps)
    return run


def fingerprint_links(distinct: DataFrame, n: int, max_bits: int = MAX_BITS) -> DataFrame:
    """Links ``src, dst`` (``dst`` the smaller) that connect all of ``fp``
    within ``max_bits`` of each other."""
    masks = projections(max_bits, blocks_for(n, max_bits))
    # a level of a tree tells about 3 bits of a point; more levels than shards can use cost time
    levels = min(10, n.bit_length() // 3 + 2)
    points = np.random.default_rng(SEED).integers(0, 1 << 63, size=(len(masks), levels), dtype=np.int64)

    def path(mask: int, vantage) -> Column:
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        seen = F.lit(0).cast("long")
        for v in vantage:                      # a distance takes 6 bits: at most 60 bits differ from v
            d = F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(v))).bitwiseAND(F.lit(signed)))
            seen = F.shiftleft(seen, 6).bitwiseOR(d.cast("long"))
        return seen

    trees = F.array(*[F.struct(F.lit(i).alias("tree"), path(m, points[i]).alias("path")) for i, m in enumerate(masks)])
    # a number of its own: few bytes in would be few tasks, and each row becomes one a tree
    spread = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fp")
    sent = spread.select("fp", F.explode(trees).alias("t")).select(F.col("t.tree"), F.col("t.path"), "fp")
    shards = sent.repartition("tree", "path").sortWithinPartitions("tree", "path")
    return shards.mapInArrow(_shard_links(max_bits), "src long, dst long").distinct()


def connect(spark: SparkSession, links: DataFrame) -> DataFrame:
    """``node, root`` for the nodes of ``links``: the smallest node reachable.

    Alternating steps: every node's larger neighbours, then every node's smaller
    ones, are hung on its smallest neighbour, until every link points to a root.
    """
    edges = written(spark, links.filter(F.col("src") != F.col("dst")).select("src", "dst").distinct(), "links")
    if edges.isEmpty():
        return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    while True:
        both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        low = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("m"))
        # larger neighbours to the minimum
        large = both.filter(F.col("dst") > F.col("src")).join(low, "src") \
            .select(F.col("dst").alias("src"), F.col("m").alias("dst")).filter(F.col("src") != F.col("dst"))
        large = large.unionByName(low.filter(F.col("m") < F.col("src")).select("src", F.col("m").alias("dst"))).distinct()
        # smaller neighbours, and the node itself, to the minimum of those
        small_low = large.groupBy("src").agg(F.min("dst").alias("m"))
        small = large.join(small_low, "src")
        small = small.filter(F.col("dst") != F.col("m")).select(F.col("dst").alias("src"), F.col("m").alias("dst")) \
            .unionByName(small_low.select("src", F.col("m").alias("dst"))).distinct()
        new = written(spark, small, "links")
        # done when every node has one parent and no parent has one itself
        parents = new.groupBy("src").agg(F.count("*").alias("n"))
        open_ = parents.filter(F.col("n") > 1).limit(1).count() or \
            new.join(parents.select(F.col("src").alias("dst")), "dst", "left_semi").limit(1).count()
        edges = new
        if not open_:
            return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))


def _classes(spark: SparkSession, fps: DataFrame, low: Column, max_bits: int) -> DataFrame:
    """``fp, low, root`` per distinct fingerprint; ``low`` is aggregated over its
    documents, and equal roots are one component."""
    distinct = fps.groupBy("fp").agg(low.alias("low"))
    n = distinct.count()
    roots = connect(spark, fingerprint_links(distinct.select("fp"), n, max_bits))
    return distinct.join(roots, F.col("fp") == F.col("node"), "left") \
        .select("fp", "low", F.coalesce("root", "fp").alias("root"))


def components(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` per document of ``docs``."""
    fps = written(spark, fingerprints(docs, k, seed, id_col, text_col), "fingerprints")
    classes = _classes(spark, fps, F.min("doc_id"), max_bits)
    lowest = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    # all about fingerprints first: documents are dealt once, by a key that a hot text's copies share, and as
    # nothing is dealt after that, adaptive execution may split those
    named = written(spark, classes.join(lowest, "root").select("fp", "component_id"), "components")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def survivors(spark: SparkSession, docs: DataFrame, k: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, doc_hash`` of one document per component: the smallest id (null
    ids last), and of its texts the one with the smallest hash."""
    fps = written(spark, fingerprints(docs, k, seed, id_col, text_col, hashed=True), "fingerprints")
    low = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "doc_hash"))
    lowest = _classes(spark, fps, low, max_bits).groupBy("root").agg(F.min("low").alias("low"))
    return lowest.select("low.doc_id", "low.doc_hash")
