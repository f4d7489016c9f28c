"""N-gram Jaccard join of all documents, by vertical partitioning of the n-gram order.

Sets of word shingles are ordered by one global order, rare shingles first. Two
sets that are similar enough share several shingles of their prefixes in that
order, so prefixes give the candidate pairs. The order is cut into fragments,
every candidate's set with it, partial overlaps are counted per fragment, and
their sum per pair is held against the limit. The result is exact.

Equal sets are one node. Only components are asked for, so a bucket of sets that
share a prefix shingle is first met by one of its sets (a star) and pairs within
a component are not looked at again: a group of near copies costs a number of
pairs in line with its size, where all its pairs would cost the square. What
still stands in different components meets by the shingles early enough in both
prefixes, and is compared in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyframe.llm.components import connected_components
from tallyframe.llm.encoding import by_size
from tallyframe.llm.words import Words, mixed, word_hash
from tallyframe.staging import release, stage, stage_side

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_BIN_BITS, _CHUNK_BITS = 22, 16
_SALTS = 256
_LEVELS = 256


@dataclass(frozen=True)
class Similarity:
    """Linked from ``percent`` of the union on.

    A prefix is as long as it takes that linked sets share at least ``shared``
    of its shingles, and one in ``shared_of`` of the smaller set's: sets that
    meet in a few frequent shingles by chance are no candidates.
    """

    size: int = 4
    percent: int = 85
    shared: int = 3
    shared_of: int = 8
    fragments: int = 8

    def __post_init__(self):
        # Unequal linked sets overlap in at least percent / (100 - percent)
        # shingles, which the number of shared prefix shingles must not pass.
        if self.shared > 1 and self.shared * (100 - self.percent) > self.percent or self.shared_of < 2:
            raise ValueError("too many shared prefix shingles for this similarity")

    def prefix(self, n: np.ndarray) -> np.ndarray:
        return np.minimum(n, n + n * -self.percent // 100 + np.maximum(self.shared, n // self.shared_of))

    def least_shared(self, n: Column) -> Column:
        return F.greatest(F.lit(self.shared), F.floor(n / self.shared_of))


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all shingles of all texts, and the bounds of each text's.

    Words are runs of anything but ASCII blanks, A-Z in lower case. A text of
    fewer words than ``size`` has its whole sequence as its one shingle.
    """
    words = Words(texts)
    hashes = words.mapped(word_hash, np.uint64)
    counts = np.diff(words.bounds)
    rolled = np.zeros(len(hashes), np.uint64)
    for k in range(size):
        full = max(0, len(hashes) - k)
        rolled[:full] = rolled[:full] * _FACTOR + hashes[k:]
    starts = np.maximum(counts - size + 1, 0)
    whole = np.arange(len(hashes)) - np.repeat(words.bounds[:-1], counts) < np.repeat(starts, counts)
    short = (counts > 0) & (counts < size)
    made = np.where(short, 1, starts)
    bounds = np.concatenate([[0], np.cumsum(made)])
    out = np.empty(bounds[-1], np.uint64)
    out[np.repeat(~short, made)] = rolled[whole]
    if short.any():
        # The whole sequence, and its length with it.
        value, alone = counts[short].astype(np.uint64), words.bounds[:-1][short]
        for k in range(size - 1):
            more = counts[short] > k
            value[more] = value[more] * _FACTOR + hashes[alone[more] + k]
        out[bounds[:-1][short]] = value
    return mixed(out), bounds


def _sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    hashes, bounds = shingle_hashes(texts, size)
    return [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _node(shingles: np.ndarray) -> int:
    """A signed 64-bit name of a set."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64)) if len(shingles) else 0


class ShingleOrder:
    """The global order: level of frequency, then hash.

    Frequencies are counts of shingles over all documents in hashed bins, of
    which there is a fixed number; any order is a right one, a finer one gives
    shorter buckets.
    """

    def __init__(self, counts: np.ndarray, fragments: int):
        scaled = np.floor(8 * np.log2(1.0 + counts)).astype(np.int64)
        self.levels = np.minimum(scaled, _LEVELS - 1).astype(np.uint8)
        mass = np.bincount(self.levels, weights=counts, minlength=_LEVELS)
        self.cuts = self._cuts(mass, fragments)

    @staticmethod
    def _cuts(mass: np.ndarray, fragments: int) -> np.ndarray:
        """Keys that cut the order into fragments of about equal mass; inside a level hashes are even."""
        ends = np.cumsum(mass)
        cuts = []
        for k in range(1, fragments):
            goal = ends[-1] * k / fragments
            level = int(np.searchsorted(ends, goal))
            level = min(level, _LEVELS - 1)
            share = (goal - (ends[level] - mass[level])) / mass[level] if mass[level] else 0.0
            cuts.append((level << 56) | min(int(share * (1 << 56)), (1 << 56) - 1))
        return np.array(cuts, np.uint64)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        level = self.levels[(shingles >> np.uint64(64 - _BIN_BITS)).astype(np.int64)]
        return (level.astype(np.uint64) << np.uint64(56)) | (shingles >> np.uint64(8))

    def prefix(self, shingles: np.ndarray, length: int) -> np.ndarray:
        return shingles[np.argsort(self.keys(shingles), kind="stable")[:length]]

    def fragments(self, shingles: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        at = np.searchsorted(self.cuts, self.keys(shingles), side="right")
        for fragment in np.unique(at).tolist():
            yield fragment, shingles[at == fragment]


def shingle_order(docs: DataFrame, text_col: str, like: Similarity) -> ShingleOrder:
    """Count the shingles of all documents in bins; the driver reads the summed bins (16 MB, fixed).

    Tasks' counts are summed in two steps, first in ``_SALTS`` shares: no group
    holds more than a share of the tasks' chunks, or one chunk of every share.
    """

    def count(batches):
        total = np.zeros(1 << _BIN_BITS, np.uint32)
        for batch in batches:
            for part in by_size(batch, text_col):
                hashes, _ = shingle_hashes(part[text_col], like.size)
                bins, met = np.unique(hashes >> np.uint64(64 - _BIN_BITS), return_counts=True)
                total[bins.astype(np.int64)] += met.astype(np.uint32)
        packer = zstandard.ZstdCompressor(level=1)
        chunks = total.reshape(-1, 1 << _CHUNK_BITS)
        used = np.flatnonzero(chunks.any(axis=1))
        packed = [packer.compress(chunks[i].astype(np.uint64).tobytes()) for i in used.tolist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(packed, pa.binary())], names=["chunk", "counts"]
        )

    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor()
        total = np.zeros(1 << _CHUNK_BITS, np.uint64)
        for packed in table["counts"]:
            total += np.frombuffer(unpack.decompress(packed.as_py()), np.uint64)
        packed = zstandard.ZstdCompressor(level=1).compress(total.tobytes())
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": pa.array([packed], pa.binary())})

    schema = "chunk int, counts binary"
    salted = docs.select(text_col).mapInArrow(count, schema).withColumn("salt", F.spark_partition_id() % _SALTS)
    shares = salted.groupBy("chunk", "salt").applyInArrow(add, schema)
    summed = shares.groupBy("chunk").applyInArrow(add, schema)
    unpack = zstandard.ZstdDecompressor()
    counts = np.zeros((1 << (_BIN_BITS - _CHUNK_BITS), 1 << _CHUNK_BITS))
    for row in summed.collect():
        counts[row["chunk"]] = np.frombuffer(unpack.decompress(bytes(row["counts"])), np.uint64)
    return ShingleOrder(counts.reshape(-1), like.fragments)


def _prefixes(docs: DataFrame, id_col: str, text_col: str, order, like: Similarity) -> DataFrame:
    """``(id, n, node, prefix)`` of every row."""
    schema = T.StructType(
        [
            T.StructField("id", docs.schema[id_col].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("prefix", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches):
        for batch in batches:
            for part in by_size(batch, text_col):
                sets = _sets(part[text_col], like.size)
                n = np.fromiter(map(len, sets), np.int64, len(sets))
                prefixes = [order.value.prefix(s, k) for s, k in zip(sets, like.prefix(n).tolist(), strict=True)]
                ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part[id_col],
                        pa.array(n),
                        pa.array([_node(s) for s in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64))),
                    ],
                    names=schema.fieldNames(),
                )

    return docs.select(id_col, text_col).mapInArrow(run, schema)


def _fragments(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame, order, like: Similarity) -> DataFrame:
    """``(node, fragment, shingles)`` of the wanted nodes, from the text of one document each.

    The wanted ids meet the texts by a broadcast when their rows and bytes are
    few (``stage_side``), by an equality join else.
    """
    side = stage_side(wanted.select(F.col("id").alias("_wanted"), "node"), "shingle-wanted")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    texts = rows.join(side, F.col("_id") == F.col("_wanted")).select("node", "text")

    def run(batches):
        for batch in batches:
            for part in by_size(batch, "text"):
                nodes, at, parts = [], [], []
                for node, shingles in zip(part["node"].to_pylist(), _sets(part["text"], like.size), strict=True):
                    if _node(shingles) != node:  # another row with the same id
                        continue
                    for fragment, some in order.value.fragments(shingles):
                        nodes.append(node)
                        at.append(fragment)
                        parts.append(some.view(np.int64))
                ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
                flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(nodes, pa.int64()),
                        pa.array(at, pa.int32()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                    ],
                    names=["node", "fragment", "shingles"],
                )

    made = texts.mapInArrow(run, "node long, fragment int, shingles array<long>")
    return stage(made, "shingle-fragments")


def _long_enough(a: str, b: str, like: Similarity) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * like.percent


def _overlap(a: Column, b: Column, like: Similarity) -> Column:
    return F.ceil((a + b) * like.percent / (100 + like.percent) - 1e-6)


def _behind(n: Column, like: Similarity) -> Column:
    """Shingles behind the prefix; below 0 where the prefix is the whole set."""
    return F.ceil(n * like.percent / 100 - 1e-6) - like.least_shared(n)


def _needed(a: Column, b: Column, like: Similarity) -> Column:
    """Prefix shingles that two sets of these sizes must share to be similar enough.

    Of the two, take the set whose prefix ends first in the order: all its
    prefix shingles that the other has lie in the other's prefix, and the rest
    of the overlap lies behind its prefix.
    """
    behind = F.greatest(_behind(a, like), _behind(b, like), F.lit(0))
    least = F.least(like.least_shared(a), like.least_shared(b))
    return F.greatest(_overlap(a, b, like) - behind, least).cast("long")


def _least_needed(n: Column, smallest: Column, largest: Column, like: Similarity) -> Column:
    """No more than ``_needed`` of ``n`` and any size from ``smallest`` to ``largest``.

    Overlap less the greatest of what may lie behind is the lesser of two
    differences. Less what lies behind ``n`` (or 0) it grows with the partner's
    size m, so it is least at ``smallest``. Less what lies behind m it is more
    than ``line(m) - 2``: the overlap is rounded up, and of what lies behind a
    ceil and a floor make less than one each. ``line`` is straight up to
    m = shared * shared_of and from there on, bent upwards, so it is least at
    an end or there.
    """
    p, bend = like.percent, F.lit(like.shared * like.shared_of)

    def line(m: Column) -> Column:
        return (n + m) * p / (100 + p) - m * p / 100 + F.greatest(F.lit(like.shared), m / like.shared_of)

    straight = F.least(line(smallest), line(largest), line(F.least(F.greatest(bend, smallest), largest)))
    first = _overlap(n, smallest, like) - F.greatest(_behind(n, like), F.lit(0))
    least = F.least(like.least_shared(n), like.least_shared(smallest))
    return F.greatest(F.least(first, F.floor(straight - 1e-6) - 1), least).cast("long")


def verified_links(pairs: DataFrame, fragments: DataFrame, like: Similarity) -> DataFrame:
    """Of ``pairs(a, b, na, nb)`` those similar enough: partial overlaps per fragment, summed per pair."""
    fragments = fragments.dropDuplicates(["node", "fragment"])
    left = fragments.select(F.col("node").alias("a"), "fragment", F.col("shingles").alias("sa"))
    right = fragments.select(F.col("node").alias("b"), "fragment", F.col("shingles").alias("sb"))
    overlap = F.size(F.array_intersect("sa", "sb"))
    summed = (
        pairs.join(left, "a")
        .join(right, ["b", "fragment"])
        .select("a", "b", "na", "nb", overlap.alias("part"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("part").alias("both"))
    )
    return summed.where(F.col("both") * 100 >= (F.col("na") + F.col("nb") - F.col("both")) * like.percent).select(
        "a", "b"
    )


def _bounds() -> tuple[Column, Column]:
    return F.min("n").alias("low_n"), F.max("n").alias("high_n")


class _Buckets:
    """Nodes that share a prefix shingle with another, with their components so far."""

    def __init__(self, postings: DataFrame, like: Similarity):
        self._like = like
        shared = postings.groupBy("shingle").agg(*_bounds(), F.count("*").alias("members")).where("members > 1")
        rows = postings.join(shared.drop("members"), "shingle").withColumn("component", F.col("node"))
        self.rows = self._pruned(rows)

    def _pruned(self, rows: DataFrame) -> DataFrame:
        """Without nodes that share too few shingles for any partner in a bucket.

        ``shared`` counts a node's buckets, of which it has no more than prefix
        shingles. It must be no less than any partner asks for whose size the
        bucket holds and the limit allows.
        """
        like, n = self._like, F.col("n")
        smallest = F.greatest("low_n", F.ceil(n * like.percent / 100 - 1e-6))
        largest = F.least("high_n", F.floor(n * 100 / like.percent + 1e-6))
        needed = _least_needed(n, smallest, largest, like)
        counted = rows.withColumn("shared", F.count("*").over(Window.partitionBy("node")))
        kept = counted.where((smallest <= largest) & (F.col("shared") >= needed))
        return stage(kept.select("shingle", "pos", "node", "n", "component", "shared"), "open-buckets")

    def relabel(self, components: DataFrame) -> None:
        """Take the components in; buckets that lie in one component are done."""
        known = self.rows.drop("component", "shared").join(components, "node", "left")
        known = known.withColumn("component", F.coalesce("component", "node"))
        low, high = F.min("component").alias("low"), F.max("component").alias("high")
        open_ = known.groupBy("shingle").agg(*_bounds(), low, high).where("low < high").drop("low", "high")
        before, self.rows = self.rows, self._pruned(known.join(open_, "shingle"))
        release(before)

    def crossing(self) -> int:
        """Pairs in one bucket and two components."""
        each = self.rows.groupBy("shingle", "component").agg(F.count("*").alias("n"))
        total = each.groupBy("shingle").agg(((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("p"))
        return int(total.agg(F.sum("p")).first()[0] or 0)

    def star(self) -> DataFrame:
        """Each node with the pivot it shares most prefix shingles with.

        The pivot of a bucket is the node with most shared shingles: of a group
        of copies the one with the fewest changes, which is like most others.
        """
        rank = F.struct("shared", F.xxhash64("node"), "node", "n", "component")
        names = ("_shared", "_hash", "pivot", "np", "pivot_component")
        pivots = self.rows.groupBy("shingle").agg(F.max(rank).cast(_struct(names)).alias("p")).select("shingle", "p.*")
        met = self.rows.join(pivots, "shingle").where(
            (F.col("component") != F.col("pivot_component")) & _long_enough("n", "np", self._like)
        )
        counted = met.groupBy("node", "n", "pivot", "np").agg(F.count("*").alias("met"))
        best = counted.groupBy("node", "n").agg(F.max(F.struct("met", "pivot", "np")).alias("m"))
        return best.select(
            F.col("node").alias("a"), F.col("m.pivot").alias("b"), F.col("n").alias("na"), F.col("m.np").alias("nb")
        )

    def meetings(self) -> DataFrame:
        """``(a, b, na, nb)`` of every early bucket in which two sets of different components meet.

        What two sets share lies at or behind the first shingle they share, in
        the order of each. So a linked pair meets in a bucket whose shingle stands
        early in both, with a whole overlap from there on. Sets that differ by
        more than the limit allows have changed shingles there, which are rare, and
        do not meet, however many frequent ones they share.
        """
        like = self._like
        latest = F.col("n") - F.ceil(F.col("n") * like.percent / 100 - 1e-6)

        def side(name: str) -> DataFrame:
            renamed = {"node": name, "pos": f"p{name}", "n": f"n{name}", "component": f"c{name}", "shared": f"s{name}"}
            return self.rows.where(F.col("pos") <= latest).withColumnsRenamed(renamed)

        needed = _needed(F.col("na"), F.col("nb"), like)
        crossing = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & _long_enough("na", "nb", like)
        early = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= _overlap(F.col("na"), F.col("nb"), like)
        met = side("a").join(side("b"), "shingle").where(crossing & early & (F.least("sa", "sb") >= needed))
        return met.select("a", "b", "na", "nb")

    def pairs(self) -> DataFrame:
        """All candidate pairs across components: those that meet, and share enough prefix shingles in all."""
        open_ = self.rows.groupBy("node").agg(F.collect_list("shingle").alias("open"))
        met = (
            self.meetings()
            .distinct()
            .join(open_.withColumnsRenamed({"node": "a", "open": "open_a"}), "a")
            .join(open_.withColumnsRenamed({"node": "b", "open": "open_b"}), "b")
        )
        shared = F.size(F.array_intersect("open_a", "open_b"))
        return met.where(shared >= _needed(F.col("na"), F.col("nb"), self._like)).select("a", "b", "na", "nb")


def _struct(names) -> str:
    return "struct<" + ",".join(f"{n}:bigint" for n in names) + ">"


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    like: Similarity = Similarity(),
    pairs_per_row: int = 0,
    max_stars: int = 1,
) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` of every row of ``docs``.

    Two documents link when their sets' intersection is at least ``percent`` of
    their union; ``component_id`` is the least id reachable by links. Stars are
    drawn while the pairs left to compare are more than ``pairs_per_row`` per
    bucket row and stars find links, ``max_stars`` times at most; then all pairs
    left are compared. That bounds the number of rounds only: no pair is left out.
    With the defaults one star is drawn whatever the size of the input.

    One row per row of ``docs``; repeated rows have one set and one component.
    Of several texts under one id each row keeps its own set. A null, empty or
    blank text has no shingles and is its own component; a null id is null as a
    component and links nothing; other columns are left out; an empty table
    gives no rows. Runs jobs: prefixes, buckets and the sets of candidates are
    staged, whole texts never are, and released as soon as what follows from
    them is staged; the result reads small tables without shingles.
    """
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(shingle_order(docs, text_col, like))
    prefixes = stage(_prefixes(docs, id_col, text_col, order, like), "shingle-prefixes")
    sets = stage(prefixes.select("id", "n", "node"), "shingle-sets")
    known = prefixes.where("n > 0 and id is not null")
    # Equal sets have equal prefixes, so the first is any of them.
    one = known.groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    nodes = stage(one, "shingle-nodes")
    release(prefixes)
    owners = stage(nodes.select("node", "id"), "shingle-owners")
    buckets = _Buckets(nodes.select(F.posexplode("prefix").alias("pos", "shingle"), "node", "n"), like)
    release(nodes)
    links, components = None, None
    stars = 0
    while True:
        left = buckets.crossing()
        if not left:
            break
        last = stars >= max_stars or left <= pairs_per_row * buckets.rows.count()
        pairs = stage(buckets.pairs() if last else buckets.star(), "shingle-pairs")
        wanted = owners.join(
            pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "node"
        )
        fragments = _fragments(docs, id_col, text_col, wanted, order, like)
        found = stage(verified_links(pairs, fragments, like), "shingle-links")
        release(pairs, fragments)
        links = found if links is None else links.unionByName(found)
        components = connected_components(links)
        if last:
            break
        stars = max_stars if found.isEmpty() else stars + 1
        buckets.relabel(components)
    release(buckets.rows)
    return _named(sets, owners, components, id_col)


def _named(sets: DataFrame, nodes: DataFrame, components: DataFrame | None, id_col: str) -> DataFrame:
    """Components named by their least document id."""
    own = nodes.select("node", F.col("id").alias("least"))
    if components is not None:
        member = nodes.join(components, "node")
        named = member.groupBy("component").agg(F.min("id").alias("named"))
        linked = member.join(named, "component").select("node", "named")
        own = own.join(linked, "node", "left").select("node", F.coalesce("named", "least").alias("least"))
    rows = sets.select("id", "n", F.when(F.col("n") > 0, F.col("node")).alias("node"))
    joined = rows.join(own, "node", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("least", "id"))
    return joined.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
