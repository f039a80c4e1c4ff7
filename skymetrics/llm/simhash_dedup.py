"""Near-duplicate documents by SimHash fingerprints, searched in BK-trees.

A fingerprint has the majority bits of the hashes of a text's word shingles. Two fingerprints that
differ in at most ``RADIUS`` of their 64 bits are linked; components of links are groups.

Cut into six blocks, two such fingerprints agree in at least two blocks. So each distinct
fingerprint goes to the 15 shards that a pair of its blocks names. Each shard has a BK-tree: a
node's children are keyed by their distance from it, and a query follows only edges within the
radius of its own distance. Rows come sorted by shard, and trees of about ``TOGETHER`` fingerprints' shards
are built and searched at a time, level by level, as arrays. A shard with more than ``SHARD_LIMIT`` members is cut again by pairs of six blocks of
its remaining bits, which loses nothing for the same reason. Copies share one fingerprint, so they
are one node. The trees travel to the queries of their shard by the shuffle, not by a broadcast,
as nothing bounds the number of fingerprints.

Null and empty texts have fingerprint zero and are linked like any other; very long ones are hashed whole.
A group's id is its smallest document id; nulls count only if there is no other. Repeated rows stay as
they are, and ties between rows of one id go by the smaller fingerprint. An empty table gives no rows. Only
``doc_id`` and ``text`` are read, so further columns may have any name.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

from skymetrics.llm.common import documents, free_name, small_batches, stored
from skymetrics.llm.components import components

SHINGLE = 4
RADIUS = 4
SEED = 42
BLOCKS = 6
SHARD_LIMIT = 20_000

# Rows of shards that are searched together, unless one has more.
TOGETHER = 1 << 18

# Pairs of a query and a node that are looked at together.
_FRONTIER = 1 << 20


def fingerprint_of(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text."""
    joined = b" ".join(text.lower().split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    if len(gaps) < shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    start = [0, *(gaps[: len(gaps) - shingle + 2] + 1).tolist()]
    stop = [*gaps[shingle - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for i in range(0, len(stop), 1 << 15):
        spans = zip(start[i : i + (1 << 15)], stop[i : i + (1 << 15)])
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(0, dtype=np.int64)
    major = np.packbits(2 * counts > len(stop), bitorder="little")
    return int(major.view(np.uint64)[0])


@arrow_udf(LongType())
def fingerprint(texts: pa.Array) -> pa.Array:
    """Fingerprint of each text, its 64 bits as a signed number."""
    found = [fingerprint_of((t.as_py() or "").encode()) for t in texts]
    return pa.array(np.array(found, np.uint64).view(np.int64))


def _pairs_of_blocks(mask: int, blocks: int = BLOCKS) -> list[int]:
    """Masks of all pairs of blocks of the set bits of ``mask``."""
    bits = [i for i in range(64) if mask >> i & 1]
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(bits, blocks)]
    return [a | b for a, b in combinations(parts, 2)]


_ALL = (1 << 64) - 1
MASKS = _pairs_of_blocks(_ALL)
FINER_MASKS = [m | f for m in MASKS for f in _pairs_of_blocks(_ALL & ~m)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(rows: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, key, fp) of rows (fp, mask): the shard of a fingerprint under the mask of a number."""
    table = F.array(*[F.lit(_signed(m)).cast("bigint") for m in masks])
    return rows.select("mask", F.col("fp").bitwiseAND(F.get(table, F.col("mask"))).alias("key"), "fp")


def _shards(fingerprints: DataFrame) -> DataFrame:
    numbers = F.sequence(F.lit(0), F.lit(len(MASKS) - 1))
    return _keyed(fingerprints.select("fp", F.explode(numbers).alias("mask")), MASKS)


def _finer(crowded: DataFrame) -> DataFrame:
    """Shards of the members of crowded shards: the same bits and a pair of blocks of the others."""
    per = len(FINER_MASKS) // len(MASKS)
    numbers = F.sequence(F.col("mask") * per, F.col("mask") * per + (per - 1))
    return _keyed(crowded.select("fp", F.explode(numbers).alias("mask")), FINER_MASKS)


class Forest:
    """BK-trees of many groups of values, as arrays; a value's node is its index."""

    def __init__(self, values: np.ndarray, group: np.ndarray):
        n = len(values)
        self.values, self.root = values, np.empty(n, np.int64)
        parent, edge = np.full(n, -1), np.zeros(n, np.int64)
        left, cell = np.arange(n), np.unique(group, return_inverse=True)[1]
        while len(left):
            # The first of each cell is a node, the others fall into the cells of its edges.
            _, first, which = np.unique(cell, return_index=True, return_inverse=True)
            node = left[first][which]
            if (parent < 0).all() and len(left) == n:
                self.root[left] = node
            rest = left != node
            left, node = left[rest], node[rest]
            distance = np.bitwise_count(values[left] ^ values[node]).astype(np.int64)
            parent[left], edge[left] = node, distance
            cell = node * 65 + distance
        # Children in the order of parent and edge, so that edges in a range are a slice.
        keys = parent * 65 + edge
        self.children = np.argsort(keys, kind="stable")[np.count_nonzero(parent < 0) :]
        self.keys = keys[self.children]

    def near(self, query: np.ndarray, radius: int):
        """Yields arrays (i, j): values that are within ``radius`` of the queried ones, i != j."""
        work = [(part, self.root[part]) for part in np.array_split(query, max(1, len(query) // 4096))]
        while work:
            i, node = work.pop()
            if len(i) > _FRONTIER:
                half = len(i) // 2
                work += [(i[:half], node[:half]), (i[half:], node[half:])]
                continue
            distance = np.bitwise_count(self.values[i] ^ self.values[node]).astype(np.int64)
            hit = (distance <= radius) & (i != node)
            if hit.any():
                yield i[hit], node[hit]
            low = np.searchsorted(self.keys, node * 65 + np.maximum(distance - radius, 0), "left")
            high = np.searchsorted(self.keys, node * 65 + np.minimum(distance + radius, 64), "right")
            count = high - low
            if count.any():
                at = np.repeat(low - (np.cumsum(count) - count), count) + np.arange(count.sum())
                work.append((np.repeat(i, count), self.children[at]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Makes ``label`` the smallest index that each index reaches, with new links a-b."""
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        for side in (a, b):
            np.minimum.at(label, label[side], low)
            np.minimum.at(label, side, low)
        label[:] = label[label]
        if (label == before).all():
            return


def _columns(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints, and the mask and key of each."""
    shard = np.stack([rows["mask"].to_numpy().astype(np.int64), rows["key"].to_numpy()], 1)
    return rows["fp"].to_numpy().view(np.uint64), shard


def _links(radius: int):
    def links(batches):
        """Links of each task's shards, which come one after the other."""
        held, size, enough = [], 0, TOGETHER
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size > enough:
                rows = pa.Table.from_batches(held)
                fp, shard = _columns(rows)
                # The last shard may go on in the next batch.
                whole = len(fp) - np.argmax((shard != shard[-1]).any(1)[::-1]) if (shard != shard[0]).any() else 0
                if whole:
                    yield from of_shards(fp[:whole], shard[:whole])
                    held, size = rows.slice(whole).to_batches(), len(fp) - whole
                enough = max(TOGETHER, 2 * size)
        if size:
            yield from of_shards(*_columns(pa.Table.from_batches(held)))

    def of_shards(fp, shard):
        """Links of whole shards, as a star around the smallest of what hangs together."""
        begins = np.concatenate([[True], (shard[1:] != shard[:-1]).any(1)])
        group = np.cumsum(begins) - 1
        shared = np.bincount(group)[group] > 1
        fp, group = fp[shared], group[shared]
        if not len(fp):
            return
        values, node = np.unique(fp, return_inverse=True)
        label, forest = np.arange(len(values)), Forest(fp, group)
        for i, j in forest.near(np.arange(len(fp)), radius):
            upper = i > j
            _merge(label, node[i[upper]], node[j[upper]])
        tied = np.flatnonzero(label != np.arange(len(values)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(values[tied].view(np.int64)), pa.array(values[label[tied]].view(np.int64))],
            ["x", "y"],
        )

    return links


def _linked(keyed: DataFrame, radius: int) -> DataFrame:
    sorted_ = keyed.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
    return sorted_.mapInArrow(_links(radius), "x bigint, y bigint")


def groups(fingerprints: DataFrame, radius: int = RADIUS, limit: int = SHARD_LIMIT) -> DataFrame:
    """(fp, root) of distinct fingerprints ``fp``: those with the same root hang together."""
    keyed = _shards(fingerprints)
    hot = stored(keyed.groupBy("mask", "key").count().where(F.col("count") > limit).drop("count"), "hot")
    if hot.isEmpty():
        links = _linked(keyed, radius)
    else:
        crowded = keyed.join(hot, ["mask", "key"], "left_semi")
        rest = keyed.join(hot, ["mask", "key"], "left_anti")
        links = _linked(rest, radius).union(_linked(_finer(crowded), radius))
    edges = links.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))
    return components(edges).select(F.col("a").alias("fp"), F.col("b").alias("root"))


def _grouped(marked: DataFrame, radius: int) -> DataFrame:
    """(fp, root, component_id) of the fingerprints of (doc_id, fp)."""
    distinct = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    roots = groups(distinct.select("fp"), radius)
    rooted = distinct.join(roots, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first_id"
    )
    first = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(first, "root").select("fp", "root", "component_id")


def _marked(docs: DataFrame) -> DataFrame:
    small_batches(docs.sparkSession)
    return stored(docs.select("doc_id", fingerprint(F.col("text")).alias("fp")), "fingerprints")


def deduplicate(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs``."""
    marked = _marked(docs)
    return marked.join(_grouped(marked, radius).drop("root"), "fp")


def keep_first(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each group, one with its smallest id, with all its columns.

    Of several texts with that id the one with the smallest fingerprint stays, of several rows with
    that text too any one.
    """
    marked = _marked(docs)
    named = marked.join(_grouped(marked, radius), "fp")
    smallest = named.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    chosen = smallest.groupBy("root").agg(F.min("fp").alias("fp"), F.first("component_id").alias("doc_id"))
    return rows_of(docs, stored(chosen.drop("root"), "chosen"), "fp", fingerprint)


def rows_of(docs: DataFrame, chosen: DataFrame, name: str, number) -> DataFrame:
    """A row of ``docs`` for each (doc_id, ``name``) of ``chosen``, by the ``number`` of its text."""
    fp = free_name(docs, name)
    texts = docs.withColumn(fp, number(F.col("text")))
    known = F.col("doc_id").isNotNull()
    # Repeated rows are put together before texts are dealt out, which is done once, by id.
    rows = texts.where(known).dropDuplicates(["doc_id", fp])
    kept = rows.join(chosen.where(known).withColumnRenamed(name, fp), ["doc_id", fp], "left_semi")
    nameless = texts.where(~known).dropDuplicates([fp])
    rest = nameless.join(chosen.where(~known).select(F.col(name).alias(fp)), fp, "left_semi")
    return kept.select(*docs.columns).unionByName(rest.select(*docs.columns))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate(documents(spark, sf_dir)).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
