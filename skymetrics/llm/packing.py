"""Best-fit packing of documents into token windows, with conflicts.

A document longer than a window is cut into full windows and a rest, so every word is packed once.
Pieces go, longest first, into the open window with the least room that holds them, unless the
window has enough pieces of the same source or any of the same duplicate cluster; the search then
goes on to the window with the next more room. Windows carry a bitmap of the clusters and, for
each count up to ``per_source``, one of the sources that have that many pieces in it.

Rows are dealt to shards by hash, each packed on its own, so a source or cluster of any size is
spread evenly; a shard holds about ``SHARD`` rows. Equal rows are numbered and dealt by their number too. Null
sources conflict with nothing. Null and empty texts have no words and take a window's room of zero; very
long ones are cut into pieces. Pieces of one size go by the smaller id, nulls last. Repeated rows are packed
each, and as one cluster, so never together. An empty table gives no pieces. Only ``doc_id``, ``text`` and
``source`` are read, so further columns may have any name.
"""

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.llm import simhash_dedup
from skymetrics.llm.common import WORD, documents, small_batches, stored

WINDOW = 2048
PER_SOURCE = 4
SHARD = 4000


class Window:
    """Room left, clusters within, and per count the sources that have that many pieces."""

    __slots__ = ("clusters", "sources", "used")

    def __init__(self, per_source: int):
        self.clusters, self.used, self.sources = 0, 0, [0] * per_source

    def takes(self, source: int, cluster: int) -> bool:
        return not (self.sources[-1] & source or self.clusters & cluster)

    def add(self, size: int, source: int, cluster: int) -> int:
        """Adds a piece and returns where it starts."""
        for i, held in enumerate(self.sources):
            if not held & source:
                self.sources[i] |= source
                break
        self.clusters |= cluster
        self.used += size
        return self.used - size


def best_fit(sizes, sources, clusters, window: int = WINDOW, per_source: int = PER_SOURCE):
    """(window number, start) of each piece, longest piece first.

    ``sources`` and ``clusters`` are one-bit numbers, zero for what conflicts with nothing.
    """
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    windows: list[Window] = []
    open_: list[tuple[int, int]] = []  # (room, number) in the order of room
    found = [(0, 0)] * len(sizes)
    for i in order:
        size, source, cluster = sizes[i], sources[i], clusters[i]
        at = bisect_left(open_, (size, -1))
        while at < len(open_) and not windows[open_[at][1]].takes(source, cluster):
            at += 1
        if at < len(open_):
            room, number = open_.pop(at)
        else:
            room, number = window, len(windows)
            windows.append(Window(per_source))
        found[i] = (number, windows[number].add(size, source, cluster))
        if room > size:
            insort(open_, (room - size, number))
    return found


def _bits(values: list, only_shared: bool) -> list[int]:
    """One bit for each value; none for nulls and, if asked, for values that occur once."""
    counts = Counter(values)
    place: dict = {}
    return [
        0 if v is None or (only_shared and counts[v] == 1) else 1 << place.setdefault(v, len(place))
        for v in values
    ]


def _packed(window: int, per_source: int):
    # Arrow and not pandas, which would make floats of ids beside a null.
    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        order = [("size", "descending"), ("doc_id", "ascending"), ("cluster", "ascending"), ("source", "ascending")]
        rows = rows.take(pc.sort_indices(rows, order))
        size = rows["size"].to_numpy()
        parts = np.maximum(1, -(-size // window))
        row = np.repeat(np.arange(len(size)), parts)
        number = np.arange(len(row)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = number * window
        length = np.minimum(size[row] - start, window)
        pieces = rows.take(pa.array(row))
        sources = _bits(pieces["source"].to_pylist(), False)
        clusters = _bits(pieces["cluster"].to_pylist(), True)
        found = best_fit(length.tolist(), sources, clusters, window, per_source)
        return pa.table(
            {
                "doc_id": pieces["doc_id"],
                "piece": number,
                "piece_start": start,
                "n_words": length,
                "window_id": pa.array([f"{key[0].as_py()}-{bin_}" for bin_, _ in found], pa.string()),
                "window_start": pa.array([at for _, at in found], pa.int64()),
            }
        )

    return packed


def pack(sized: DataFrame, window: int = WINDOW, per_source: int = PER_SOURCE, shard: int = SHARD) -> DataFrame:
    """Packs rows (doc_id, source, cluster, size): a row (doc_id, piece, piece_start, n_words,
    window_id, window_start) for each piece."""
    # Equal rows are counted and numbered, so that they are spread and no split of files matters.
    same = ["doc_id", "source", "cluster", "size"]
    counted = sized.groupBy(*same).agg(F.count("*").alias("copies"))
    rows = counted.select(*same, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    shards = max(1, -(-sized.count() // shard))
    dealt = F.pmod(F.xxhash64("doc_id", "cluster", "size", "copy"), F.lit(shards))
    schema = "doc_id bigint, piece bigint, piece_start bigint, n_words bigint, window_id string, window_start bigint"
    return rows.withColumn("shard", dealt).groupBy("shard").applyInArrow(_packed(window, per_source), schema)


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, cluster, size): exact copies of a text, bar white space, are one cluster."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    plain = F.trim(F.regexp_replace("text", r"[\x20\x09-\x0D]+", " "))
    cluster = F.coalesce(F.xxhash64(plain), F.lit(0))
    return stored(docs.select("doc_id", "source", cluster.alias("cluster"), size.alias("size")), "sized")


def classed(docs: DataFrame) -> DataFrame:
    """(doc_id, source, cluster, size): near copies, as op10 groups them, are one cluster."""
    small_batches(docs.sparkSession)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")
    fp = simhash_dedup.fingerprint(F.col("text")).alias("fp")
    marked = stored(docs.select("doc_id", "source", size, fp), "sized")
    roots = simhash_dedup.groups(stored(marked.select("fp").distinct(), "distinct"))
    cluster = F.coalesce("root", "fp").alias("cluster")
    return stored(marked.join(roots, "fp", "left").select("doc_id", "source", cluster, "size"), "classed")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(classed(documents(spark, sf_dir)))
