"""Token sequences of equal size and near-equal training cost, without padding.

A piece of ``n`` tokens costs ``LINEAR * n + n * n``: the work done for each token, and attention, which
looks at every pair of a piece's tokens. Documents are cut into full sequences and a rest. Rests go,
longest first, each whole into the sequence with the lowest cost so far that has room for it. What
finds no room in one sequence is cut, in the same order, over the sequences that have room left,
those with the lowest cost first.

Documents are dealt to shards of about ``SHARD_TOKENS`` tokens, each packed on its own. A shard opens as
many full sequences as its rests fill, and for what remains one of each power of two that adds up to
it. A sequence whose length is a power of two isn't padded, so none is, whatever the shard's size.

Shards follow from ids, texts and, for rows that repeat both, how many came before in their task. So
a hot text or id is spread over shards, and which files hold the rows makes no difference to
others. Null and empty texts are their end id only. A very long text is cut like any other. Ties go
by the smaller id, nulls last, then by the tokens. Repeated rows are packed each. An empty table
gives no pieces. Only ``doc_id`` and ``text`` are read, so further columns may have any name.
"""

from collections import Counter
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.llm.common import documents, small_batches, stored
from skymetrics.llm.token_files import encoder

CAPACITY = 4096
END_ID = 2
# Work for a token against that for a pair of tokens: six times a model's width, here 1024.
LINEAR = 6 * 1024
SHARD_TOKENS = 2 << 20

_TOGETHER = 500
_PIECES = (
    "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, cost long, ids binary"
)


def cost_of(length, linear: int = LINEAR):
    return linear * length + length * length


def rooms_for(total: int, capacity: int = CAPACITY) -> list[int]:
    """Lengths of sequences that ``total`` tokens fill: full ones, then powers of two."""
    rest = total % capacity
    powers = [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
    return [capacity] * (total // capacity) + powers


def assign(sizes: list[int], rooms: list[int], linear: int = LINEAR) -> list[tuple[int, int, int, int, int]]:
    """(piece of, start, sequence, offset, length): documents of descending ``sizes`` in sequences.

    ``rooms`` add up to the sizes. Sequences without room for the document at hand are set aside until
    one comes that fits, so each is looked at about once for each piece it takes.
    """
    room, cost = list(rooms), [0] * len(rooms)
    open_ = [(0, s) for s in range(len(rooms))]
    aside: list[tuple[int, int]] = []
    found, uncut = [], []

    def put(document: int, start: int, sequence: int, length: int) -> None:
        found.append((document, start, sequence, rooms[sequence] - room[sequence], length))
        room[sequence] -= length
        cost[sequence] += cost_of(length, linear)

    for document, size in enumerate(sizes):
        while aside and -aside[0][0] >= size:
            _, sequence = heappop(aside)
            heappush(open_, (cost[sequence], sequence))
        while open_ and room[open_[0][1]] < size:
            _, sequence = heappop(open_)
            heappush(aside, (-room[sequence], sequence))
        if not open_:
            uncut.append(document)
            continue
        _, sequence = heappop(open_)
        put(document, 0, sequence, size)
        if room[sequence]:
            heappush(open_, (cost[sequence], sequence))
    open_ = [(cost[s], s) for s in range(len(rooms)) if room[s]]
    heapify(open_)
    for document in uncut:
        start = 0
        while start < sizes[document]:
            _, sequence = heappop(open_)
            length = min(sizes[document] - start, room[sequence])
            put(document, start, sequence, length)
            start += length
            if room[sequence]:
                heappush(open_, (cost[sequence], sequence))
    return found


def _encoded(path: str, end: int):
    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, stop, seen = encoder(path), np.array([end], "<u4").tobytes(), Counter()
        for whole in batches:
            for first in range(0, whole.num_rows, _TOGETHER):
                batch = whole.slice(first, _TOGETHER)
                texts = [text or "" for text in batch["text"].to_pylist()]
                ids = [packed + stop for packed in known.encode(texts)]
                copies = []
                for doc_id, packed in zip(batch["doc_id"].to_pylist(), ids):
                    key = xxhash.xxh64_intdigest(packed) ^ hash(doc_id)
                    copies.append(seen[key])
                    seen[key] += 1
                # Two bytes an id where all fit, as they mostly do.
                narrow = [_narrowed(packed) for packed in ids]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"],
                        pa.array(copies, pa.int64()),
                        pa.array([len(packed) // 4 for packed in ids], pa.int64()),
                        pa.array(narrow, pa.binary()),
                    ],
                    ["doc_id", "copy", "size", "ids"],
                )

    return encoded


def _narrowed(packed: bytes) -> bytes:
    ids = np.frombuffer(packed, "<u4")
    return ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else packed


def _widened(packed: bytes, size: int) -> bytes:
    return packed if len(packed) == 4 * size else np.frombuffer(packed, "<u2").astype("<u4").tobytes()


def _packed(capacity: int, linear: int):
    def packed(key: tuple, rows: pa.Table) -> pa.Table:
        rest = pc.subtract(rows["size"], pc.multiply(pc.divide(rows["size"], capacity), capacity))
        rows = rows.append_column("rest", rest)
        order = [("rest", "descending"), ("size", "descending"), ("doc_id", "ascending"), ("ids", "ascending")]
        rows = rows.take(pc.sort_indices(rows, order))
        sizes, rests = rows["size"].to_pylist(), rows["rest"].to_pylist()
        wide = [_widened(p, n) for p, n in zip(rows["ids"].to_pylist(), sizes)]
        kept = [n for n in rests if n]
        rooms = rooms_for(sum(kept), capacity)
        # The rest of a document comes after its full sequences.
        pieces = [
            (d, sizes[d] - rests[d] + start, length, s, offset)
            for d, start, s, offset, length in assign(kept, rooms, linear)
        ]
        full = [(d, start) for d, n in enumerate(sizes) for start in range(0, n - rests[d], capacity)]
        pieces += [(d, start, capacity, len(rooms) + i, 0) for i, (d, start) in enumerate(full)]
        row, start, length, sequence, offset = np.array(pieces, np.int64).reshape(-1, 5).T
        return pa.table(
            {
                "doc_id": rows["doc_id"].take(pa.array(row)),
                "start": start,
                "length": length,
                "doc_tokens": np.array(sizes, np.int64)[row],
                "sequence_id": (key[0].as_py() << 32) + sequence,
                "offset": offset,
                "cost": cost_of(length, linear),
                "ids": pa.array([wide[d][4 * s : 4 * (s + n)] for d, s, n, _, _ in pieces], pa.binary()),
            }
        )

    return packed


def pack(
    docs: DataFrame,
    path: str,
    end: int = END_ID,
    capacity: int = CAPACITY,
    linear: int = LINEAR,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """A row for each piece: whose it is, where it starts there, its ``ids`` as little-endian unsigned
    32-bit numbers, the sequence that holds it and at which offset, and what it costs."""
    small_batches(docs.sparkSession)
    schema = "doc_id long, copy long, size long, ids binary"
    encoded = stored(docs.select("doc_id", "text").mapInArrow(_encoded(path, end), schema), "encoded")
    total = encoded.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_tokens))
    dealt = F.pmod(F.xxhash64("doc_id", "ids", "copy"), F.lit(shards)).alias("shard")
    rows = encoded.select(dealt, "doc_id", "size", "ids")
    return rows.groupBy("shard").applyInArrow(_packed(capacity, linear), _PIECES)


def op13_cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
