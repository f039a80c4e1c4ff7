"""Exact ranked search by pipelined term partitioning.

The index is partitioned by term: each term has one owner, by how many documents hold it, and owners
are the stages of a pipeline, rarest terms first. Items travel in bundles of up to ``BUNDLE``. A bundle
goes from owner to owner and carries a sparse accumulator (item, document, score); an owner adds what
its terms contribute, in 64-bit integers, and hands the bundle on. After the last owner the ``k`` best
are selected.

No owner's postings lie in one place: documents are indexed in shards, and a stage is a cogroup of
bundles and postings by shard. So however many documents hold a term, a task meets those of one shard.

Between stages each item's ``k`` best scores so far are found over all shards. A document can gain at
most what the item's terms of later owners give any document, so one that stays below the k-th score
even then is dropped. Contributions are never negative: what is dropped could not have come back, and
results are those of scoring everything.

Terms that no item asks for are left out when a shard is indexed, by a bitmap of ``BITMAP_BITS`` bits of
the asked terms' hashes: 1 MB, however many terms are asked. It may let others pass, which then meet
no question.

Null and empty texts have no terms: they are never found and ask nothing. Very long texts are indexed
whole, in a shard of their own if need be. Ties go by the smaller document id, nulls last. Repeated
rows are found each; an item row that is repeated is answered each time. Empty tables give no rows.
Only ids and texts are read, so further columns may have any name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.llm.common import documents, small_batches, stored
from skymetrics.operators.ranking import top_n

K = 10
# Share of a document's length in its scores, in hundredths, and the scale of shares.
LENGTH_SHARE = 75
SCALE = 1_000_000_000

BUNDLE_BITS = 6
BUNDLE = 1 << BUNDLE_BITS
SHARD_DOCS = 4096
SHARD_BYTES = 8 << 20
BITMAP_BITS = 1 << 23

# A term goes to the next owner with each of these parts of all documents that hold it.
OWNERS = (4096, 256, 16)

# Fixed value: letters and digits of ASCII and all beyond it make up terms.
_TABLE = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()

_INDEX = "shard long, doc_ids array<long>, lengths array<int>, terms array<binary>, docs array<binary>, times array<binary>"
_POSTINGS = "shard long, term binary, docs binary, shares binary, holders long, best long"
_CARRIED = (
    "bundle long, shard long, items binary, docs binary, scores binary, tops array<struct<item int, score long>>"
)
_SELECTED = "bundle long, shard long, item int, doc int, score long"


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").translate(_TABLE).split()


def _asked_bit(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term, 42) % BITMAP_BITS


# -- questions ---------------------------------------------------------------------------------


def _questions(items: DataFrame) -> DataFrame:
    """(bundle, item, term, occurs) of numbered items."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, terms = [], []
            for row, text in zip(batch["row"].to_pylist(), batch["text"]):
                words = terms_of(text.as_py())
                terms += words
                rows += [row] * len(words)
            bits = [_asked_bit(t) for t in terms]
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), pa.array(terms, pa.binary()), pa.array(bits, pa.int64())],
                ["row", "term", "bit"],
            )

    words = items.select("row", "text").mapInArrow(asked, "row long, term binary, bit long")
    return words.groupBy(
        F.shiftright("row", BUNDLE_BITS).alias("bundle"),
        F.col("row").bitwiseAND(F.lit(BUNDLE - 1)).cast("int").alias("item"),
        "term",
        "bit",
    ).agg(F.count("*").alias("occurs"))


def _bitmap(questions: DataFrame) -> bytes:
    """One bit for each hash of an asked term: at most ``BITMAP_BITS`` / 64 rows for the driver."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))
    words = questions.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))
    bitmap = np.zeros(BITMAP_BITS // 64, "<i8")
    for word, bits in words.collect():
        bitmap[word] = bits
    return bitmap.tobytes()


# -- index -------------------------------------------------------------------------------------


class _Numbers(dict):
    """Numbers of the terms that the bitmap lets pass; -1 for others."""

    def __init__(self, bitmap: bytes):
        super().__init__()
        self.bitmap, self.terms = bitmap, []

    def __missing__(self, term: bytes) -> int:
        bit = _asked_bit(term)
        passes = self.bitmap[bit >> 3] >> (bit & 7) & 1
        number = self[term] = len(self.terms) if passes else -1
        if passes:
            self.terms.append(term)
        return number


def _indexed(bitmap: bytes):
    def shard_of(number: int, held: list[tuple]) -> pa.RecordBatch:
        # By ascending id, so that a shard's order of documents is that of ties.
        held.sort(key=lambda d: (d[0] is None, d[0] or 0))
        known = _Numbers(bitmap)
        parts = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for _, words in held]
        lengths = np.array([len(p) for p in parts])
        term, doc = np.concatenate(parts), np.repeat(np.arange(len(parts)), lengths)
        pairs, times = np.unique((term * len(parts) + doc)[term >= 0], return_counts=True)
        cuts = np.searchsorted(pairs, np.arange(len(known.terms) + 1) * len(parts)).tolist()
        docs, times = (pairs % len(parts)).astype("<u4"), times.astype("<u4")
        spans = list(zip(cuts, cuts[1:]))
        values = [
            number,
            [doc_id for doc_id, _ in held],
            lengths.tolist(),
            known.terms,
            [docs[a:b].tobytes() for a, b in spans],
            [times[a:b].tobytes() for a, b in spans],
        ]
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), *[pa.list_(pa.binary())] * 3]
        names = ["shard", "doc_ids", "lengths", "terms", "docs", "times"]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, size = [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                words = terms_of(text.as_py())
                if not words:
                    continue
                held.append((doc_id.as_py(), words))
                size += len(text.as_py())
                if size > SHARD_BYTES or len(held) == SHARD_DOCS:
                    yield shard_of(number, held)
                    held, size, number = [], 0, number + 1
        if held:
            yield shard_of(number, held)

    return indexed


def shares_of(times: np.ndarray, lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What occurrences of a term are worth in documents of these lengths, before its weight."""
    weighed = 100 - LENGTH_SHARE + LENGTH_SHARE * lengths * n_docs // n_terms
    return SCALE * times // (1000 * times + 8 * weighed)


def _postings(n_docs: int, n_terms: int):
    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                shares, holders, best = [], [], []
                for docs, times in zip(row["docs"], row["times"]):
                    at = np.frombuffer(docs, "<u4")
                    worth = shares_of(np.frombuffer(times, "<u4").astype(np.int64), lengths[at], n_docs, n_terms)
                    shares.append(worth.astype("<u4").tobytes())
                    holders.append(len(at))
                    best.append(int(worth.max()))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * len(holders), pa.int64()),
                        pa.array(row["terms"], pa.binary()),
                        pa.array(row["docs"], pa.binary()),
                        pa.array(shares, pa.binary()),
                        pa.array(holders, pa.int64()),
                        pa.array(best, pa.int64()),
                    ],
                    [c.split()[0] for c in _POSTINGS.split(", ")],
                )

    return postings


# -- the owners' stages ------------------------------------------------------------------------


def _added(carried: pa.Table, owned: pa.Table) -> np.ndarray:
    """Scores (item, document) of a bundle in a shard after an owner's terms; zero for no accumulator."""
    width, posted = 0, []
    for row in owned.to_pylist():
        docs = np.frombuffer(row["docs"], "<u4")
        width = max(width, int(docs[-1]) + 1)
        posted.append((docs, np.frombuffer(row["shares"], "<u4").astype(np.int64) * row["weight"], row["askers"]))
    old = []
    for row in carried.to_pylist():
        docs = np.frombuffer(row["docs"], "<u4")
        if len(docs):
            width = max(width, int(docs.max()) + 1)
            old.append((np.frombuffer(row["items"], "u1"), docs, np.frombuffer(row["scores"], "<i8")))
    scores = np.zeros((BUNDLE, width), np.int64)
    needs = np.zeros(BUNDLE, np.int64)
    for items, docs, score in old:
        scores[items, docs] = score
    for docs, worth, askers in posted:
        for asker in askers:
            scores[asker["item"], docs] += worth * asker["occurs"]
            needs[asker["item"]] = asker["need"]
    for row in carried.to_pylist():
        for need in row["needs"] or ():
            needs[need["item"]] = need["need"]
    scores[scores < needs[:, None]] = 0
    return scores


def _key(carried: pa.Table, owned: pa.Table) -> tuple[int, int]:
    of = carried if carried.num_rows else owned
    return of["bundle"][0].as_py(), of["shard"][0].as_py()


def _best(scores: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(item, document, score) of the ``k`` best documents of each item, ties by the first."""
    for item in np.flatnonzero(scores.any(1)).tolist():
        docs = np.flatnonzero(scores[item])
        order = np.lexsort((docs, -scores[item, docs]))[:k]
        yield from ((item, int(docs[i]), int(scores[item, docs[i]])) for i in order)


def _stage(k: int):
    def stage(carried: pa.Table, owned: pa.Table) -> pa.Table:
        bundle, shard = _key(carried, owned)
        scores = _added(carried, owned)
        items, docs = np.nonzero(scores)
        row = {
            "bundle": bundle,
            "shard": shard,
            "items": items.astype("u1").tobytes(),
            "docs": docs.astype("<u4").tobytes(),
            "scores": scores[items, docs].astype("<i8").tobytes(),
            "tops": [{"item": i, "score": s} for i, _, s in _best(scores, k)],
        }
        top = pa.list_(pa.struct([("item", pa.int32()), ("score", pa.int64())]))
        types = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), top]
        return pa.table({name: pa.array([value], t) for (name, value), t in zip(row.items(), types)})

    return stage


def _selection(k: int):
    def selected(carried: pa.Table, owned: pa.Table) -> pa.Table:
        bundle, shard = _key(carried, owned)
        best = list(_best(_added(carried, owned), k))
        item, doc, score = zip(*best) if best else ((), (), ())
        return pa.table(
            {
                "bundle": pa.array([bundle] * len(best), pa.int64()),
                "shard": pa.array([shard] * len(best), pa.int64()),
                "item": pa.array(item, pa.int32()),
                "doc": pa.array(doc, pa.int32()),
                "score": pa.array(score, pa.int64()),
            }
        )

    return selected


def _owner(holders: Column, n_docs: int) -> Column:
    """Owner of a term that so many documents hold, from 0 for the rarest."""
    steps = [F.when(holders * part >= n_docs, 1).otherwise(0) for part in OWNERS]
    return sum(steps[1:], steps[0])


def search_documents(docs: DataFrame, items: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents for each row (item_id, text) of ``items``."""
    spark = docs.sparkSession
    small_batches(spark)
    # Rows of a partition are numbered in turn, so bundles are full but for the last of each.
    numbered = items.select(F.monotonically_increasing_id().alias("row"), "item_id", "text")
    numbered = stored(numbered, "items")
    questions = stored(_questions(numbered), "questions")
    bitmap = spark.sparkContext.broadcast(_bitmap(questions))
    index = stored(docs.select("doc_id", "text").mapInArrow(_indexed_by(bitmap), _INDEX), "index")
    n_terms = F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))
    n_docs, n_terms = index.agg(F.coalesce(F.sum(F.size("lengths")), F.lit(0)), F.coalesce(n_terms, F.lit(0))).first()
    postings = index.drop("doc_ids").mapInArrow(_postings(n_docs, max(1, n_terms)), _POSTINGS)
    postings = stored(postings, "postings")

    holders = postings.groupBy("term").agg(F.sum("holders").alias("holders"), F.max("best").alias("best"))
    weight = F.floor(1000 * F.ln((2.0 * n_docs + 2) / (2.0 * F.col("holders") + 1))).cast("long")
    weighed = holders.select("term", weight.alias("weight"), "best", _owner(F.col("holders"), n_docs).alias("owner"))
    asked = stored(questions.drop("bit").join(weighed.where("weight > 0"), "term"), "asked")
    # The most that each item's terms of an owner can add to a document.
    gains = asked.groupBy("bundle", "item", "owner").agg(
        F.sum(F.col("occurs") * F.col("weight") * F.col("best")).alias("most")
    )
    found = None
    for owner in range(len(OWNERS) + 1):
        last = owner == len(OWNERS)
        needs = None if found is None else _needs(found, gains.where(F.col("owner") > owner), k)
        owned = _owned(postings, asked.where(F.col("owner") == owner), needs)
        carried = _carried(spark, found, needs)
        groups = carried.groupBy("bundle", "shard").cogroup(owned.groupBy("bundle", "shard"))
        step = groups.applyInArrow(_selection(k), _SELECTED) if last else groups.applyInArrow(_stage(k), _CARRIED)
        found = stored(step, "selected" if last else "carried")
    ids = index.select("shard", "doc_ids")
    row = F.shiftleft("bundle", BUNDLE_BITS) + F.col("item")
    named = found.join(ids, "shard").select(row.alias("row"), F.get("doc_ids", F.col("doc")).alias("doc_id"), "score")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    best = top_n(named, order, n=k, per=["row"], rank="rank")
    return best.join(numbered.select("row", "item_id"), "row").select("item_id", "rank", "doc_id", "score")


def _indexed_by(bitmap):
    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _indexed(bitmap.value)(batches)

    return indexed


def _needs(found: DataFrame, later: DataFrame, k: int) -> DataFrame:
    """(bundle, item, need): the least that a document must have after a stage to be among the best yet.

    That is the k-th score so far less what ``later`` owners can add.
    """
    tops = found.select("bundle", F.explode("tops").alias("top")).select("bundle", "top.item", "top.score")
    ranked = top_n(tops, [F.col("score").desc()], n=k, per=["bundle", "item"], rank="place")
    floors = ranked.where(F.col("place") == k).drop("place")
    rest = later.groupBy("bundle", "item").agg(F.sum("most").alias("most"))
    need = F.greatest(F.lit(0), F.col("score") - F.coalesce("most", F.lit(0)))
    return stored(floors.join(rest, ["bundle", "item"], "left").select("bundle", "item", need.alias("need")), "needs")


def _owned(postings: DataFrame, asked: DataFrame, needs: DataFrame | None) -> DataFrame:
    """An owner's postings, each with the items of a bundle that ask for its term."""
    if needs is None:
        asked = asked.withColumn("need", F.lit(0).cast("long"))
    else:
        asked = asked.join(needs, ["bundle", "item"], "left").fillna(0, ["need"])
    askers = F.collect_list(F.struct("item", "occurs", "need")).alias("askers")  # a bundle's items at most
    of_bundle = asked.groupBy("bundle", "term", "weight").agg(askers)
    return postings.join(of_bundle, "term").select("bundle", "shard", "docs", "shares", "weight", "askers")


def _carried(spark: SparkSession, found: DataFrame | None, needs: DataFrame | None) -> DataFrame:
    """Bundles on their way, with what their items need."""
    if found is None:
        none = spark.createDataFrame([], _CARRIED)
        return none.drop("tops").withColumn("needs", F.lit(None).cast("array<struct<item int, need long>>"))
    of_bundle = needs.groupBy("bundle").agg(F.collect_list(F.struct("item", "need")).alias("needs"))
    return found.drop("tops").join(of_bundle, "bundle", "left")


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return search_documents(documents(spark, sf_dir), items)
