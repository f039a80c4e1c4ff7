"""Restaurants of the words that follow a word, for the Pitman-Yor model.

Each word of the training text is a customer in the restaurant of the word before it (the start of a
text is one too); a table there is a customer of the words' restaurant, the parent of all. After
word ``u`` the model gives ``w``

    own(u, w) + rest(u) * parent(w),   own = (c - d t) / (s + C),   rest = (s + d T) / (s + C)

with c customers at t tables for w, and C and T in all of the restaurant.

Documents lie in blocks with their words in order, a file each in the shared folder, which the task that works
on a block opens: a block itself is never shuffled. What is shuffled are packed numbers (``packed``).

A block sends each of its distinct words once to the word's bucket, where words of all blocks are counted and
numbered, frequent ones first, so that most numbers are small; each block gets the numbers back in the order in
which it sent the words, and later their values. A block sends each of its distinct pairs once, as
numbers, to the bucket of the pair's first word, where pairs of all blocks are added up and seated;
each block gets its pairs' values back in the order in which it sent them. A word that so many follow
that it would fill a bucket is hot: its pairs are spread over all buckets by both words, and its sums are
put together from theirs. There are at most ``HOT`` hot words for each bucket.

Seating follows the same rule as that of the words (``seating.seat``), given the words' shares of the text
as what the parent draws; a pair that occurs once has one table, so only others are drawn.
"""

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymetrics.llm.blocks import BLOCK_BYTES, files, opened, words_of
from skymetrics.llm.common import small_batches, stored
from skymetrics.llm.seating import seat
from skymetrics.plans.session import scratch_folder

DISCOUNT = 0.8
STRENGTH = 1.0
SAMPLES = 2
BUCKET_PAIRS = 1 << 20
HOT = 4

# Words that blocks send to a bucket; buckets of pairs for each part of the parent's customers.
BUCKET_WORDS = 1 << 20
_PART_BUCKETS = 8

START = 0  # the number of what comes before the first word

_BLOCKS = (
    "block long, words array<binary>, uses array<int>, doc_ids array<long>, flags array<boolean>, "
    "sizes array<int>, places binary"
)
_DEALT = "bucket int, of long, words binary, numbers binary"
_NUMBERED = "of long, bucket int, numbers binary, word binary, c long, id long"
_VALUED = "of long, numbers binary, values binary"
_SENT = "bucket int, of long, pairs binary"
_SEATED = "of long, bucket int, own binary, rest binary, part int, tables binary, hot long, hot_tables double"


# -- packed numbers ----------------------------------------------------------------------------


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + (pa.compress(data, "zstd", asbytes=True) if data else b"")


def loosened(data: bytes) -> bytes:
    size = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], size, "zstd", asbytes=True) if size else b""


def packed(*columns: np.ndarray) -> bytes:
    """Numbers of columns of one length, compressed: all first bytes, then all second ones, and so on."""
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return squeezed(b"".join(planes))


def unpacked(data: bytes, *types: str) -> list[np.ndarray]:
    raw = np.frombuffer(loosened(data), np.uint8)
    widths = [np.dtype(t).itemsize for t in types]
    n = len(raw) // sum(widths)
    parts = np.split(raw, np.cumsum([w * n for w in widths])[:-1])
    return [np.ascontiguousarray(p.reshape(w, n).T).reshape(-1).view(t) for p, w, t in zip(parts, widths, types)]


def _table(schema: str, columns: list) -> pa.Table:
    types = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    return pa.table([pa.array(c, types[k]) for c, k in zip(columns, kinds)], list(names))


# -- blocks ------------------------------------------------------------------------------------


class _Places(dict):
    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


def _block(number: int, places: _Places, ids: list, flags: list[bool], parts: list) -> pa.RecordBatch:
    flat, sizes = np.concatenate(parts), [len(p) for p in parts]
    uses = np.bincount(flat[np.repeat(np.array(flags, bool), sizes)], minlength=len(places))
    values = [number, list(places), uses.tolist(), ids, flags, sizes, packed(flat)]
    types = [pa.int64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.bool_()),
             pa.list_(pa.int32()), pa.binary()]
    names = [c.split()[0] for c in _BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)


def _blocks(end: bytes):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size = TaskContext.get().partitionId() << 32, 0
        places, ids, flags, parts = _Places(), [], [], []
        for batch in batches:
            for doc_id, flag, text in zip(batch["doc_id"], batch["flag"], batch["text"]):
                words = [*words_of(text.as_py()), end]
                parts.append(np.fromiter(map(places.__getitem__, words), "<u4", len(words)))
                ids.append(doc_id.as_py())
                flags.append(flag.as_py())
                size += len(text.as_py() or "")
                if size > BLOCK_BYTES:
                    yield _block(number, places, ids, flags, parts)
                    places, ids, flags, parts, number, size = _Places(), [], [], [], number + 1, 0
        if ids:
            yield _block(number, places, ids, flags, parts)

    return blocks


def build(docs: DataFrame, flag: Column, end: bytes) -> DataFrame:
    """Blocks of ``docs``, a stored file each: words in order, as places in the block's list of words. ``flag``
    marks documents whose words ``uses`` counts; ``end`` is a word added to each document."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select("doc_id", flag.alias("flag"), "text").mapInArrow(_blocks(end), _BLOCKS)
    folder = scratch_folder(spark, "blocks")
    rows.write.partitionBy("block").option("compression", "zstd").parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def of_block(file: str) -> dict:
    """A block without its words, from its file."""
    return opened(file, ["doc_ids", "flags", "sizes", "places"]).to_pylist()[0]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Numbers of 64 bits, spread by a hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Pairs:
    """Distinct pairs of a block's neighbouring words, ascending by both words' numbers."""

    def __init__(self, row: dict, ids: np.ndarray):
        """``ids`` are the numbers of the block's words."""
        self.places = unpacked(row["places"], "<u4")[0].astype(np.int64)
        sizes = np.array(row["sizes"], np.int64)
        numbers = ids.astype(np.uint64)[self.places]
        before = np.append(np.uint64(START), numbers[:-1])
        before[np.cumsum(sizes) - sizes] = START
        # The pairs, where each is first met, and the pair of each token.
        self.keys, met, self.at = np.unique(
            before << np.uint64(32) | numbers, return_index=True, return_inverse=True
        )
        self.second = self.places[met]
        learnt = np.repeat(np.array(row["flags"], bool), sizes)
        self.uses = np.bincount(self.at[learnt], minlength=len(self.keys))
        self.doc = np.repeat(np.arange(len(sizes)), sizes)

    def by_bucket(self, buckets: int, hot: np.ndarray) -> dict[int, np.ndarray]:
        """The pairs of each bucket, ascending."""
        first = self.keys >> np.uint64(32)
        bucket = _mixed(np.where(np.isin(first, hot), self.keys, first)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        parts = np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1)
        return {int(bucket[part[0]]): part for part in parts if len(part)}


# -- numbers of words --------------------------------------------------------------------------


def _by_number(of: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each number and the places that have it, ascending."""
    order = np.argsort(of, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        if len(part):
            yield int(of[part[0]]), part


def _dealing(buckets: int):
    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, words, uses in zip(batch["block"], batch["words"], batch["uses"]):
                listed, often = words.as_py(), uses.values.to_numpy().astype("<u4")
                bucket = _mixed(np.fromiter(map(crc32, listed), np.uint64, len(listed))) % np.uint64(buckets)
                found = []
                for i, part in _by_number(bucket):
                    text = squeezed(b" ".join([listed[at] for at in part.tolist()]))
                    found.append((i, block.as_py(), text, packed(np.diff(part, prepend=0).astype("<u4"), often[part])))
                yield from _table(_DEALT, list(zip(*found))).to_batches()

    return dealt


def _numbering(buckets: int):
    def numbered(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("of")
        lists = [loosened(data).split(b" ") for data in rows["words"].to_pylist()]
        steps, uses = zip(*(unpacked(data, "<u4", "<u4") for data in rows["numbers"].to_pylist()))
        words = pa.array([word for list_ in lists for word in list_], pa.binary()).dictionary_encode()
        back, n = words.indices.to_numpy(), len(words.dictionary)
        counts = np.bincount(back, np.concatenate(uses), n).astype(np.int64)
        rank = np.empty(n, np.int64)
        rank[np.argsort(-counts, kind="stable")] = np.arange(n)
        ids = 1 + rank * buckets + key[0].as_py()
        if ids.max() >= 1 << 32:
            raise ValueError("more words than 2**32 numbers hold, which pairs of 64 bits cannot tell apart")
        parts = np.split(back, np.cumsum([len(list_) for list_ in lists])[:-1])
        numbers = [packed(step, ids[at].astype("<u4"), counts[at].astype("<u8")) for step, at in zip(steps, parts)]
        # The lists of the blocks, then the words themselves.
        here, none = [key[0].as_py()] * (len(lists) + n), [None] * len(lists)
        return pa.table(
            {
                "of": pa.array(rows["of"].to_pylist() + [None] * n, pa.int64()),
                "bucket": pa.array(here, pa.int32()),
                "numbers": pa.array(numbers + [None] * n, pa.binary()),
                "word": pa.concat_arrays([pa.array(none, pa.binary()), words.dictionary]),
                "c": pa.concat_arrays([pa.array(none, pa.int64()), pa.array(counts)]),
                "id": pa.concat_arrays([pa.array(none, pa.int64()), pa.array(ids)]),
            }
        )

    return numbered


def number_words(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(of, bucket, numbers) of the blocks' words, and the vocabulary (word, c, id, bucket): all distinct words
    with their uses and a number from 1, not without gaps; the more frequent of a bucket's words come first."""
    sent = blocks.agg(F.coalesce(F.sum(F.size("uses")), F.lit(0))).first()[0]
    buckets = max(1, -(-sent // BUCKET_WORDS))
    dealt = blocks.select("block", "words", "uses").mapInArrow(_dealing(buckets), _DEALT)
    both = stored(dealt.groupBy("bucket").applyInArrow(_numbering(buckets), _NUMBERED), "words")
    known = both.where(F.col("of").isNotNull()).select("of", "bucket", "numbers")
    return known, both.where(F.col("of").isNull()).select("word", "c", "id", "bucket")


def listed(words: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(id, c) of a block's words by their places, of rows (at, id, c) or of the lists of ``number_words``."""
    if "numbers" in words.column_names:
        parts = [unpacked(data, "<u4", "<u4", "<u8") for data in words["numbers"].to_pylist()]
        at = np.concatenate([np.cumsum(steps, dtype=np.int64) for steps, _, _ in parts])
        given = [np.concatenate([part[i] for part in parts]) for i in (1, 2)]
    else:
        at, given = words["at"].to_numpy(), [words[c].to_numpy() for c in ("id", "c")]
    ids, counts = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    ids[at], counts[at] = given
    return ids, counts


def _valuing(lists: pa.Table, words: pa.Table) -> pa.Table:
    id_, value = words["id"].to_numpy(), words["value"].to_numpy()
    order = np.argsort(id_)
    id_, value = id_[order], value[order]
    values = []
    for data in lists["numbers"].to_pylist():
        _, ids, _ = unpacked(data, "<u4", "<u4", "<u8")
        values.append(packed(value[np.searchsorted(id_, ids)].astype("<f4")))
    return _table(_VALUED, [lists["of"].to_pylist(), lists["numbers"].to_pylist(), values])


def with_values(known: DataFrame, values: DataFrame) -> DataFrame:
    """The lists of ``number_words`` with the words' values of (id, bucket, value)."""
    of_words = values.select("bucket", "id", "value")
    return known.groupBy("bucket").cogroup(of_words.groupBy("bucket")).applyInArrow(_valuing, _VALUED)


def listed_values(words: pa.Table) -> np.ndarray:
    """The values of a block's words by their places."""
    at = [np.cumsum(unpacked(data, "<u4", "<u4", "<u8")[0], dtype=np.int64) for data in words["numbers"].to_pylist()]
    at = np.concatenate(at)
    values = np.empty(len(at))
    values[at] = np.concatenate([unpacked(data, "<f4")[0] for data in words["values"].to_pylist()])
    return values


def _packed_pairs(keys: np.ndarray, uses: np.ndarray, shares: np.ndarray) -> bytes:
    """Ascending pairs: steps of the first number, the second numbers, then what comes with them."""
    first = (keys >> np.uint64(32)).astype("<u4")
    return packed(np.diff(first, prepend=np.uint32(0)).astype("<u4"), keys.astype("<u4"), uses.astype("<u4"), shares)


def _unpacked_pairs(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    steps, second, uses, shares = unpacked(data, "<u4", "<u4", "<u4", "<f2")
    return np.cumsum(steps, dtype=np.uint64) << np.uint64(32) | second.astype(np.uint64), uses, shares


# -- seating -----------------------------------------------------------------------------------


def _sending(buckets: int, hot: np.ndarray, total: int):
    def sent(block: pa.Table, words: pa.Table) -> pa.Table:
        found = []
        if block.num_rows:
            ids, counts = listed(words)
            shares = np.log10(np.maximum(counts, 0.5) / max(total, 1)).astype("<f2")
            pairs = Pairs(of_block(block["file"][0].as_py()), ids)
            for bucket, part in pairs.by_bucket(buckets, hot).items():
                data = _packed_pairs(pairs.keys[part], pairs.uses[part], shares[pairs.second[part]])
                found.append((bucket, block["block"][0].as_py(), data))
        return _table(_SENT, list(zip(*found)) or [()] * 3)

    return sent


def _coarse(values: np.ndarray) -> bytes:
    """Numbers to twelve bits, which is plenty for a probability and leaves bytes that compress."""
    return packed(values.astype("<f4").view("<u4") & np.uint32(0xFFFFF000))


def seated(keys: np.ndarray, counts: np.ndarray, shares: np.ndarray, hot: dict[int, int]):
    """(own of each pair, rest and tables of each first word, tables of each pair) of ascending distinct
    pairs; of a hot first word only a part is here, so its rest is not known yet."""
    first = keys >> np.uint64(32)
    begins = np.append(True, first[1:] != first[:-1])
    at, starts = np.cumsum(begins) - 1, np.flatnonzero(begins)
    here = np.add.reduceat(counts, starts)
    customers = np.array([hot.get(int(u), n) for u, n in zip(first[starts], here)], float)
    own, rest, of_word = 0.0, 0.0, 0.0
    tables = np.minimum(counts, 1)
    for sample in range(SAMPLES):
        # As many tables in all of a hot restaurant as its part here has, by its customers.
        all_ = np.add.reduceat(tables, starts) * customers / np.maximum(here, 1)
        others = np.maximum(all_[at] - tables, 0)
        salt = np.uint64((sample + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)
        tables = seat(counts, shares, others, DISCOUNT, STRENGTH, _mixed(keys) ^ salt)
        sums = np.add.reduceat(tables, starts)
        own = own + np.maximum(counts - DISCOUNT * tables, 0) / (STRENGTH + customers[at]) / SAMPLES
        rest = rest + (STRENGTH + DISCOUNT * sums) / (STRENGTH + customers) / SAMPLES
        of_word = of_word + sums / SAMPLES
    return own, rest, of_word, tables, at, first[starts].astype(np.int64)


def _seating(hot: dict[int, int], parts: int):
    def seat_bucket(key: tuple, rows: pa.Table) -> pa.Table:
        keys, uses, shares = zip(*(_unpacked_pairs(data) for data in rows["pairs"].to_pylist()))
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        distinct, met, back = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        uses, shares = np.concatenate(uses), np.concatenate(shares)[met].astype(float)
        counts = np.bincount(back, uses, len(distinct)).astype(np.int64)
        own, rest, of_word, tables, at, words = seated(distinct, counts, 10.0**shares, hot)
        is_hot = np.isin(words, list(hot))
        rest[is_hot] = np.nan
        returned = []
        for of, places in zip(rows["of"].to_pylist(), np.split(back, cuts)):
            context = at[places]
            new = np.append(True, context[1:] != context[:-1])
            returned.append((of, key[0].as_py(), _coarse(own[places]), _coarse(rest[context[new]])))
        second, to = np.unique(distinct & np.uint64(0xFFFFFFFF), return_inverse=True)
        parent = np.bincount(to, tables, len(second)).astype(np.int64)
        second, parent = second[parent > 0].astype(np.uint64), parent[parent > 0].astype("<u8")
        of_parent = []
        for part, at_ in _by_number(_mixed(second) % np.uint64(parts)):
            of_parent.append((part, packed(np.diff(second[at_].astype("<u4"), prepend=np.uint32(0)), parent[at_])))
        of_parent = list(zip(*of_parent)) or [(), ()]
        n, m, h = len(returned), len(of_parent[0]), int(is_hot.sum())
        of, bucket, owns, rests = zip(*returned)

        def column(type_, a=(), b=(), c=()) -> pa.Array:
            parts = [pa.array(v, type_) if len(v) else pa.nulls(size, type_) for v, size in ((a, n), (b, m), (c, h))]
            return pa.concat_arrays(parts)

        return pa.table(
            {
                "of": column(pa.int64(), of),
                "bucket": column(pa.int32(), bucket),
                "own": column(pa.binary(), owns),
                "rest": column(pa.binary(), rests),
                "part": column(pa.int32(), (), of_parent[0]),
                "tables": column(pa.binary(), (), of_parent[1]),
                "hot": column(pa.int64(), (), (), words[is_hot]),
                "hot_tables": column(pa.float64(), (), (), of_word[is_hot]),
            }
        )

    return seat_bucket


def _of_parent(rows: pa.Table) -> pa.Table:
    """Tables of each word of a part, over all buckets."""
    steps, tables = zip(*(unpacked(data, "<u4", "<u8") for data in rows["tables"].to_pylist()))
    ids, at = np.unique(np.concatenate([np.cumsum(s, dtype=np.int64) for s in steps]), return_inverse=True)
    sums = np.bincount(at, np.concatenate(tables), len(ids)).astype(np.int64)
    return pa.table({"id": ids, "tables": sums})


class Contexts:
    """The restaurants of all words, seated: what blocks get back, and the customers of the parent."""

    def __init__(self, blocks: DataFrame, known: DataFrame, vocabulary: DataFrame, total: int, texts: int):
        """``known`` are the numbers (of, at, id, c) of the blocks' words, or the lists of ``number_words``;
        ``vocabulary`` is (id, c, ...)."""
        self.buckets = max(1, -(-total // BUCKET_PAIRS))
        # At most HOT for each bucket, as their counts add up to the total.
        often = vocabulary.where(F.col("c") > total / (HOT * self.buckets)).select("id", "c").collect()
        hot = {START: texts, **{row["id"]: row["c"] for row in often}}
        self.hot = np.array(sorted(hot), np.uint64)
        parts = max(1, self.buckets // _PART_BUCKETS)
        groups = files(blocks).groupBy("block").cogroup(known.groupBy("of"))
        sent = groups.applyInArrow(_sending(self.buckets, self.hot, total), _SENT)
        seated_ = stored(sent.groupBy("bucket").applyInArrow(_seating(hot, parts), _SEATED), "contexts")
        self.returned = seated_.where(F.col("own").isNotNull()).select("of", "bucket", "own", "rest")
        of_parent = seated_.where(F.col("part").isNotNull()).select("part", "tables")
        self.parent = of_parent.groupBy("part").applyInArrow(_of_parent, "id long, tables long")
        sums = seated_.where(F.col("hot").isNotNull()).groupBy("hot").agg(F.sum("hot_tables").alias("n")).collect()
        self.rest_of_hot = {
            row["hot"]: (STRENGTH + DISCOUNT * row["n"]) / (STRENGTH + hot[row["hot"]]) for row in sums
        }


def following(pairs: Pairs, returned: list[dict], buckets: int, hot: np.ndarray, rest_of_hot: dict[int, float]):
    """(own, rest) of each pair of a block, from what the buckets returned."""
    own, rest = np.zeros(len(pairs.keys)), np.ones(len(pairs.keys))
    first = (pairs.keys >> np.uint64(32)).astype(np.int64)
    parts = pairs.by_bucket(buckets, hot)
    for row in returned:
        part = parts[row["bucket"]]
        own[part] = unpacked(row["own"], "<f4")[0]
        context = np.cumsum(np.append(False, first[part][1:] != first[part][:-1]))
        rest[part] = unpacked(row["rest"], "<f4")[0][context]
    for word, value in rest_of_hot.items():
        rest[first == word] = value
    return own, rest
