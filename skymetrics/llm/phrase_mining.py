"""Phrase collocations, counted without loss in counting quotient filters.

Texts are cut into pieces at punctuation and line ends and pieces into words, and phrases of two to
``LONGEST`` words are counted within pieces, per language. A phrase is packed into one number from its
words' numbers. An invertible permutation spreads such numbers evenly; the top bits of the result are
the quotient, which says in which run of the filter an entry lies, and the others are its remainder,
kept in full. So no two phrases share a counter, and the phrase can be read back from its entry.

Every task counts its blocks of text in filters of its own, merges them as it goes, and cuts them into
ranges of the permuted numbers. Filters are sorted, so those of all tasks for a range are merged by one
pass. A hot phrase is one counter of each filter, and the permutation gives all ranges the same load,
whatever the language or phrase.

Only phrases that occur ``LEAST`` times are of interest, and every part of such a phrase occurs as often.
So words that occur more seldom get no number and break a piece, and a phrase of three or more words
is counted only where its parts of one word less may be frequent, by a bitmap of ``BITMAP_BITS`` bits (4 MB)
of frequent parts. The bitmap lets all frequent ones pass, and counts are exact.

A null language is ``und``. Null and empty texts have no words, and very long ones are counted whole.
Ties go by more occurrences, then by the phrase. Repeated rows count each. An empty table gives no
rows. Only ``text`` and ``lang`` are read, so further columns may have any name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skymetrics.llm.common import documents, numbered, small_batches
from skymetrics.llm.common import stored as _stored
from skymetrics.operators.ranking import top_n

LONGEST = 4
LEAST = 30
MOST = 2000
# A phrase that a longer one covers to so many hundredths is left out; scale of scores.
COVERED = 80
SCALE = 2_000_000

BLOCK_BYTES = 8 << 20
# Words whose phrases are counted together, entries that a task holds, words in all to a range: these bound
# a task's memory.
STRETCH_WORDS = 1 << 18
TASK_ENTRIES = 1 << 20
RANGE_WORDS = 1 << 20
BITMAP_BITS = 1 << 25

# Fixed value: what ends a piece, as one sign; A-Z in lower case.
_STOP = b"."
_TABLE = bytes(ord(".") if chr(c) in ".,;:!?\n\x0b\x0c\r" else c for c in range(256)).lower()

_BLOCKS = "block long, lang string, words array<binary>, uses array<long>, places binary"


# -- words -------------------------------------------------------------------------------------


class _Places(dict):
    """Numbers of a block's words, from 1; 0 is the end of a piece."""

    def __init__(self):
        super().__init__({_STOP: 0})

    def __missing__(self, word: bytes) -> int:
        place = self[word] = len(self)
        return place


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a stretch of documents, by language, as numbers of the block's own."""
    number = TaskContext.get().partitionId() << 32
    held: dict[str, tuple[_Places, list]] = {}
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal number
        for lang, (places, parts) in held.items():
            flat = np.concatenate(parts)
            uses = np.bincount(flat, minlength=len(places))[1:]
            values = [number, lang, list(places)[1:], uses.tolist(), flat.tobytes()]
            types = [pa.int64(), pa.string(), pa.list_(pa.binary()), pa.list_(pa.int64()), pa.binary()]
            names = [column.split()[0] for column in _BLOCKS.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types)], names)
            number += 1

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            raw = (text.as_py() or "").encode("utf-8")
            words = raw.translate(_TABLE).replace(_STOP, b" . ").split()
            words.append(_STOP)
            places, parts = held.setdefault(lang, (_Places(), []))
            parts.append(np.fromiter(map(places.__getitem__, words), "<u4", len(words)))
            size += len(raw)
            if size > BLOCK_BYTES:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def _coded(block: pa.Table, ids: pa.Table) -> pa.Table:
    """A block's words as numbers of the whole corpus; 0 for piece ends and seldom words."""
    found = []
    for row in block.select(["block", "places"]).to_pylist():
        flat = np.frombuffer(row["places"], "<u4")
        table = np.zeros(int(flat.max(initial=0)) + 1, "<u4")
        table[ids["at"].to_numpy() + 1] = ids["id"].to_numpy()
        coded = table[flat]
        coded = coded[(coded != 0) | (np.append(0, coded[:-1]) != 0)]
        found.append(coded.tobytes())
    return pa.table({"ids": pa.array(found, pa.binary())})


# -- filters -----------------------------------------------------------------------------------

_ROUNDS = (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03, 0x8CB92BA72F3D8DD7, 0xAEF17502108EF2D9)


def _mask(bits: int) -> np.uint64:
    return np.uint64((1 << bits) - 1)


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(key)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(left: np.ndarray, right: np.ndarray, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """A permutation of pairs of numbers of so many bits: each round changes one by the other."""
    for i, key in enumerate(_ROUNDS):
        if i % 2:
            left = left ^ (_mixed(right, key) & _mask(bits[0]))
        else:
            right = right ^ (_mixed(left, key) & _mask(bits[1]))
    return left, right


def restored(left: np.ndarray, right: np.ndarray, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that ``permuted`` took."""
    for i, key in reversed(list(enumerate(_ROUNDS))):
        if i % 2:
            left = left ^ (_mixed(right, key) & _mask(bits[0]))
        else:
            right = right ^ (_mixed(left, key) & _mask(bits[1]))
    return left, right


def bits_of(words: int, width: int) -> tuple[int, int]:
    """Bits of both halves of a phrase whose words' numbers have ``width`` bits."""
    return (words + 1) // 2 * width, words // 2 * width


def packed(ids: np.ndarray, words: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Halves of the phrases that begin at each place of ``ids``."""
    n = max(0, len(ids) - words + 1)
    halves = []
    for places in (range((words + 1) // 2), range((words + 1) // 2, words)):
        half = np.zeros(n, np.uint64)
        for i in places:
            half = half << np.uint64(width) | ids[i : i + n]
        halves.append(half)
    return halves[0], halves[1]


def unpacked(left: np.ndarray, right: np.ndarray, words: int, width: int) -> np.ndarray:
    """Numbers (phrase, word) of packed phrases."""
    found = np.empty((len(left), words), np.int64)
    for half, places in ((left, range((words + 1) // 2)), (right, range((words + 1) // 2, words))):
        for shift, i in enumerate(reversed(places)):
            found[:, i] = (half >> np.uint64(shift * width)) & _mask(width)
    return found


def summed(left: np.ndarray, right: np.ndarray, counts: np.ndarray, bits: tuple[int, int]):
    """Distinct pairs in ascending order and the sum of their counts."""
    if not len(left):
        return left, right, counts
    # A stable sort merges runs that are sorted already, as those of filters are.
    narrow = sum(bits) <= 64
    order = np.argsort(left << np.uint64(bits[1]) | right, kind="stable") if narrow else np.lexsort((right, left))
    left, right = left[order], right[order]
    first = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])))
    return left[first], right[first], np.add.reduceat(counts[order], first)


def _short(values: np.ndarray) -> bytes:
    """Numbers as a byte each; 255 stands for one that follows at the end in eight."""
    return np.minimum(values, 255).astype("u1").tobytes() + values[values >= 255].astype("<u8").tobytes()


def _long(data: bytes, at: int, count: int) -> tuple[np.ndarray, int]:
    values = np.frombuffer(data, "u1", count, at).astype(np.uint64)
    large = np.flatnonzero(values == 255)
    values[large] = np.frombuffer(data, "<u8", len(large), at + count)
    return values, at + count + 8 * len(large)


def _bytes_of(values: np.ndarray, bits: int) -> bytes:
    size = -(-bits // 8)
    return np.ascontiguousarray(values.astype("<u8").view("u1").reshape(-1, 8)[:, :size]).tobytes()


def _values(data: bytes, at: int, count: int, bits: int) -> tuple[np.ndarray, int]:
    size = -(-bits // 8)
    wide = np.zeros((count, 8), "u1")
    wide[:, :size] = np.frombuffer(data, "u1", count * size, at).reshape(count, size)
    return wide.view("<u8").ravel(), at + count * size


def filter_of(left: np.ndarray, right: np.ndarray, counts: np.ndarray, bits: tuple[int, int]) -> bytes:
    """A counting quotient filter of sorted, distinct pairs.

    The upper bits of ``left`` are the quotient: about as many runs as entries, of which only the lengths
    are stored. What is left of ``left``, and ``right``, are the remainder.
    """
    quotient_bits = min(bits[0], max(0, len(left).bit_length() - 1))
    rest = bits[0] - quotient_bits
    runs = np.bincount((left >> np.uint64(rest)).astype(np.int64), minlength=1 << quotient_bits).astype(np.uint64)
    head = np.array([len(left), quotient_bits], "<u8").tobytes()
    parts = [head, _short(runs), _bytes_of(left & _mask(rest), rest), _bytes_of(right, bits[1]), _short(counts)]
    return b"".join(parts)


def entries_of(data: bytes, bits: tuple[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sorted pairs of a filter and their counts."""
    n, quotient_bits = map(int, np.frombuffer(data, "<u8", 2))
    rest = bits[0] - quotient_bits
    runs, at = _long(data, 16, 1 << quotient_bits)
    low, at = _values(data, at, n, rest)
    right, at = _values(data, at, n, bits[1])
    counts, _ = _long(data, at, n)
    quotient = np.repeat(np.arange(1 << quotient_bits, dtype=np.uint64), runs.astype(np.int64))
    return quotient << np.uint64(rest) | low, right, counts


def merged(filters: list, bits: tuple[int, int]):
    """One sorted list of pairs and counts from several."""
    return summed(*(np.concatenate(part) for part in zip(*filters)), bits)


# -- counting ----------------------------------------------------------------------------------


def _bit(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Place of permuted pairs in the bitmap of frequent phrases."""
    return _mixed(left ^ _mixed(right, 1), 2) % np.uint64(BITMAP_BITS)


def _counting(words: int, width: int, range_bits: int, frequent):
    """Filters of a task's phrases of so many words, a row for each range of permuted numbers."""
    bits = bits_of(words, width)
    inner = (bits[0] - range_bits, bits[1])

    def phrases(ids: np.ndarray):
        ids = ids.astype(np.uint64)
        starts = max(0, len(ids) - words + 1)
        whole = np.ones(starts, bool)
        for i in range(words):
            whole &= ids[i : i + starts] != 0
        if frequent is not None and starts:
            part = words - 1
            pairs = permuted(*packed(ids, part, width), bits_of(part, width))
            place = _bit(*pairs)
            known = frequent.value[place >> np.uint64(3)] >> (place & np.uint64(7)).astype("u1") & 1 == 1
            whole &= known[:starts] & known[1 : starts + 1]
        left, right = (half[whole] for half in packed(ids, words, width))
        return summed(*permuted(left, right, bits), np.ones(len(left), np.uint64), bits)

    def stretches(block: bytes) -> Iterator[np.ndarray]:
        # A phrase begins in one stretch only, and ends in it or behind it.
        ids = np.frombuffer(block, "<u4")
        for first in range(0, len(ids), STRETCH_WORDS):
            yield ids[first : first + STRETCH_WORDS + words - 1]

    def rows(held) -> pa.RecordBatch:
        left, right, counts = held
        ranges = np.arange((1 << range_bits) + 1, dtype=np.uint64)
        edges = ranges[:-1] << np.uint64(inner[0])
        cuts = np.append(np.searchsorted(left, edges), len(left)).tolist()
        used = [r for r in range(1 << range_bits) if cuts[r] < cuts[r + 1]]
        kept = [slice(cuts[r], cuts[r + 1]) for r in used]
        filters = [filter_of(left[k] & _mask(inner[0]), right[k], counts[k], inner) for k in kept]
        return pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(filters, pa.binary())], ["range", "filter"])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for ids in (ids for block in batch["ids"] for ids in stretches(block.as_py())):
                held.append(phrases(ids))
                size += len(held[-1][0])
                if size > TASK_ENTRIES:
                    held = [merged(held, bits)]
                    size = len(held[0][0])
                    if size > TASK_ENTRIES // 2:
                        yield rows(held[0])
                        held, size = [], 0
        if held:
            yield rows(merged(held, bits))

    return counted


def _merging(words: int, width: int, range_bits: int, least: int):
    bits = bits_of(words, width)
    inner = (bits[0] - range_bits, bits[1])

    def merging(key: tuple, filters: pa.Table) -> pa.Table:
        left, right, counts = merged([entries_of(f.as_py(), inner) for f in filters["filter"]], inner)
        often = counts >= least
        left, right, counts = left[often], right[often], counts[often].astype(np.int64)
        left = left | np.uint64(key[0].as_py()) << np.uint64(inner[0])
        ids = unpacked(*restored(left, right, bits), words, width)
        offsets = np.arange(len(ids) + 1, dtype=np.int32) * words
        return pa.table(
            {
                "ids": pa.ListArray.from_arrays(offsets, ids.ravel()),
                "f": counts,
                "bit": _bit(left, right).astype(np.int64),
            }
        )

    return merging


def _bitmap(spark: SparkSession, frequent: DataFrame):
    """Broadcast of the bitmap of frequent phrases: at most ``BITMAP_BITS`` / 64 rows for the driver."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit").bitwiseAND(F.lit(63)).cast("int"))
    rows = frequent.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP_BITS // 64, "<i8")
    bitmap[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return spark.sparkContext.broadcast(bitmap.view("u1"))


def stored(df: DataFrame, name: str) -> DataFrame:
    return _stored(df, f"phrases-{name}")


def frequent_phrases(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n), (id, lang, word, f) and (ids, f): words in all, frequent words, frequent phrases of two
    or more words as lists of their words' ids."""
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    blocks = stored(rows.mapInArrow(_blocks, _BLOCKS), "blocks")
    of = F.col("block").alias("of")  # a name of its own, to join with the blocks
    entries = blocks.select(of, "lang", F.posexplode(F.arrays_zip("words", "uses")).alias("at", "entry"))
    entries = entries.select("of", "lang", "at", F.col("entry.words").alias("word"), F.col("entry.uses").alias("uses"))
    counts = entries.groupBy("lang", "word").agg(F.sum("uses").alias("f"))
    words = numbered(counts.where(F.col("f") >= least), "phrases-words")
    sums = blocks.select("lang", F.aggregate("uses", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    totals = stored(sums.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    n_known, n_words = words.count(), totals.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    width = max(1, n_known.bit_length())
    if width > 32:
        raise ValueError(f"{n_known} frequent words are too many to be numbered in 32 bits")

    known = entries.drop("uses").join(words.select("lang", "word", "id"), ["lang", "word"]).select("of", "at", "id")
    groups = blocks.select("block", "places").groupBy("block").cogroup(known.groupBy("of"))
    coded = stored(groups.applyInArrow(_coded, "ids binary"), "coded")
    phrases, bitmap = None, None
    for size in range(2, longest + 1):
        range_bits = min(bits_of(size, width)[0], max(0, (n_words // RANGE_WORDS).bit_length()))
        filters = coded.mapInArrow(_counting(size, width, range_bits, bitmap), "range long, filter binary")
        merge = _merging(size, width, range_bits, least)
        found = stored(filters.groupBy("range").applyInArrow(merge, "ids array<long>, f long, bit long"), f"of-{size}")
        bitmap = _bitmap(spark, found)
        phrases = found.drop("bit") if phrases is None else phrases.union(found.drop("bit"))
    return totals, words, phrases


# -- scores ------------------------------------------------------------------------------------


def _exact(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(28,0)")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``most`` phrases with the highest scores."""
    totals, words, phrases = frequent_phrases(docs, longest, least)
    f = phrases.union(words.select(F.array("id"), "f"))
    size, k = F.size("ids"), F.col("k")
    cuts = phrases.select("ids", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.slice("ids", F.lit(1), k)).withColumn("rest", F.slice("ids", k + 1, size - k))
    sided = cuts.join(f.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first")
    sided = sided.join(f.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    score = F.expr(f"cast(a as decimal(28,0)) * {SCALE} div (cast(l as decimal(28,0)) + r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = sided.groupBy("ids", "a").agg(lowest)

    covers = phrases.where(size > 2).select(F.explode(_parts("ids")).alias("ids"), "f")
    covers = covers.groupBy("ids").agg(F.max("f").alias("cover"))
    covered = F.coalesce(_exact("cover") * 100 >= _exact("a") * COVERED, F.lit(False))
    kept = scored.join(covers, "ids", "left").where(~covered).select("ids", "a", "cut.l", "cut.r", "cut.score")
    langs = words.select(F.col("id").alias("first"), "lang")
    kept = kept.join(langs, kept["ids"][0] == F.col("first")).drop("first")

    order = [F.col("score").desc(), F.col("a").desc()]
    near = kept.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
    near = stored(near.where(F.col("place") <= most).drop("place"), "near")
    spelt = near.select("ids", F.posexplode("ids").alias("at", "id")).join(words.select("id", "word"), "id")
    texts = F.array_sort(F.collect_list(F.struct("at", F.col("word").cast("string").alias("word"))))
    spelt = spelt.groupBy("ids").agg(F.array_join(texts["word"], " ").alias("phrase"))
    best = top_n(near.join(spelt, "ids"), [*order, F.col("phrase").asc()], n=most, per=["lang"], rank="rank")
    best = best.withColumn("rank", F.col("rank").cast("long")).join(totals, "lang")
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _parts(ids: str) -> Column:
    """All contiguous parts of a phrase of two or more words that are shorter than it."""
    size = F.size(ids)
    lengths = F.sequence(F.lit(2), size - 1)
    of_length = lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda at: F.slice(F.col(ids), at, n)
    )
    return F.flatten(F.transform(lengths, of_length))


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))
