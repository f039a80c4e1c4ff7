"""Documents in blocks with a word list each: what counting and scoring of words work on.

A block is a stretch of documents of about ``BLOCK_BYTES`` of text. Words are numbered within it, and
a document is its distinct words' numbers and how often each occurs. So a word is a row once for
each block and not for each place, however frequent it is.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skymetrics.llm.common import small_batches
from skymetrics.plans.session import scratch_folder

BLOCK_BYTES = 12 << 20

# One row for each block. The binary columns are unsigned 32-bit numbers of all documents in turn.
SCHEMA = (
    "block long, words array<binary>, uses array<int>, holders array<int>, doc_ids array<long>, "
    "flags array<boolean>, sizes array<int>, numbers binary, times binary"
)


# The white space between words.
_SPACE = np.isin(np.arange(256), np.frombuffer(b"\t\n\v\f\r ", np.uint8))


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8").lower().split()


def _split(texts: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """The words of all texts in turn, as ``words_of`` cuts them, and the place of each word's text."""
    whole = np.frombuffer(b" ".join([b"", *texts, b""]), np.uint8)
    space = _SPACE[whole]
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    starts, ends = edges[::2], edges[1::2]
    offsets = np.append(0, np.cumsum(ends - starts))
    data = [None, pa.py_buffer(offsets), pa.py_buffer(whole[~space])]
    before = np.searchsorted(starts, 1 + np.cumsum([len(text) + 1 for text in texts]))
    text = np.repeat(np.arange(len(texts)), np.diff(before, prepend=0))
    return text, pa.Array.from_buffers(pa.large_binary(), len(starts), data)


def _counted(texts: list[bytes], end: bytes | None) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, sizes, numbers, times): distinct words, and how many of them each text has, which and how often."""
    text, words = _split(texts)
    if end is not None:
        text = np.append(text, np.arange(len(texts)))
        words = pa.concat_arrays([words, pa.array([end] * len(texts), pa.large_binary())])
    encoded = words.dictionary_encode()
    n_words = max(1, len(encoded.dictionary))
    places = np.sort(text * n_words + encoded.indices.to_numpy())
    firsts = np.flatnonzero(np.diff(places, prepend=-1))
    times = np.diff(np.append(firsts, len(places)))
    text, number = np.divmod(places[firsts], n_words)
    return encoded.dictionary.cast(pa.binary()), np.bincount(text, minlength=len(texts)), number, times


def _row(
    block: int, ids: list, flags: list[bool], words: pa.Array, sizes: np.ndarray, number: np.ndarray, times: np.ndarray
) -> pa.RecordBatch:
    flagged = np.repeat(np.array(flags, bool), sizes)
    uses = np.bincount(number[flagged], times[flagged], len(words)).astype(np.int32)
    holders = np.bincount(number, minlength=len(words)).astype(np.int32)
    row = [
        pa.array([block], pa.int64()),
        pa.ListArray.from_arrays([0, len(words)], words),
        pa.ListArray.from_arrays([0, len(words)], pa.array(uses)),
        pa.ListArray.from_arrays([0, len(words)], pa.array(holders)),
        pa.array([ids], pa.list_(pa.int64())),
        pa.array([flags], pa.list_(pa.bool_())),
        pa.ListArray.from_arrays([0, len(sizes)], pa.array(sizes.astype(np.int32))),
        pa.array([number.astype("<u4").tobytes()], pa.binary()),
        pa.array([times.astype("<u4").tobytes()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(row, [c.split()[0] for c in SCHEMA.split(", ")])


def _block(number: int, ids: list, flags: list[bool], counted: list[Counter]) -> pa.RecordBatch:
    """A block of documents whose words are counted."""
    place: dict[bytes, int] = {}
    numbers = np.array([place.setdefault(w, len(place)) for counts in counted for w in counts], np.int64)
    times = np.array([n for counts in counted for n in counts.values()], np.int64)
    return _row(number, ids, flags, pa.array(list(place), pa.binary()), np.array(list(map(len, counted))), numbers, times)


def _blocks(end: bytes | None):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids, flags, texts, held = [], [], [], 0
        for batch in batches:
            for doc_id, flag, value in zip(batch["doc_id"], batch["flag"], batch["text"]):
                text = value.as_py() or ""
                texts.append(text.encode("utf-8").lower())
                ids.append(doc_id.as_py())
                flags.append(flag.as_py())
                held += len(text)
                if held > BLOCK_BYTES:
                    yield _row(number, ids, flags, *_counted(texts, end))
                    ids, flags, texts, held, number = [], [], [], 0, number + 1
        if ids:
            yield _row(number, ids, flags, *_counted(texts, end))

    return blocks


def build(docs: DataFrame, flag: Column, end: bytes | None = None) -> DataFrame:
    """The blocks of ``docs``, a stored file each. ``flag`` marks documents whose words ``uses`` counts, while
    ``holders`` counts the documents that hold a word; ``end`` is a word added to each document."""
    small_batches(docs.sparkSession)
    rows = docs.select("doc_id", flag.alias("flag"), "text").mapInArrow(_blocks(end), SCHEMA)
    folder = scratch_folder(docs.sparkSession, "blocks")
    rows.write.partitionBy("block").option("compression", "zstd").parquet(folder)
    return docs.sparkSession.read.schema(rows.schema).parquet(folder)


def files(rows: DataFrame, key: str = "block") -> DataFrame:
    """(key, file): where each row lies that was stored as a file of its own."""
    return rows.select(key, F.col("_metadata.file_path").alias("file"))


def opened(file: str, columns: list[str]) -> pa.Table:
    """Columns of such a row, from its file."""
    system, path = pyarrow.fs.FileSystem.from_uri(file)
    with system.open_input_file(path) as source:
        return pq.ParquetFile(source).read(columns=columns)


def entries(blocks: DataFrame, count: str) -> DataFrame:
    """(of, at, word, n): each word of each block ``of``, with its place there and its ``count``."""
    pairs = F.posexplode(F.arrays_zip(F.col("words").alias("word"), F.col(count).alias("n")))
    of = F.col("block").alias("of")  # a name of its own, for joins with the blocks
    return blocks.select(of, pairs.alias("at", "pair")).select("of", "at", "pair.word", "pair.n")


def numbers(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4").astype(np.int64)
