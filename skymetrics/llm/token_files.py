"""Token ids of documents in binary files, packed to the bits that the vocabulary needs.

A file holds the documents of one range of ids, in ascending order. Its layout, all little-endian:

    8 bytes   magic and version
    u32 x 4   bits of an id, ids of a block, documents, blocks
    u64       ids in all
    i64 each  document ids, then one byte each: 0 if the id is null
    u64 each  where each document's ids begin, in ids
    u64 each  where each block begins, in bytes from the end of this table
    blocks    ids of ``bits`` bits each, lowest bit first, padded to whole bytes

A block is found by its offset and unpacked with numpy without the ones before it.

Files are named by their place in the order and written under a temporary name first, so a task
that is run again replaces its files by the same ones. The folder must be one that all executors
reach; any file system that pyarrow knows will do.

Null and empty texts are their end id only; very long ones are written whole. A null id comes first.
Documents with one id are in the order of a hash of their texts, repeated rows one after the other. An empty
table gives no file. Only ``doc_id`` and ``text`` are read, so further columns may have any name.
"""

import os
import zlib
from collections.abc import Iterator
from itertools import filterfalse

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import spark_partition_id
from tokenizers import Tokenizer

from skymetrics.llm.common import documents, kept, small_batches, stored
from skymetrics.plans.session import file_system, scratch_folder

MAGIC = b"TOKBITS\x01"
BLOCK = 4096
END_ID = 1

# Ids of a file; words whose ids a worker remembers; texts that are encoded together.
FILE_IDS = 2 << 20
_CACHE_LIMIT = 2_000_000
_TOGETHER = 500


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as a string of ``bits`` bits each."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids.astype(np.uint32)[:, None] >> np.arange(bits, dtype=np.uint32)) & 1
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    flat = np.unpackbits(np.frombuffer(data, np.uint8), count=count * bits, bitorder="little")
    places = np.uint32(1) << np.arange(bits, dtype=np.uint32)
    return flat.reshape(count, bits).astype(np.uint32) @ places


def write_file(doc_ids: list[int | None], parts: list[np.ndarray], bits: int, block: int = BLOCK) -> bytes:
    """A file's bytes: ``parts`` are the ids of each document."""
    ids = np.concatenate(parts) if parts else np.empty(0, np.uint32)
    starts = np.cumsum([0, *map(len, parts)])[:-1]
    blocks = [pack(ids[i : i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.cumsum([0, *map(len, blocks)])[:-1]
    head = [
        MAGIC,
        np.array([bits, block, len(parts), len(blocks)], "<u4").tobytes(),
        np.array([len(ids)], "<u8").tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
        np.array([d is not None for d in doc_ids], "u1").tobytes(),
        starts.astype("<u8").tobytes(),
        offsets.astype("<u8").tobytes(),
    ]
    return b"".join(head + blocks)


class TokenFile:
    """Random access to a file's bytes."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token file")
        self.bits, self.block, n, blocks = map(int, np.frombuffer(data, "<u4", 4, 8))
        self.size = int(np.frombuffer(data, "<u8", 1, 24)[0])
        at = 32
        ids, self.known = np.frombuffer(data, "<i8", n, at), np.frombuffer(data, "u1", n, at + 8 * n)
        self.doc_ids = [int(d) if k else None for d, k in zip(ids, self.known)]
        at += 9 * n
        self.starts = np.append(np.frombuffer(data, "<u8", n, at), self.size).astype(np.int64)
        self.offsets = np.frombuffer(data, "<u8", blocks, at + 8 * n).astype(np.int64)
        self.data, self.body = data, at + 8 * n + 8 * blocks

    def read(self, start: int, stop: int) -> np.ndarray:
        """Ids from ``start`` up to ``stop``, from the blocks that hold them."""
        if stop <= start:
            return np.empty(0, np.uint32)
        found = []
        for b in range(start // self.block, (stop - 1) // self.block + 1):
            count = min(self.block, self.size - b * self.block)
            at = self.body + int(self.offsets[b])
            found.append(unpack(self.data[at : at + (count * self.bits + 7) // 8], self.bits, count))
        first = start // self.block * self.block
        return np.concatenate(found)[start - first : stop - first]

    def document(self, i: int) -> np.ndarray:
        return self.read(int(self.starts[i]), int(self.starts[i + 1]))


class Encoder(dict):
    """Ids of white-space separated words, as bytes of unsigned 32-bit numbers.

    The tokenizer's rules treat white space as a border, and what follows a letter or digit and is
    neither, nor an apostrophe, as another. They lower A-Z themselves. So a text's ids are those of
    its words, and a word's are those of its stem and of the signs at its end. Words are encoded
    once and remembered until there are too many.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        # Specials are looked for before a text is split, in its own letters and in lowered ones.
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.specials = [t.encode() for t in special]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def __missing__(self, word: bytes) -> bytes:
        found = self[word] = self._ids(word.decode())
        return found

    def _ids(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: set[bytes]) -> None:
        """Encodes new words: stems of Latin letters together, as each ends where a token ends a word."""
        cut = {}
        for word in words:
            stem = word.rstrip(_SIGNS)
            last = stem[-1:]
            if stem and len(stem) < len(word) and last.isalnum() and last < b"\x80":
                cut[word] = stem
        stems = set(filterfalse(self.__contains__, words.difference(cut).union(cut.values())))
        plain = [w for w in stems if (t := w.decode()).isalpha() and max(t) < "\u0250"]
        for i in range(0, len(plain), 500):
            part = plain[i : i + 500]
            ids = np.array(self.tokenizer.encode(b" ".join(part).decode(), add_special_tokens=False).ids, "<u4")
            stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stops) == len(part):
                flat = ids.tobytes()
                self.update(zip(part, (flat[a:b] for a, b in zip([0, *stops], stops))))
        for word, stem in cut.items():
            self[word] = self[stem] + self[word[len(stem) :]]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if len(self) > _CACHE_LIMIT:
            self.clear()
        raw = [text.encode() for text in texts]
        low = [r.lower() for r in raw]
        special = [any(s in a or s in b for s in self.specials) for a, b in zip(raw, low)]
        words = [[] if odd else b.split() for odd, b in zip(special, low)]
        # Not a difference of sets, which would walk through all words remembered.
        self._learn(set(filterfalse(self.__contains__, set().union(*words))))
        ids = self.__getitem__
        return [self._ids(t) if odd else b"".join(map(ids, w)) for t, odd, w in zip(texts, special, words)]


# Signs at the end of a word that its ids can be cut before.
_SIGNS = b".,;:!?|#*$%&"


def encoder(path: str) -> Encoder:
    return kept("encoder_" + "".join(c if c.isalnum() else "_" for c in path), lambda: Encoder(path))


def _save(folder: str, name: str, data: bytes) -> None:
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    passing = f"{base}/.{name}.{os.getpid()}-{os.urandom(4).hex()}"
    with fs.open_output_stream(passing) as out:
        out.write(data)
    fs.move(passing, f"{base}/{name}")


def write(docs: DataFrame, folder: str, path: str, end: int = END_ID) -> DataFrame:
    """Writes the token files of ``docs``; returns their list (part, number, name, ids), in order."""
    bits = bits_for(Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True))
    fs, base = pyarrow.fs.FileSystem.from_uri(folder)
    fs.create_dir(base, recursive=True)
    small_batches(docs.sparkSession)
    stop = np.array([end], "<u4").tobytes()

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        doc_ids, parts, held, number, part = [], [], 0, 0, None
        known = encoder(path)

        def flush() -> pa.RecordBatch:
            name = f"part-{part:08d}-{number:06d}.tok"
            _save(folder, name, write_file(doc_ids, parts, bits))
            return pa.RecordBatch.from_pylist([{"part": part, "number": number, "name": name, "ids": held}])

        for whole in batches:
            for first in range(0, whole.num_rows, _TOGETHER):
                batch = whole.slice(first, _TOGETHER)
                part = batch["part"][0].as_py()
                texts = known.encode([t or "" for t in batch["text"].to_pylist()])
                for doc_id, packed in zip(batch["doc_id"].to_pylist(), texts):
                    ids = np.frombuffer(packed + stop, "<u4")
                    if parts and held + len(ids) > FILE_IDS:
                        yield flush()
                        doc_ids, parts, held, number = [], [], 0, number + 1
                    doc_ids.append(doc_id)
                    parts.append(ids)
                    held += len(ids)
        if parts:
            yield flush()

    # Texts are dealt by range and only then encoded, as Spark looks at the rows twice to find the
    # ranges. The hash breaks up an id that very many rows share.
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = docs.select("doc_id", "text").repartitionByRange(*order).sortWithinPartitions(*order)
    rows = ranged.select("doc_id", "text", spark_partition_id().cast("long").alias("part"))
    return stored(rows.mapInArrow(save, "part long, number long, name string, ids long"), "token-files")


def read(spark: SparkSession, folder: str, listed: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of a list."""

    def documents_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch["name"], batch["content"]):
                file = TokenFile(content.as_py())
                ids = [file.document(i) for i in range(len(file.doc_ids))]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name.as_py()] * len(ids), pa.string()),
                        pa.array(file.doc_ids, pa.int64()),
                        pa.array(file.starts[:-1], pa.int64()),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([zlib.crc32(x.astype("<u4").tobytes()) for x in ids], pa.int64()),
                    ],
                    ["name", "doc_id", "inner", "n_tokens", "ids_crc32"],
                )

    # A row for each file: what lies before its part, and before it within the part.
    parts = listed.groupBy("part").agg(F.sum("ids").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offset = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    places = listed.withColumn("within", F.coalesce(F.sum("ids").over(inside), F.lit(0))).join(offset, "part")
    names = places.select("name", (F.col("offset") + F.col("within")).alias("before"))

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    rows = named.mapInArrow(
        documents_of, "name string, doc_id long, inner long, n_tokens long, ids_crc32 long"
    )
    return rows.join(names, "name").select(
        "doc_id", (F.col("before") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32"
    )


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with its file system, as the cluster takes it."""
    fs, path = file_system(spark, folder)
    uri = fs.makeQualified(path).toString()
    return "file://" + uri.removeprefix("file:") if uri.startswith("file:/") and "://" not in uri else uri


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = qualified(spark, scratch_folder(spark, "tokens"))
    listed = write(documents(spark, sf_dir), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read(spark, folder, listed)
