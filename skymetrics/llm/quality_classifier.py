"""Quality of documents by a linear-chain conditional random field over their lines.

Every line of a document is good or bad. Features of a line are its own and those of its two
neighbours; they are counts over bytes and words, taken for many documents at once. The field is
fitted on documents with a quality label, all lines of which take the label. A document's score is
the mean probability of its lines being good, by forward-backward, each line weighted by length.

Null and empty texts are one empty line. Without labels of both kinds every score is 0.5; an empty table
gives no rows. Very long texts are scored whole. Repeated rows are scored alike; labels of a repeated id
must agree or the larger one counts. Only ``doc_id`` and ``text`` are read, so further columns may have any name.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skymetrics.llm.common import chunks, documents, fold_is, small_batches, text_bytes
from skymetrics.operators.ranking import top_n

# Bounds of the fitting sample of each label value: documents, by hash of their id, and stretches of lines
# that are fitted as one chain each, by hash of their features.
TRAIN_DOCUMENTS = 2000
STRETCH = 64
MAX_STRETCHES = 3000

# Classes of bytes; each is a feature as a share of the line's bytes.
_CLASSES = (
    bytes(range(ord("a"), ord("z") + 1)),
    bytes(range(ord("A"), ord("Z") + 1)),
    b"0123456789",
    b".",
    b",",
    b"!?",
    b"|",
    b"#$%&*<>",
    b"\"'()[]{}",
    b"-_/\\:;@=+~^`",
    bytes(range(0x80, 0x100)),
    bytes(range(0x21)),
)
_N_CLASSES = len(_CLASSES) + 1
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _members in enumerate(_CLASSES):
    _CLASS_OF[list(_members)] = _k
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += 32
# Multipliers of a word's bytes by place, so that a word's hash is one weighted sum.
_PLACES = np.random.default_rng(7).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)

_N_OWN = _N_CLASSES + 9
N_FEATURES = 3 * _N_OWN + 3


def _lines(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts with a line feed after each, and start, end and document of each line."""
    data, ends = text_bytes(texts)
    data = np.insert(data, ends[1:], 10)
    ends = ends + np.arange(len(ends))
    stop = np.flatnonzero(data == 10)
    start = np.concatenate([[0], stop[:-1] + 1])
    return data, start, stop, np.searchsorted(ends[1:], stop, side="right")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line of the texts, the document each belongs to, and its length."""
    data, start, stop, doc = _lines(texts)
    n, size = len(start), stop - start
    line_of = np.repeat(np.arange(n), size + 1)
    counts = np.bincount(line_of * _N_CLASSES + _CLASS_OF[data], minlength=n * _N_CLASSES)
    counts = counts.reshape(n, _N_CLASSES).astype(float)
    counts[:, len(_CLASSES) - 1] -= 1  # its line feed

    solid = ~_SPACE[data]
    first = np.flatnonzero(solid & ~np.concatenate([[False], solid[:-1]]))
    words = np.bincount(line_of[first], minlength=n) if len(first) else np.zeros(n, int)
    own = [_share(counts[:, k], size) for k in range(_N_CLASSES)]
    short = equal = distinct = np.zeros(n)
    if len(first):
        word_of = np.cumsum(np.bincount(first, minlength=len(data))) - 1
        place = np.arange(len(data)) - first[np.maximum(word_of, 0)]
        weighed = (_LOWER[data] + np.uint64(1)) * _PLACES[place & 63]
        weighed[~solid] = 0
        hashes = np.add.reduceat(weighed, first)
        length = np.add.reduceat(solid.astype(np.int64), first)
        line = line_of[first]
        same = np.concatenate([[False], (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])])
        short = _share(np.bincount(line[length <= 3], minlength=n), words)
        equal = _share(np.bincount(line[same], minlength=n), words)
        key = hashes * np.uint64(0x9E3779B97F4A7C15) ^ line.astype(np.uint64) * _PLACES[0]
        _, kept = np.unique(key, return_index=True)
        distinct = _share(np.bincount(line[kept], minlength=n), words)
    # A line's hash, by its words in their order, tells repeated lines of a document.
    digest = np.zeros(n, np.uint64)
    if len(first):
        rank = np.arange(len(first)) - (np.cumsum(words) - words)[line]
        np.add.at(digest, line, hashes * _PLACES[rank & 63])
    key = digest ^ doc.astype(np.uint64) * _PLACES[1]
    _, kept = np.unique(key, return_index=True)
    again = np.ones(n)
    again[kept] = 0
    again[words == 0] = 0

    own += [
        np.log1p(words),
        np.log1p(size),
        _share(size, words) / 10.0,
        short,
        equal,
        distinct,
        again,
        (words == 0).astype(float),
        _share(counts[:, 3] + counts[:, 4], words),
    ]
    own = np.stack(own, 1)
    begins = np.concatenate([[True], doc[1:] != doc[:-1]])[:, None]
    closes = np.concatenate([doc[1:] != doc[:-1], [True]])[:, None]
    before = np.where(begins, 0, np.concatenate([own[:1], own[:-1]]))
    after = np.where(closes, 0, np.concatenate([own[1:], own[-1:]]))
    all_ = np.concatenate([own, before, after, begins, closes, np.ones((n, 1))], 1)
    return all_.astype(np.float32), doc, size


@dataclass
class Field:
    """A fitted field. States are bad (0) and good (1)."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of features, for good against bad
    moves: np.ndarray  # between the states of neighbouring lines

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -6, 6) @ self.weights


def _forward_backward(good: np.ndarray, moves: np.ndarray, chain: np.ndarray):
    """Probability of each line being good and of each move, for chains laid end to end.

    ``chain`` numbers the chain of each line. Chains step in lockstep, longest first.
    """
    n = len(good)
    length = np.bincount(chain)
    begin = np.cumsum(length) - length
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    alive = [int(np.searchsorted(-length, -t, side="left")) for t in range(int(length.max()))]
    emit = np.stack([np.zeros(n), good], 1)
    ahead, back = np.zeros((n, 2)), np.zeros((n, 2))
    ahead[begin] = emit[begin]
    for t in range(1, len(alive)):
        at = begin[: alive[t]] + t
        ahead[at] = np.logaddexp.reduce(ahead[at - 1][:, :, None] + moves, axis=1) + emit[at]
    for t in range(len(alive) - 2, -1, -1):
        at = begin[: alive[t + 1]] + t
        back[at] = np.logaddexp.reduce(moves + (emit[at + 1] + back[at + 1])[:, None, :], axis=2)
    both = ahead + back
    marginal = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -60, 60)))
    inner = np.flatnonzero(np.concatenate([chain[1:] == chain[:-1], [False]]))
    pair = ahead[inner][:, :, None] + moves + (emit[inner + 1] + back[inner + 1])[:, None, :]
    pair -= np.logaddexp.reduce(both[inner], axis=1)[:, None, None]
    return marginal, np.exp(pair), inner


def fit_field(features: np.ndarray, label: np.ndarray, chain: np.ndarray) -> Field:
    """Maximum likelihood with a small quadratic penalty, by Adam over all lines at once."""
    mean, scale = features.mean(0), features.std(0)
    mean[-1], scale[scale < 1e-6] = 0, 1
    x = np.clip((features - mean) / scale, -6, 6).astype(np.float32)
    parameters = np.zeros(x.shape[1] + 4)
    pairs = np.flatnonzero(np.concatenate([chain[1:] == chain[:-1], [False]]))
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[pairs], label[pairs + 1]), 1)
    m, v = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, 161):
        moves = parameters[-4:].reshape(2, 2)
        marginal, pair, _ = _forward_backward(x @ parameters[:-4], moves, chain)
        gradient = np.concatenate([x.T @ (label - marginal), (seen - pair.sum(0)).ravel()])
        gradient = gradient / len(label) - 1e-4 * parameters
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        parameters += 0.08 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-9)
    return Field(mean, scale, parameters[:-4], parameters[-4:].reshape(2, 2))


def score_texts(texts: pa.Array, field: Field | None) -> np.ndarray:
    """Length-weighted mean probability of the lines of each text being good."""
    if field is None or not len(texts):
        return np.full(len(texts), 0.5)
    features, doc, size = line_features(texts)
    marginal, _, _ = _forward_backward(field.emissions(features), field.moves, doc)
    weight = size + 1.0
    total = np.bincount(doc, weight, len(texts))
    return np.clip(np.bincount(doc, weight * marginal, len(texts)) / total, 0.0, 1.0)


def _stretches(batches):
    """Features of each document's lines, in stretches: rows to fit on."""
    for batch in batches:
        for texts, labels in zip(chunks(batch["text"]), _like(batch["quality"], batch["text"])):
            features, doc, _ = line_features(texts)
            rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
            cut = np.flatnonzero((rank % STRETCH == 0))
            blobs = [part.tobytes() for part in np.split(features, cut[1:])] if len(cut) else []
            yield pa.RecordBatch.from_arrays(
                [pa.array(blobs, pa.binary()), labels.take(pa.array(doc[cut]))],
                ["features", "quality"],
            )


def _like(column: pa.Array, texts: pa.Array):
    """``column`` cut as ``chunks`` cuts ``texts``."""
    first = 0
    for part in chunks(texts):
        yield column.slice(first, len(part))
        first += len(part)


def learn(docs: DataFrame, labels: DataFrame) -> Field | None:
    """Fits the field on documents whose label the caller lets it see."""
    small_batches(docs.sparkSession)
    picked = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col("quality").cast("int")).alias("quality"))
    )
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = top_n(picked, by_hash, n=TRAIN_DOCUMENTS, per=["quality"])
    lines = (
        docs.select("doc_id", "text")
        # At most TRAIN_DOCUMENTS pairs of an id and each of the two labels.
        .join(F.broadcast(picked), "doc_id")
        .select("text", "quality")
        .mapInArrow(_stretches, "features binary, quality int")
    )
    rows = top_n(lines, [F.xxhash64("features")], n=MAX_STRETCHES, per=["quality"]).toPandas()
    rows = rows.sort_values(["quality", "features"], kind="stable", ignore_index=True)
    if rows["quality"].nunique() < 2:
        return None
    parts = [np.frombuffer(b, np.float32).reshape(-1, N_FEATURES) for b in rows["features"]]
    sizes = [len(p) for p in parts]
    chain = np.repeat(np.arange(len(parts)), sizes)
    label = np.repeat(rows["quality"].to_numpy(), sizes)
    return fit_field(np.concatenate(parts), label, chain)


def quality(text: Column, field: Field | None) -> Column:
    """The score of each text."""

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        parts = [score_texts(part, field) for part in chunks(texts)]
        return pa.array(np.concatenate(parts) if parts else np.empty(0))

    return score(text)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs``; fold 0 of 5 is not learnt."""
    seen = labels.where(~fold_is(5, 0)).select("doc_id", "quality")
    score = quality(F.col("text"), learn(docs, seen))
    return docs.select(
        "doc_id", fold_is(5, 0).alias("held_out"), score.alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that are predicted to be good, with all their columns."""
    seen = labels.where(~fold_is(5, 0)).select("doc_id", "quality")
    return docs.where(quality(F.col("text"), learn(docs, seen)) >= threshold)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
