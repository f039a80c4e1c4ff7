"""Language-model scores by a hierarchical Pitman-Yor model.

Restaurants form a tree. After each word of the training text there is one for the words that follow it
(``word_contexts``); a table there is a customer of the words' own restaurant, the parent of all. A table
of that one is a draw from a base distribution that spells words. The speller is a hierarchy of
restaurants too, one for each context of up to three characters, and a context's parent is the context
without its oldest character. So a word is judged by the word before it, then by itself, then by its
spelling, each as far as the level before has not seen it.

Like the base score, the model tells training words from each other and from words that are none of
them, which are one event: its probability is that of a new table with a spelling that is not a
training word's. Probabilities of training words and of that event sum to one after every word.

Seating is sampled level by level, given the others, a dish's customers at a time (``seating``):

* the tables after each word, given the words' shares of the text, twice over;
* the words' tables in sweeps that alternate with the speller's, each word apart given the totals of the
  last sweep. Uniform numbers are a hash of the word and the sweep, so a task that is run again
  seats it alike;
* the speller's tables over counts per context and character. Contexts are made of 32 classes of
  bytes, so there are at most 32**3 * 256 counts however large the corpus is: that bound is what
  lets them be summed at the driver and broadcast. Everything else grows with the corpus and stays
  distributed.

A probability is the mean over the sampled seatings of its predictive probability.

Counts cover all training documents. Words and pairs of words travel once for each block of documents
that has them, pairs as numbers. Null and empty texts are an end only; very long ones are scored whole. An empty table gives
no rows; one without training documents scores by the uniform base. Repeated rows count each. Ties do
not arise. Only ``doc_id`` and ``text`` are read, so further columns may have any name.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skymetrics.llm import blocks, word_contexts
from skymetrics.llm.common import documents, fold_is, stored
from skymetrics.llm.seating import seat

END = b""  # the end of a text, a token that no word equals

SWEEPS = 4
SAMPLED = 2  # of the last sweeps
SPELLER_SWEEPS = 4
SPELLER_DISCOUNT, SPELLER_STRENGTH = (0.3, 0.5, 0.6, 0.7), (1.0, 2.0, 2.0, 2.0)
STRENGTH = 10.0

DEPTH = 3
CLASSES = 32
CONTEXTS = CLASSES**DEPTH
_STOP = 0x20  # what a spelling ends with; no word has a blank

# Classes of bytes as context: letters each, digits, signs, and three kinds of bytes beyond ASCII.
# Zero is the start of a word.
_CLASS = np.full(256, 28, np.int64)
_CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASS[ord("0") : ord("9") + 1] = 27
_CLASS[0x80:0xA0], _CLASS[0xA0:0xC0], _CLASS[0xC0:] = 29, 30, 31


def spelling(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(cells, word): the context and character of each step of each word, and whose step it is."""
    words = words.cast(pa.large_binary())
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int64)[words.offset : words.offset + len(words) + 1]
    body = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else np.empty(0, np.uint8)
    ends = ends - ends[0]
    steps = np.insert(body, ends[1:], _STOP)
    begin = ends[:-1] + np.arange(len(words))
    size = np.diff(ends) + 1
    word = np.repeat(np.arange(len(words)), size)
    age = np.arange(len(steps)) - np.repeat(begin, size)
    kind = _CLASS[steps]
    context = np.zeros(len(steps), np.int64)
    for back in range(1, DEPTH + 1):
        before = np.concatenate([np.zeros(min(back, len(kind)), np.int64), kind[:-back]])[: len(kind)]
        context += np.where(age >= back, before, 0) * CLASSES ** (back - 1)
    return context * 256 + steps, word


# Cells and what those seated there give them; what each context passes on to its parent.
State = tuple[np.ndarray, np.ndarray, np.ndarray]


class Restaurants:
    """The restaurants of one context length: customers and tables of each cell that has any."""

    def __init__(self, level: int, cells: np.ndarray, customers: np.ndarray):
        self.level, self.width = level, CLASSES**level
        self.discount, self.strength = SPELLER_DISCOUNT[level], SPELLER_STRENGTH[level]
        self.cells, self.context = cells, cells // 256
        self.customers, self.tables = customers, np.minimum(customers, 1)

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.bincount(self.context, values, self.width)

    def parent(self) -> "Restaurants":
        """The next shorter contexts: a context without its oldest class is a remainder."""
        cells, at = np.unique(self.cells % (256 * CLASSES ** (self.level - 1)), return_inverse=True)
        return Restaurants(self.level - 1, cells, np.bincount(at, self.tables, len(cells)).astype(np.int64))

    def seat(self, above: np.ndarray, rng: np.random.Generator) -> None:
        base = above.ravel()[self.cells % above.size].astype(float)
        key = rng.integers(0, 1 << 63, len(self.cells)).astype(np.uint64)
        others = self.sums(self.tables)[self.context] - self.tables
        self.tables = seat(self.customers, base, others, self.discount, self.strength, key)

    def state(self) -> State:
        """What the seated give to each cell, and each context to its parent."""
        all_ = self.strength + self.sums(self.customers)
        share = (self.strength + self.discount * self.sums(self.tables)) / all_
        known = np.maximum(self.customers - self.discount * self.tables, 0) / all_[self.context]
        return self.cells.astype(np.int32), known.astype(np.float32), share.astype(np.float32)


_UNIFORM = np.full((1, 256), 1 / 256, np.float32)


def _predict(state: State, above: np.ndarray) -> np.ndarray:
    """Probability of each character after each context, given the parents'."""
    cells, known, share = state
    found = np.tile(above, (max(1, len(share) // len(above)), 1)) * share[:, None]
    found.ravel()[cells] += known
    return found


def speller_table(samples: list[list[State]]) -> np.ndarray:
    """Log10 predictive probability of each character after each context, mean over samples."""
    mean = np.zeros((CONTEXTS, 256), np.float32)
    for levels in samples:
        last = _UNIFORM
        for state in levels:
            last = _predict(state, last)
        mean += last / len(samples)
    return np.log10(mean)


def train_speller(cells: np.ndarray, customers: np.ndarray, seed: int = 0) -> list[list[State]]:
    """The states of the restaurants in the sampled sweeps, shortest context first.

    ``cells`` are numbers of a deepest context and a character, each with its customers.
    """
    rng = np.random.default_rng(seed)
    levels = [Restaurants(DEPTH, cells, customers)]
    while levels[0].level:
        levels.insert(0, levels[0].parent())
    samples = []
    for sweep in range(SPELLER_SWEEPS):
        above = [_UNIFORM]
        for level in levels[:-1]:
            above.append(_predict(level.state(), above[-1]))
        # Deepest first, each given its parents of the last sweep; its tables are their customers.
        for depth in range(DEPTH, -1, -1):
            levels[depth].seat(above[depth], rng)
            if depth:
                parent = levels[depth].parent()
                parent.tables = np.minimum(levels[depth - 1].tables, parent.customers)
                levels[depth - 1] = parent
        if sweep >= SPELLER_SWEEPS // 2:
            samples.append([level.state() for level in levels])
    return samples


def _spelt(words: pa.Array, speller: np.ndarray) -> np.ndarray:
    """Log10 probability of the spelling of each word."""
    cells, word = spelling(words)
    return np.bincount(word, speller.ravel()[cells], len(words))


def _keys(batch: pa.RecordBatch, sweep: int) -> np.ndarray:
    salt = np.uint64((sweep + 1) * 0xD1B54A32D192ED03 & (1 << 64) - 1)
    return batch["hash"].to_numpy().astype(np.int64).view(np.uint64) ^ salt


def _seated(batch: pa.RecordBatch, speller: np.ndarray | None, tables: int, discount: float, sweep: int):
    """Tables of each word, and the probability of its spelling; without a speller, one table each."""
    counts = batch["c"].to_numpy()
    if speller is None:
        return np.minimum(counts, 1), None
    base = 10.0 ** _spelt(batch["word"], speller)
    return seat(counts, base, tables, discount, STRENGTH, _keys(batch, sweep)), base


def _sweep(speller, tables: int, discount: float, sweep: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Seats the words of a task; yields customers of the speller, and tables as cell -1."""
        found, total = np.zeros(CONTEXTS * 256, np.int32), 0
        shared = None if speller is None else speller_table(speller.value)
        for batch in batches:
            seated, _ = _seated(batch, shared, tables, discount, sweep)
            total += int(seated.sum())
            cells, word = spelling(batch["word"])
            some, at = np.unique(cells, return_inverse=True)
            found[some] += np.bincount(at, seated[word]).astype(np.int32)
        cells = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(cells, -1)), pa.array(np.append(found[cells], total).astype(np.int64))],
            ["cell", "n"],
        )

    return step


def _known_mass(spellers: list):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """What the spellers give to the training words of a task."""
        mass, tables = np.zeros(len(spellers)), [speller_table(s.value) for s in spellers]
        for batch in batches:
            known = batch["c"].to_numpy() > 0
            mass += [(10.0 ** _spelt(batch["word"], table)[known]).sum() for table in tables]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(spellers)), pa.int32()), pa.array(mass)], ["i", "mass"])

    return step


def _valued(samples: list[tuple], discount: float, total: int):
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}

        def table(speller) -> np.ndarray:
            """A speller follows one sample and is the ground of the next."""
            if id(speller) not in made:
                made[id(speller)] = speller_table(speller.value)
            return made[id(speller)]

        for batch in batches:
            counts, mean = batch["c"].to_numpy(), 0.0
            for speller, before, tables, sweep, mass in samples:
                # Seated as in that sweep: by the speller and the totals that it had.
                ground = (table(before[0]), before[1]) if before else (None, 0)
                seated, _ = _seated(batch, *ground, discount, sweep)
                base = np.where(counts > 0, 10.0 ** _spelt(batch["word"], table(speller)), 1 - mass)
                known = np.maximum(counts - discount * seated, 0)
                mean = mean + (known + (STRENGTH + discount * tables) * base) / (STRENGTH + total)
            value = np.log10(np.maximum(mean / len(samples), 1e-300))
            kept = [name for name in batch.schema.names if name != "hash"]
            yield pa.RecordBatch.from_arrays([*(batch[name] for name in kept), pa.array(value)], [*kept, "value"])

    return step


def word_values(vocabulary: DataFrame, total: int) -> DataFrame:
    """(word, c, ..., value): log10 probability of each word of (word, c, ...), stored."""
    spark = vocabulary.sparkSession
    once = vocabulary.agg(F.count(F.when(F.col("c") == 1, 1)), F.count(F.when(F.col("c") == 2, 1))).first()
    discount = float(np.clip(once[0] / max(once[0] + 2 * once[1], 1), 0.1, 0.95))
    hashed = vocabulary.select("*", F.xxhash64("word").alias("hash"))
    before, samples = None, []
    for sweep in range(SWEEPS):
        step = _sweep(before and before[0], before[1] if before else 0, discount, sweep)
        # At most CONTEXTS * 256 rows.
        sums = hashed.mapInArrow(step, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
        tables = int(sums.loc[sums["cell"] < 0, "n"].sum())
        sums = sums[sums["cell"] >= 0].sort_values("cell")
        cells, customers = (sums[c].to_numpy().astype(np.int64) for c in ("cell", "n"))
        speller = spark.sparkContext.broadcast(train_speller(cells, customers, sweep))
        if sweep >= SWEEPS - SAMPLED:
            samples.append((speller, before, tables, sweep))
        before = (speller, tables)
    mass = hashed.mapInArrow(_known_mass([s[0] for s in samples]), "i int, mass double").groupBy("i").agg(F.sum("mass"))
    masses = {i: min(float(m), 1 - 1e-9) for i, m in mass.collect()}
    samples = [(*sample, masses.get(i, 0.0)) for i, sample in enumerate(samples)]
    schema = f"{vocabulary.schema.toDDL()}, value double"
    return stored(hashed.mapInArrow(_valued(samples, discount, total), schema), "values")


def _scored(total: int, distinct: int, buckets: int, hot: np.ndarray, rest_of_hot: dict[int, float]):
    def score(block: pa.Table, sides: pa.Table) -> pa.Table:
        row = word_contexts.of_block(block["file"][0].as_py())
        of_words = sides.filter(pc.is_valid(sides["numbers"]))
        returned = sides.filter(pc.is_valid(sides["bucket"])).select(["bucket", "own", "rest"]).to_pylist()
        ids, counts = word_contexts.listed(of_words)
        value = word_contexts.listed_values(of_words)
        pairs = word_contexts.Pairs(row, ids)
        own, rest = word_contexts.following(pairs, returned, buckets, hot, rest_of_hot)
        likely = np.log10(own + rest * 10.0 ** value[pairs.second])
        base = np.log10((counts + 1) / (total + distinct + 1))
        n = len(row["sizes"])
        return pa.table(
            {
                "doc_id": pa.array(row["doc_ids"], pa.int64()),
                "held_out": pa.array([not f for f in row["flags"]], pa.bool_()),
                "n_tokens": np.array(row["sizes"], np.int64),
                "n_known": np.bincount(pairs.doc, counts[pairs.places] > 0, n).astype(np.int64),
                "train_tokens": np.full(n, total),
                "base_score": np.bincount(pairs.doc, base[pairs.places], n),
                "score": np.bincount(pairs.doc, likely[pairs.at], n),
            }
        )

    return score


_RESULT = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score(docs: DataFrame) -> DataFrame:
    """Base and model score of every row of ``docs``; fold 2 of 7 is not learnt from."""
    held = word_contexts.build(docs, ~fold_is(7, 2), END)
    known, vocabulary = word_contexts.number_words(held)
    total, distinct, texts = vocabulary.agg(
        F.coalesce(F.sum("c"), F.lit(0)),
        F.count(F.when(F.col("c") > 0, 1)),
        F.coalesce(F.sum(F.when(F.col("word") == F.lit(END), F.col("c"))), F.lit(0)),
    ).first()
    contexts = word_contexts.Contexts(held, known, vocabulary, total, texts)
    # Customers of the words' restaurant are the tables of the contexts'.
    customers = vocabulary.drop("c").join(contexts.parent, "id", "left").select(
        "word", F.coalesce("tables", F.lit(0)).alias("c"), "id", "bucket"
    )
    customers = stored(customers, "customers")
    values = word_values(customers, customers.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0])
    valued = word_contexts.with_values(known, values)
    sides = valued.unionByName(contexts.returned, allowMissingColumns=True)
    scored = _scored(total, distinct, contexts.buckets, contexts.hot, contexts.rest_of_hot)
    return blocks.files(held).groupBy("block").cogroup(sides.groupBy("of")).applyInArrow(scored, _RESULT)


def op9_pitman_yor_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir))
