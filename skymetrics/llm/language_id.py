"""Language of texts, word first: known words vote by their frequency per language.

A word that was not learnt is judged by its character n-grams, the longest that are known: those
of five characters, else of four, and so on. Words are runs of letters, in lower case.

The tables are fitted on a bounded sample of the labelled documents of each language, so a rare one is
learnt as well as a frequent one; how frequent each is counts over all labelled documents. Null texts
and texts without a letter are ``und`` with score 0; so is every text if nothing was learnt, as from an
empty table. Very long texts are judged whole. Repeated rows are judged alike. Ties go to the language with
more labelled documents, then to the first by code point. Only ``doc_id``, ``text`` and ``lang`` are read, so
further columns may have any name.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skymetrics.llm.common import documents, fold_is, small_batches
from skymetrics.operators.ranking import top_n

# Bound of the fitting sample of each language, by hash of the id.
TRAIN_DOCUMENTS = 600
LONGEST_GRAM = 5
UNKNOWN = "und"

_LETTERS = re.compile(r"[^\W\d_]+")
_CACHE_LIMIT = 200_000


def _grams(word: str, n: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i : i + n] for i in range(len(padded) - n + 1)]


def _log_shares(counts: dict[str, np.ndarray], prior: float) -> tuple[dict[str, int], np.ndarray]:
    """Rows of keys, and the log share of each key in each language, smoothed by ``prior``."""
    rows = {key: i for i, key in enumerate(sorted(counts))}
    table = np.stack([counts[key] for key in rows]) + prior
    return rows, np.log(table / table.sum(0))


def learn(docs: DataFrame):
    """(languages, log prior, words, n-grams by length) of the labelled rows of ``docs``."""
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    named = labelled.where(F.col("doc_id").isNotNull())
    # One row for each language.
    sizes = {r["lang"]: r["count"] for r in named.groupBy("lang").count().collect()}
    if not sizes:
        return None
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = top_n(named.select("lang", "doc_id").distinct(), order, n=TRAIN_DOCUMENTS, per=["lang"])
    sample = named.select("doc_id", "lang", "text").join(picked, ["lang", "doc_id"], "semi")
    languages = sorted(sizes, key=lambda name: (-sizes[name], name))
    words = sample.select(
        "lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), 0)).alias("word")
    )
    # One row for each word of the sample, which is bounded.
    table = words.groupBy("lang", "word").count().toPandas()
    by_word: dict[str, np.ndarray] = {}
    grams: list[dict[str, np.ndarray]] = [{} for _ in range(LONGEST_GRAM + 1)]
    place = {name: i for i, name in enumerate(languages)}
    width = len(languages)
    for lang, word, count in zip(table["lang"], table["word"], table["count"]):
        i = place[lang]
        by_word.setdefault(word, np.zeros(width))[i] += count
        for n in range(1, LONGEST_GRAM + 1):
            for gram in _grams(word, n):
                grams[n].setdefault(gram, np.zeros(width))[i] += count
    if not by_word:
        return None
    prior = np.log(np.array([sizes[name] for name in languages]) / sum(sizes.values()))
    tables = [None] + [_log_shares(g, 0.5) if g else ({}, np.zeros((0, width))) for g in grams[1:]]
    return languages, prior, _log_shares(by_word, 0.1), tables


def _unseen(word: str, tables, width: int) -> np.ndarray:
    """Mean log share of the longest known n-grams of a word."""
    for n in range(LONGEST_GRAM, 0, -1):
        rows, shares = tables[n]
        known = [rows[g] for g in _grams(word, n) if g in rows]
        if known:
            return shares[known].mean(0)
    return np.zeros(width)


class _Words(dict):
    """Rows of words; those not learnt are judged once and kept until there are too many."""

    def __init__(self, model):
        _, self.prior, (rows, shares), self.tables = model
        super().__init__(rows)
        self.learnt, self.start = rows, len(shares)
        self.shares = np.concatenate([shares, np.zeros((_CACHE_LIMIT, shares.shape[1]))])
        self.next = self.start

    def __missing__(self, word: str) -> int:
        row = self.next
        self.shares[row] = _unseen(word, self.tables, self.shares.shape[1])
        self[word] = row
        self.next += 1
        return row

    def rows_of(self, words: list[str]) -> np.ndarray:
        """Evidence of a text: the sum over its words."""
        total, step = np.zeros(self.shares.shape[1]), _CACHE_LIMIT // 2
        for i in range(0, len(words), step):
            if self.next + step > len(self.shares):
                self.clear()
                self.update(self.learnt)
                self.next = self.start
            part = words[i : i + step]
            total += self.shares[np.fromiter(map(self.__getitem__, part), np.int64, len(part))].sum(0)
        return total


def judge(text: str | None, known: _Words, languages: list[str]) -> tuple[str, float]:
    words = _LETTERS.findall(text.lower()) if text else []
    if not any(c.isalpha() for word in words for c in word):
        return UNKNOWN, 0.0
    evidence = known.rows_of(words) / np.sqrt(len(words)) + 1e-3 * known.prior
    share = np.exp(evidence - evidence.max())
    best = int(share.argmax())
    return languages[best], float(1.0 / share.sum())


def identify(text: Column, model) -> Column:
    """Struct (lang, score) of each text."""
    cell = []

    @arrow_udf("lang string, score double")
    def language(texts: pa.Array) -> pa.Array:
        if model is None:
            found = [(UNKNOWN, 0.0)] * len(texts)
        else:
            if not cell:
                cell.append(_Words(model))
            found = [judge(text.as_py(), cell[0], model[0]) for text in texts]
        langs, scores = zip(*found) if found else ((), ())
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang", "score"]
        )

    return language(text)


def _model(docs: DataFrame):
    small_batches(docs.sparkSession)
    return learn(docs.where(~fold_is(3, 1)))


def predict(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; fold 1 of 3 is not learnt from."""
    found = identify(F.col("text"), _model(docs))
    return docs.select("doc_id", fold_is(3, 1).alias("held_out"), found.alias("found")).select(
        "doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score"
    )


def keep(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows whose language is told with a score of ``least`` or more, with all columns."""
    found = identify(F.col("text"), _model(docs))
    return docs.where((found["lang"] != UNKNOWN) & (found["score"] >= least))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict(documents(spark, sf_dir))
