"""Licences named in texts: notice phrases, identifier tags and licence expressions.

One Aho-Corasick automaton finds every notice phrase and identifier tag among the words of a text.
What follows a tag on its line is a licence expression; a shunting-yard parser turns it into
postfix form, which is evaluated to the licences it names and how freely the text may be used: of
both sides of AND the stricter, of OR the freer, WITH an exception never stricter.

Words are runs of letters, digits and all that isn't ASCII, with A-Z in lower case. Null texts are
empty. Texts without a finding have no labels, empty strings, null places and score 0. A tag whose
expression doesn't parse counts as an unknown licence. Very long texts are scanned whole, repeated rows
alike. Ties do not arise. An empty table gives no rows. Only ``doc_id`` and ``text`` are read, so further columns
may have any name.
"""

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from skymetrics.llm.common import documents, small_batches

# Base phrases and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Other notices, with the label and how sure each is.
OTHER_PHRASES = {
    "released under the mit license": ("mit", 0.9),
    "permission is hereby granted free of charge": ("mit", 0.8),
    "the software is provided as is without warranty": ("mit", 0.5),
    "licensed under the apache license": ("apache-2", 0.9),
    "gnu general public license version 2": ("gpl-2", 0.9),
    "gnu general public license version 3": ("gpl-3", 0.9),
    "gnu general public license": ("gpl", 0.7),
    "gnu lesser general public license": ("lgpl", 0.9),
    "gnu affero general public license": ("agpl", 0.9),
    "mozilla public license": ("mpl-2", 0.9),
    "redistribution and use in source and binary forms": ("bsd", 0.8),
    "bsd license": ("bsd", 0.7),
    "creative commons attribution noncommercial": ("cc-by-nc", 0.9),
    "creative commons attribution sharealike": ("cc-by-sa", 0.9),
    "creative commons attribution": ("cc-by", 0.7),
    "cc by sa": ("cc-by-sa", 0.8),
    "cc by nd": ("cc-by-nd", 0.8),
    "cc0 1 0": ("cc0", 0.8),
    "public domain": ("public-domain", 0.4),
    "all rights reserved": ("all-rights-reserved", 0.6),
}
TAG = "spdx license identifier"
BASE_SCORE = 0.9
TAG_SCORE = 1.0

# How freely a licence lets a text be used, by the first family that its label is of.
FREEDOM = {
    "mit": 1.0,
    "apache": 1.0,
    "bsd": 1.0,
    "isc": 1.0,
    "cc0": 1.0,
    "unlicense": 1.0,
    "public-domain": 1.0,
    "cc-by-nc": 0.2,
    "cc-by-nd": 0.3,
    "cc-by-sa": 0.6,
    "cc-by": 0.9,
    "mpl": 0.7,
    "lgpl": 0.6,
    "agpl": 0.4,
    "gpl": 0.5,
    "all-rights-reserved": 0.0,
}
UNKNOWN = "unknown"
UNKNOWN_FREEDOM = 0.1
WITH_EXCEPTION = 0.6

_TAG_LINE = re.compile(r"SPDX[^A-Za-z0-9\n]*License[^A-Za-z0-9\n]*Identifier[ \t]*:?([^\n]*)", re.ASCII | re.IGNORECASE)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+-]+")
_RANK = {"OR": 1, "AND": 2, "WITH": 3}
# Lower case for A-Z, space for what isn't part of a word; bytes from 0x80 on are.
_WORDS = bytes(
    b if b >= 0x80 or chr(b).isalnum() and not chr(b).isupper() else b + 32 if chr(b).isupper() else 0x20
    for b in range(256)
)


def label_of(identifier: str) -> str:
    """Label of a licence identifier: lower case, without a minor version or what follows it."""
    name = identifier.lower().rstrip("+")
    name = re.sub(r"-(only|or-later)$", "", name)
    name = re.sub(r"^(cc-by(-nc|-sa|-nd)*|cc0)-\d.*$", r"\1", name)
    return re.sub(r"(-\d+)(\.\d+)+$", r"\1", name)


def freedom_of(label: str) -> float:
    for family, value in FREEDOM.items():
        if label == family or label.startswith(f"{family}-"):
            return value
    return UNKNOWN_FREEDOM


def postfix(expression: str) -> list[str] | None:
    """Postfix form of a licence expression, None if it is none. Operators need upper or lower case.

    What follows the expression on its line, such as the end of a comment, is left out.
    """
    output: list[str] = []
    operators: list[str] = []
    operand_next = True
    for token in _TOKEN.findall(expression):
        word = token.upper() if token.upper() in _RANK and token in (token.upper(), token.lower()) else None
        if operand_next:
            if token == "(":
                operators.append(token)
                continue
            if word or token == ")" or not any(c.isalnum() for c in token):
                return None
            output.append(token)
            operand_next = False
        elif word:
            while operators and operators[-1] != "(" and _RANK[operators[-1]] >= _RANK[word]:
                output.append(operators.pop())
            operators.append(word)
            operand_next = True
        elif token == ")" and "(" in operators:
            while operators[-1] != "(":
                output.append(operators.pop())
            operators.pop()
        else:
            break
    if operand_next or "(" in operators:
        return None
    return output + operators[::-1]


def evaluate(expression: str) -> tuple[set[str], float]:
    """Labels that an expression names, and how freely it lets a text be used."""
    tokens = postfix(expression)
    if tokens is None:
        return {UNKNOWN}, UNKNOWN_FREEDOM
    stack: list[tuple[set[str], float]] = []
    for token in tokens:
        if token not in _RANK:
            label = label_of(token)
            stack.append(({label}, freedom_of(label)))
            continue
        (right, b), (left, a) = stack.pop(), stack.pop()
        if token == "WITH":
            stack.append((left, max(a, WITH_EXCEPTION)))
        else:
            stack.append((left | right, min(a, b) if token == "AND" else max(a, b)))
    return stack[0]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    phrases = {p: (p, label, BASE_SCORE, True) for p, label in BASE_PHRASES.items()}
    phrases |= {p: (p, label, score, False) for p, (label, score) in OTHER_PHRASES.items()}
    phrases[TAG] = (TAG, None, TAG_SCORE, False)
    for phrase, entry in phrases.items():
        found.add_word(f" {phrase} ", entry)
    found.make_automaton()
    return found


def scan(text: str | None, phrases: ahocorasick.Automaton) -> dict:
    """Findings of one text."""
    text = text or ""
    # Word by word, a lone surrogate is still a word.
    words = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    joined = f" {b' '.join(words).decode('utf-8', 'surrogatepass')} "
    places, base, labels, score, freedom = [], set(), set(), 0.0, []
    seen, last = 0, 0  # words up to the end of the last finding
    for end, (phrase, label, sure, is_base) in phrases.iter(joined):
        seen, last = seen + joined.count(" ", last, end), end
        score = max(score, sure)
        if label is None:
            continue
        labels.add(label)
        freedom.append(freedom_of(label))
        if is_base:
            base.add(label)
            places.append(seen - phrase.count(" ") - 1)
    if score == TAG_SCORE:
        for expression in _TAG_LINE.findall(text):
            named, free = evaluate(expression)
            labels |= named
            freedom.append(free)
    return {
        "n_words": len(words),
        "n_base": len(places),
        "first_word": min(places, default=None),
        "last_word": max(places, default=None),
        "base_labels": ",".join(sorted(base)),
        "labels": ",".join(sorted(base | labels)),
        "score": score,
        "freedom": min(freedom, default=None),
    }


_FIELDS = (
    "n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, freedom double"
)


def licences(text: Column) -> Column:
    """Struct of the findings of each text; ``freedom`` is that of the strictest licence found."""
    cell = []

    @arrow_udf(_FIELDS)
    def found(texts: pa.Array) -> pa.Array:
        if not cell:
            cell.append(automaton())
        kind = pa.struct(
            [(n, {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}[t])
             for n, t in (field.split() for field in _FIELDS.split(", "))]
        )
        return pa.array([scan(t.as_py(), cell[0]) for t in texts], kind)

    return found(text)


def scan_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, findings) of every row of ``docs``."""
    small_batches(docs.sparkSession)
    return docs.select("doc_id", licences(F.col("text")).alias("found")).select("doc_id", "found.*")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_documents(documents(spark, sf_dir))
