"""Licence scan, quality rules and token files beside plain Python."""

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skymetrics.llm import license_scan, quality_rules, token_files
from skymetrics.plans.session import scratch_folder
from tests.llm.helpers import found, prose, rows, table

import random

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENCE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- licences --------------------------------------------------------------------------------

NOTICES = [
    "Under the MIT License, under-the (mit) license!",
    "under the mit licenses",
    "Apache License, Version 2.0\ncc by-nc CC  BY NC by nc",
    "// SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH Classpath-exception-2.0 */",
    "SPDX-License-Identifier: AND OR",
    "SPDX-License-Identifier:",
    "under the mit license " * 400,
    "x\x00under\x00the\x00mit\x00license\x7f{} éunder the mit license",
]


def base_of(text):
    words = LICENCE_WORD.findall(lowered(text))
    places, labels = [], set()
    for phrase, label in license_scan.BASE_PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_base_phrases_equal_brute_force(spark):
    data = rows() + [(1000 + i, text, "en", "s", 1) for i, text in enumerate(NOTICES)]
    got = found(license_scan.scan_documents(table(spark, data)), "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    want = [(d[0], *base_of(d[1])) for d in data]
    assert got == sorted(want, key=lambda r: tuple((v is None, str(v)) for v in r))


def test_labels_and_scores(spark):
    data = [(i, text, "en", "s", 1) for i, text in enumerate(NOTICES)]
    out = {r.doc_id: r for r in license_scan.scan_documents(table(spark, data)).collect()}
    assert out[3].labels == "apache-2,gpl-2,mit" and out[3].score == 1.0
    assert out[4].labels == out[5].labels == "unknown"
    assert out[1].labels == "" and out[1].score == 0.0 and out[1].freedom is None
    assert set(out[2].base_labels.split(",")) <= set(out[2].labels.split(","))
    assert all(0 <= r.score <= 1 for r in out.values())


@pytest.mark.parametrize(
    ("expression", "postfix"),
    [
        ("MIT", ["MIT"]),
        ("A OR B AND C", ["A", "B", "C", "AND", "OR"]),
        ("(A or B) and C", ["A", "B", "OR", "C", "AND"]),
        ("A WITH e OR B", ["A", "e", "WITH", "B", "OR"]),
        ("((A))", ["A"]),
        ("MIT */", ["MIT"]),
        ("(A OR", None),
        ("(A", None),
        ("", None),
        ("OR A", None),
    ],
)
def test_expressions(expression, postfix):
    assert license_scan.postfix(expression) == postfix


def test_stricter_and_freer_sides():
    assert license_scan.evaluate("MIT OR GPL-3.0-only") == ({"mit", "gpl-3"}, 1.0)
    assert license_scan.evaluate("MIT AND GPL-3.0-only") == ({"mit", "gpl-3"}, 0.5)
    assert license_scan.evaluate("GPL-2.0+ WITH X") == ({"gpl-2"}, 0.6)


# -- quality rules ---------------------------------------------------------------------------


def rules_of(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            covered |= set(range(i, i + 5))
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, repeated, len(covered), failed


def messy(n=40):
    rng = random.Random(3)
    made = []
    for i in range(n):
        lines = [" ".join(rng.choices("a b c dd é #x |".split(), k=rng.randint(0, 9))) for _ in range(rng.randint(0, 9))]
        made.append((2000 + i, "\n".join(lines) + rng.choice(["", "\n", " ", "\t"]), "en", "s", 1))
    passage = prose(rng, "en", 40)
    made.append((2100, passage + " and so on " + passage, "en", "s", 1))
    made.append((2101, "the same words " * 3000, "en", "s", 1))
    made.append((2102, "a b c d", "en", "s", 1))
    made.append((2103, "a a a a a", "en", "s", 1))
    made.append((2104, "a a a a a a", "en", "s", 1))
    return made


def test_rules_equal_brute_force(spark):
    data = rows() + messy()
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    out = quality_rules.judge(table(spark, data))
    assert found(out, *columns) == sorted(((d[0], *rules_of(d[1])) for d in data), key=lambda r: tuple((v is None, str(v)) for v in r))
    for r in out.collect():
        assert not (r.kept and r.base_failed)
        assert (r.kinds_distance is None) == (r.n_words < quality_rules.COMPARED_WORDS)


def test_distance_is_the_definition(spark):
    rng = random.Random(5)
    pairs = [([rng.choice([0, 1, 7, 30]) for _ in range(6)], [rng.choice([0, 2, 9]) for _ in range(6)]) for _ in range(50)]
    pairs += [([1, 0], [0, 1]), ([2, 2], [5, 5]), ([0, 0], [1, 1])]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a array<long>, b array<long>")
    got = {r.i: r.d for r in df.select("i", quality_rules.distance(df.a, df.b).alias("d")).collect()}
    for i, (a, b) in enumerate(pairs):
        if not sum(a) or not sum(b):
            assert got[i] is None
            continue
        p, q = np.array(a) / sum(a), np.array(b) / sum(b)
        m = (p + q) / 2
        with np.errstate(all="ignore"):
            parts = [np.nansum(np.where(x > 0, x * np.log2(x / m), 0)) for x in (p, q)]
        assert got[i] == pytest.approx(np.sqrt(max(0, sum(parts) / 2)), abs=1e-9)


def test_junk_goes_and_prose_stays(spark):
    rng = random.Random(9)
    data = [(i, prose(rng, "en", 150), "en", "s", 1) for i in range(60)]
    data += [(100 + i, prose(rng, "en", 150).upper().replace(" ", "!! "), "en", "s", 1) for i in range(6)]
    kept = {r.doc_id for r in quality_rules.judge(table(spark, data)).where("kept").collect()}
    assert kept == set(range(60))


# -- token files -----------------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_files_give_back_the_ids(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_IDS", 3000)
    data = rows() + [(3, "other text of an id", "en", "s", 1)]
    docs, folder = table(spark, data), token_files.qualified(spark, f"{tmp_path}/tokens")
    listed = token_files.write(docs, folder, PATH)
    got = [tuple(r) for r in token_files.read(spark, folder, listed).collect()]
    assert listed.count() > 3
    tokenizer = Tokenizer.from_file(PATH)
    want = []
    for doc_id, text, *_ in data:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        want.append((doc_id, len(ids), zlib.crc32(ids.tobytes())))
    got.sort(key=lambda r: r[1])
    ids = [(r[0] is not None, r[0]) for r in got]
    assert ids == sorted(ids, key=lambda k: (k[0], k[1] or 0))
    assert sorted(map(repr, ((r[0], *r[2:]) for r in got))) == sorted(map(repr, want))
    assert [r[1] for r in got] == [sum(r[2] for r in got[:i]) for i in range(len(got))]


ODD = ["İ", "Σ", "ΑΣ", "ß", "e\u0301", "\u0301", "'s", "'T", "!!", "...", "a.", "B,", "é!", "9.", "9'", "#", " ", "\n",
       "\x1c", "\x85", "\xa0", "\u2028", "<|endoftext|>", "<|ENDOFTEXT|>", "東", "\u200d", "K", "½", "_"]


@given(st.one_of(st.text(st.characters(exclude_categories=["Cs"])), st.lists(st.sampled_from(ODD)).map("".join)))
@settings(max_examples=1500, deadline=None)
def test_words_encode_as_whole_texts(text):
    encoder = _encoder()
    ids = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
    assert ids == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def _encoder(cell=[]):  # noqa: B006
    if not cell:
        cell.append(token_files.Encoder(PATH))
    return cell[0]


@given(st.integers(1, 32), st.lists(st.integers(0, 2**32 - 1), max_size=200), st.integers(1, 40))
@settings(max_examples=200, deadline=None)
def test_packing_and_random_access(bits, values, block):
    values = np.array([v & (1 << bits) - 1 for v in values], np.uint32)
    assert token_files.unpack(token_files.pack(values, bits), bits, len(values)).tolist() == values.tolist()
    cut = len(values) // 3
    file = token_files.TokenFile(token_files.write_file([4, None], [values[:cut], values[cut:]], bits, block))
    assert file.doc_ids == [4, None]
    assert file.document(0).tolist() == values[:cut].tolist() and file.document(1).tolist() == values[cut:].tolist()
    for a in range(0, len(values), 7):
        assert file.read(a, min(a + 5, len(values))).tolist() == values[a : a + 5].tolist()


def test_empty_tables(spark):
    docs = table(spark, [])
    assert license_scan.scan_documents(docs).count() == 0
    assert quality_rules.judge(docs).count() == 0
    folder = token_files.qualified(spark, scratch_folder(spark, "tokens"))
    assert folder.startswith("file:///")
    assert token_files.read(spark, folder, token_files.write(docs, folder, PATH)).count() == 0
