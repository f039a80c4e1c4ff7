"""Phrases counted in quotient filters beside plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import connect, rows as plain
from skymetrics.llm import phrase_mining as mining
from skymetrics.llm.oracle import ORACLE
from skymetrics.llm.queries import QUERIES
from tests.llm.helpers import prose, rows, table


def by_hand(docs, longest=4, least=30, most=2000):
    """All phrases counted in a dictionary, cut and covered as the contract says."""
    counts, totals = {}, Counter()
    for lang, text in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            of = counts.setdefault(lang or "und", Counter())
            totals[lang or "und"] += len(words)
            for m in range(1, longest + 1):
                of.update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    found = []
    for lang, f in counts.items():
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        covered = set()
        for p, a in cands.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    if 100 * a >= 80 * f[p[i : i + m]]:
                        covered.add(p[i : i + m])
        scored = []
        for p, a in cands.items():
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            if p not in covered:
                scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:most], 1):
            found.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def answers(found):
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert [t for _, t in found.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    return sorted(tuple(r) for r in found.collect())


# -- filters -------------------------------------------------------------------------------------

WIDTHS = st.integers(1, 32)


@given(st.integers(2, 4), WIDTHS, st.data())
@settings(max_examples=60, deadline=None)
def test_phrases_are_read_back_from_a_filter(words, width, data):
    ids = st.lists(st.integers(0, 2**width - 1), min_size=words, max_size=words)
    phrases = np.array(data.draw(st.lists(ids, max_size=40)), np.uint64).reshape(-1, words)
    bits = mining.bits_of(words, width)
    halves = [mining.packed(p, words, width) for p in phrases]
    left = np.array([h[0][0] for h in halves], np.uint64)
    right = np.array([h[1][0] for h in halves], np.uint64)
    counts = np.array(data.draw(st.lists(st.integers(1, 2**50), min_size=len(phrases), max_size=len(phrases))), np.uint64)
    held = mining.summed(*mining.permuted(left, right, bits), counts, bits)
    back = mining.entries_of(mining.filter_of(*held, bits), bits)
    assert all((a == b).all() for a, b in zip(held, back))
    got = mining.unpacked(*mining.restored(*back[:2], bits), words, width)
    want = Counter()
    for p, n in zip(phrases.tolist(), counts.tolist()):
        want[tuple(p)] += n
    assert Counter(dict(zip(map(tuple, got.tolist()), back[2].tolist()))) == want


@given(st.lists(st.lists(st.tuples(st.integers(0, 7), st.integers(0, 3), st.integers(1, 300))), min_size=1, max_size=5))
@settings(max_examples=60, deadline=None)
def test_merging_filters_adds_their_counts(shards):
    bits, want, filters = (3, 2), Counter(), []
    for shard in shards:
        for a, b, n in shard:
            want[a, b] += n
        columns = np.array(shard, np.uint64).reshape(-1, 3).T
        filters.append(mining.filter_of(*mining.summed(*columns, bits), bits))
    left, right, counts = mining.merged([mining.entries_of(f, bits) for f in filters], bits)
    assert Counter(dict(zip(zip(left.tolist(), right.tolist()), counts.tolist()))) == want
    assert list(zip(left.tolist(), right.tolist())) == sorted(want)


def test_a_filter_is_compact():
    """About a byte for a run, three for a remainder and one for a counter."""
    rng = np.random.default_rng(1)
    bits = mining.bits_of(2, 17)
    left, right = (rng.integers(0, 1 << 17, 500_000, np.uint64) for _ in range(2))
    held = mining.summed(left, right, np.ones(500_000, np.uint64), bits)
    assert len(mining.filter_of(*held, bits)) < 5 * len(held[0])


# -- phrases -------------------------------------------------------------------------------------


def test_equals_plain_counting(spark):
    data = rows(400, seed=2)
    docs = [(d[2], d[1]) for d in data]
    got = answers(mining.collocations(table(spark, data)))
    assert got == by_hand(docs) and len(got) > 20


@pytest.mark.parametrize("least, most", [(2, 2000), (3, 7), (5, 40)])
def test_small_blocks_ranges_and_ties(spark, monkeypatch, least, most):
    for name, value in (("BLOCK_BYTES", 3000), ("RANGE_WORDS", 500), ("TASK_ENTRIES", 900), ("STRETCH_WORDS", 97)):
        monkeypatch.setattr(mining, name, value)
    rng = random.Random(least)
    data = rows(120, seed=3)
    data += [(500 + i, "A b. a b c d! a  b\tc d e\x0bf g " * rng.randint(1, 9), rng.choice(["en", None]), "s", 1) for i in range(30)]
    data += [(600 + i, "".join(rng.choices("ab .", k=300)), "und", "s", 1) for i in range(10)]
    got = answers(mining.collocations(table(spark, data, False).repartition(4), 4, least, most))
    assert got == by_hand([(d[2], d[1]) for d in data], 4, least, most)


def test_a_crowded_bitmap_only_costs_time(spark, monkeypatch):
    monkeypatch.setattr(mining, "BITMAP_BITS", 64)
    data = rows(150, seed=5)
    got = answers(mining.collocations(table(spark, data), 4, 3))
    assert got == by_hand([(d[2], d[1]) for d in data], 4, 3)


def test_longer_phrases_are_counted_alike(spark):
    data = rows(60, seed=6)
    got = answers(mining.collocations(table(spark, data), 3, 2))
    assert got == by_hand([(d[2], d[1]) for d in data], 3, 2)


def test_scores_are_exact_beyond_64_bits(spark):
    big = 9_000_000_000_000_000
    df = spark.createDataFrame([(big, big + 1, 2 * big)], "a long, l long, r long")
    got = df.selectExpr(f"cast(a as decimal(28,0)) * {mining.SCALE} div (cast(l as decimal(28,0)) + r) AS s").first().s
    assert got == mining.SCALE * big // (3 * big + 1)


@pytest.mark.parametrize("data", [[], [(1, None, "en", "s", 1), (2, "", None, None, 0), (3, ". !", "de", "s", 1)]])
def test_no_words_give_no_rows(spark, data):
    assert answers(mining.collocations(table(spark, data))) == []


def test_query_equals_its_sql_on_odd_rows(spark, tmp_path):
    data = [*rows(300, seed=7), (1000, prose(random.Random(1), "en", 20_000), None, "s", 1)]
    table(spark, data, False).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_phrase_mining"](spark, str(tmp_path)).toPandas()
    con = connect("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert len(got) > 20 and plain(got) == plain(con.execute(ORACLE["op12_phrase_mining"]).df())
