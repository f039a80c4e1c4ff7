"""Ranked search by term owners beside plain scoring of everything."""

import math
import random
import re
from collections import Counter

import pytest

from checks.compare import connect, rows as plain
from skymetrics.llm import ranked_search
from skymetrics.llm.oracle import ORACLE
from skymetrics.llm.queries import QUERIES
from tests.llm.helpers import key, prose, rows, table

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(docs, items, k=10):
    bags = [(d, Counter(t)) for d, text in docs if (t := terms(text))]
    N, L = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    found = []
    for item_id, text in items:
        scored = []
        for doc_id, bag in bags:
            m = 25 + 75 * sum(bag.values()) * N // L
            score = sum(
                math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 8 * m))
                for t in terms(text)
                if bag[t]
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            found.append((item_id, rank, doc_id, -score))
    return sorted(found, key=key)


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def answers(found):
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    assert [t for _, t in found.dtypes] == ["bigint", "int", "bigint", "bigint"]
    return sorted((tuple(r) for r in found.collect()), key=key)


ITEMS = [
    (1, "the of and, The OF"),
    (2, "one"),
    (3, None),
    (4, ""),
    (5, "nosuchterm !!"),
    (6, "straße 東京 12 ÄÖÜ null id"),
    (7, "the null id of the table and its text"),
    (None, "und der die"),
    (2, "one two"),  # a repeated id
]


def test_equals_scoring_everything(spark):
    data = rows()
    items = ITEMS + [(100 + i, data[i][1]) for i in range(0, 60, 3)]
    got = answers(ranked_search.search_documents(table(spark, data), asked(spark, items)))
    assert got == by_hand([(d[0], d[1]) for d in data], items)


@pytest.mark.parametrize("seed", range(3))
def test_many_shards_bundles_and_ties(spark, monkeypatch, seed):
    """Shards, bundles and owners so small that pruning and merging take place."""
    monkeypatch.setattr(ranked_search, "SHARD_BYTES", 2000)
    rng = random.Random(seed)
    data = [(rng.randrange(2**61), prose(rng, rng.choice(["en", "de"]), rng.randint(1, 60)), "en", "s", 1) for _ in range(250)]
    data += [(rng.randrange(1000), data[i % 7][1], "en", "s", 1) for i in range(60)]  # copies, so ties
    items = [(i, prose(rng, "en", rng.randint(1, 30))) for i in range(90)] + [(90 + i, data[i][1]) for i in range(10)]
    docs = table(spark, data, False).repartition(3)
    for k in (1, 10):
        got = answers(ranked_search.search_documents(docs, asked(spark, items).repartition(3), k))
        assert got == by_hand([(d[0], d[1]) for d in data], items, k)


def test_carried_accumulators_are_pruned_and_results_stay(spark, monkeypatch):
    """With a word that nearly all documents hold, later owners add to few of them."""
    seen = []
    whole = ranked_search._carried

    def watched(spark, found, needs):
        if found is not None:
            seen.append(sum(len(r.docs) // 4 for r in found.collect()))
        return whole(spark, found, needs)

    monkeypatch.setattr(ranked_search, "_carried", watched)
    rare = [(i, "rare words here " + "pad " * (i % 5), "en", "s", 1) for i in range(12)]
    some = [(100 + i, "common filler " + "x" * (i % 9), "en", "s", 1) for i in range(900)]
    items = [(1, "rare words here common")]
    docs = table(spark, rare + some, False)
    got = answers(ranked_search.search_documents(docs, asked(spark, items)))
    assert got == by_hand([(d[0], d[1]) for d in rare + some], items)
    assert seen and max(seen) <= 12


@pytest.mark.parametrize("docs, items", [(0, 1), (1, 0), (0, 0)])
def test_empty_tables_give_no_rows(spark, docs, items):
    found = ranked_search.search_documents(table(spark, rows()[: 5 * docs]), asked(spark, ITEMS[: 5 * items]))
    assert answers(found) == []


def test_query_equals_its_sql_on_odd_rows(spark, tmp_path):
    table(spark, rows(), False).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    asked(spark, ITEMS).coalesce(1).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = QUERIES["op11_ranked_search"](spark, str(tmp_path)).toPandas()
    con = connect("/root/testdata/sf0.001")
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert plain(got) == plain(con.execute(ORACLE["op11_ranked_search"]).df())
