"""Sequences without padding: every token once, costs by the stated rule."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from skymetrics.llm import cost_packing
from skymetrics.llm.queries import QUERIES
from tests.llm.helpers import prose, rows, table

PATH = public_tokenizers.path("word_bpe_49k.json")


def by_hand(sizes, rooms, linear):
    """The rule, looking through all sequences for each document."""
    room, cost, found, left = list(rooms), [0] * len(rooms), [], []

    def put(d, start, s, n):
        found.append((d, start, s, rooms[s] - room[s], n))
        room[s] -= n
        cost[s] += linear * n + n * n

    for d, size in enumerate(sizes):
        fits = [s for s in range(len(rooms)) if room[s] >= size]
        if fits:
            put(d, 0, min(fits, key=lambda s: (cost[s], s)), size)
        else:
            left.append(d)
    for d in left:
        start = 0
        while start < sizes[d]:
            s = min((s for s in range(len(rooms)) if room[s]), key=lambda s: (cost[s], s))
            n = min(sizes[d] - start, room[s])
            put(d, start, s, n)
            start += n
    return found


@given(st.lists(st.integers(1, 63), max_size=80), st.integers(0, 100))
@settings(max_examples=150, deadline=None)
def test_assignment_equals_the_rule_by_hand(sizes, linear):
    sizes.sort(reverse=True)
    rooms = cost_packing.rooms_for(sum(sizes), 64)
    assert sum(rooms) == sum(sizes) and all(r & (r - 1) == 0 for r in rooms)
    got = cost_packing.assign(sizes, rooms, linear)
    assert got == by_hand(sizes, rooms, linear)


def check(pieces, docs, capacity, end):
    """Pieces of ids cover each document once, and sequences are gapless and need no padding."""
    tokenizer = Tokenizer.from_file(PATH)
    want = sorted(
        (str(d), zlib.crc32(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [end], "<u4").tobytes()))
        for d, t in docs
    )
    sequences, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        assert p.cost == cost_packing.cost_of(p.length)
        sequences[p.sequence_id].append((p.offset, p.length))
        parts[str(p.doc_id)].append(p)
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity and at & (at - 1) == 0
    got = []
    for doc_id, held in parts.items():
        # Rows that share an id are told apart by following each from its first piece.
        held.sort(key=lambda p: p.start)
        while held:
            first = next(p for p in held if p.start == 0)
            held.remove(first)
            ids, size = bytes(first.ids), first.doc_tokens
            while len(ids) < 4 * size:
                piece = next(p for p in held if 4 * p.start == len(ids) and p.doc_tokens == size)
                held.remove(piece)
                ids += piece.ids
            got.append((doc_id, zlib.crc32(ids)))
    assert sorted(got) == want
    return sequences


def test_every_token_lies_in_one_piece(spark):
    data = rows()
    docs = table(spark, data)
    pieces = cost_packing.pack(docs, PATH).collect()
    check(pieces, [(d[0], d[1]) for d in data], 4096, 2)
    assert any(p.start for p in pieces)  # the long text is cut


def test_small_shards_and_sequences(spark):
    rng = random.Random(4)
    data = [(i, prose(rng, "en", rng.randint(1, 90)), "en", "s", 1) for i in range(120)]
    data += [(None, data[3][1], None, None, None), (2**60 + 1, "x", "en", "s", 1), (2**60 + 3, None, "en", "s", 1)]
    docs = table(spark, data)
    pieces = cost_packing.pack(docs, PATH, end=7, capacity=64, shard_tokens=1500).collect()
    assert len({p.sequence_id >> 32 for p in pieces}) > 3
    check(pieces, [(d[0], d[1]) for d in data], 64, 7)


def test_costs_are_near_one_another(spark):
    rng = random.Random(5)
    data = [(i, prose(rng, "en", rng.randint(20, 200)), "en", "s", 1) for i in range(800)]
    pieces = cost_packing.pack(table(spark, data, False), PATH, capacity=2048).collect()
    cost, length = defaultdict(int), defaultdict(int)
    for p in pieces:
        cost[p.sequence_id] += p.cost
        length[p.sequence_id] += p.length
    full = [cost[s] for s in cost if length[s] == 2048]
    assert len(full) > 20 and max(full) < 1.03 * min(full)


def test_split_of_the_rows_makes_no_difference(spark):
    data = rows(40)
    found = []
    for parts in (1, 5):
        docs = table(spark, [d for d in data if d[0] != 5], False).repartition(parts)
        pieces = cost_packing.pack(docs, PATH, capacity=128, shard_tokens=900)
        found.append(sorted((str(p.doc_id), p.start, p.length, p.sequence_id, p.offset) for p in pieces.collect()))
    assert found[0] == found[1]


@pytest.mark.parametrize("copies", [1, 400])
def test_copies_are_spread_over_shards(spark, copies):
    data = [(1, "one and the same text of it", "en", "s", 1)] * copies
    pieces = cost_packing.pack(table(spark, data, False).coalesce(1), PATH, capacity=16, shard_tokens=100).collect()
    check(pieces, [(d[0], d[1]) for d in data], 16, 2)
    if copies > 1:
        assert len({p.sequence_id >> 32 for p in pieces}) > 10


def test_an_empty_table_gives_no_pieces(spark):
    assert cost_packing.pack(table(spark, []), PATH).count() == 0


def test_query_gives_the_digest(spark, tmp_path):
    data = rows(10)
    table(spark, data, False).write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op13_cost_packing"](spark, str(tmp_path))
    assert dict(out.dtypes) == dict.fromkeys(
        ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "cost", "ids_crc32"], "bigint"
    )
    one = out.where("doc_id = 0").collect()
    ids = Tokenizer.from_file(PATH).encode(data[0][1], add_special_tokens=False).ids + [2]
    for p in one:
        assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())
    assert sum(p.length for p in one) == len(ids) == one[0].doc_tokens
