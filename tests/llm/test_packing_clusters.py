"""Copies that differ in white space or a word share no window."""

from skymetrics.llm import packing
from skymetrics.llm.queries import QUERIES
from tests.llm.test_documents import fingerprint_of, near_copies, roots_of
from tests.llm.helpers import table


def test_white_space_at_the_ends_makes_no_other_cluster(spark):
    texts = ["one text of it", "one text of it\n", "\t one  text of it \r\n"]
    docs = table(spark, [(i, t, "en", "s", 1) for i, t in enumerate(texts)])
    for sized in (packing.sized, packing.classed):
        assert sized(docs).select("cluster").distinct().count() == 1


def test_near_copies_share_no_window(spark, tmp_path):
    copies = [(d[0], d[1], "en", None, 1) for d in near_copies()]
    table(spark, copies, False).write.parquet(f"{tmp_path}/documents.parquet")
    roots = roots_of([fingerprint_of(d[1]) for d in copies], 4)
    root = {d[0]: roots[fingerprint_of(d[1])] for d in copies}
    out = QUERIES["op2_best_fit_packing"](spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} == set(root)
    assert len({(r.window_id, root[r.doc_id]) for r in out}) == len(out) > len(set(root.values()))


def test_large_ids_beside_a_null_id_stay_as_they_are(spark, tmp_path):
    ids = [2**60 + 1, 2**60 + 3, None, -(2**62) - 1, 2**63 - 1]
    table(spark, [(i, f"text number {n}", "en", "s", 1) for n, i in enumerate(ids)]).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    out = QUERIES["op2_best_fit_packing"](spark, str(tmp_path))
    assert sorted(map(str, ids)) == sorted(str(r.doc_id) for r in out.collect())


def test_windows_do_not_depend_on_how_rows_are_split(spark):
    data = [(i % 40, f"{'w ' * (i % 7)}x{i % 40}", "en", f"s{i % 3}", 1) for i in range(80)] + [(None, "", None, None, 0)] * 5
    found = []
    for parts in (1, 7):
        docs = table(spark, data, False).repartition(parts)
        found.append(sorted(map(str, packing.pack(packing.sized(docs), 30, 2, 10).collect())))
    assert found[0] == found[1]


def test_fill_is_near_the_lower_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = packing.pack(packing.sized(docs)).collect()
    words = sum(r.n_words for r in out)
    assert len({r.window_id for r in out}) <= 1.05 * -(-words // packing.WINDOW)
