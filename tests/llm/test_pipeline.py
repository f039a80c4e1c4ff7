"""The pipeline, stage by stage, and the registered queries."""

import re
from collections import Counter

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from checks.compare import connect, rows as plain
from skymetrics.llm import language_id, packing, quality_classifier
from skymetrics.llm.common import stored
from skymetrics.llm.queries import ORACLE, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.helpers import key, rows, table
from tests.llm.test_documents import check_packing, fingerprint_of, labelled, near_copies, roots_of
from tests.llm.test_words import WORD


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder with documents, among them junk, copies and odd rows, and labels of some."""
    folder = str(tmp_path_factory.mktemp("tables"))
    data, labels = labelled()
    data += [(4000 + r[0] if r[0] is not None else None, *r[1:]) for r in rows()] + near_copies()
    table(spark, data).write.parquet(f"{folder}/documents.parquet")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    marks.write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def outputs(spark, tables):
    """What each stage is given, and what it returns."""
    docs, found = spark.read.parquet(f"{tables}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, tables), name)
        found.append((docs, out))
        docs = out
    return found


def kept(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


def test_stages(outputs):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "language_id", "simhash_dedup", "mixing", "best_fit_packing"]
    for docs, out in outputs[:-1]:
        assert out.columns == docs.columns and 0 < out.count()


def test_quality_rejects_what_the_classifier_rejects(spark, tables, outputs):
    docs, out = outputs[0]
    marks = spark.read.parquet(f"{tables}/labels.parquet")
    scores = Counter()
    for r in quality_classifier.classify(docs, marks).collect():
        scores[r.doc_id] += r.predicted
    assert kept(out) == [r for r in kept(docs) if scores[r[0]]]
    bad = {r.doc_id for r in marks.where("quality = 0").collect()}
    assert not bad & {r.doc_id for r in out.collect()}


def test_language_rejects_what_cannot_be_told(outputs):
    docs, out = outputs[1]
    found = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(docs).collect()}
    told = lambda i: found[i][0] != "und" and found[i][1] >= 0.5
    assert kept(out) == [r for r in kept(docs) if told(r[0])]


def test_one_of_each_group_of_copies_stays(outputs):
    docs, out = outputs[2]
    given = docs.collect()
    roots = roots_of([fingerprint_of(r.text) for r in given], 4)
    first = {}
    for r in given:
        root = roots[fingerprint_of(r.text)]
        known = [i for i in (first.get(root), r.doc_id) if i is not None]
        first[root] = min(known) if known else None
    assert sorted(map(str, first.values())) == sorted(str(r.doc_id) for r in out.collect())
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in given}
    assert out.count() < docs.count() - 8


def test_mixing_takes_whole_documents_near_the_targets(outputs):
    docs, out = outputs[3]
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    taken = Counter(r.doc_id for r in out.collect())
    assert set(taken) <= set(size) and max(taken.values()) <= 2
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in docs.collect()}
    total = sum(size.values())
    longest = max(size.values())
    assert abs(sum(size[i] * n for i, n in taken.items()) - 1.5 * total) <= 5 * longest


def test_windows_hold_no_text_twice(spark, outputs):
    docs, out = outputs[4]
    numbered = docs.collect()
    size = Counter()
    for r in numbered:
        size[r.doc_id] += len(WORD.findall(r.text or ""))
    got = Counter()
    for r in out.collect():
        got[r.doc_id] += r.n_words
    assert +got == +size
    one = docs.dropDuplicates(["doc_id"])
    facts = {r.doc_id: r for r in packing.sized(one).collect()}
    pieces = [tuple(r) for r in packing.pack(packing.sized(one)).collect()]
    columns = ({d: getattr(r, c) for d, r in facts.items()} for c in ("size", "source", "cluster"))
    check_packing(pieces, *columns, packing.WINDOW, packing.PER_SOURCE)
    shared = Counter((r.window_id, r.doc_id) for r in out.collect())
    assert max(shared.values()) == 1


def test_run_is_all_stages_in_turn(spark, tables, outputs):
    assert corpus_pipeline.run(spark, tables).count() == outputs[-1][1].count()


def test_stages_take_empty_tables(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, tables)
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs, tables).count() == 0


def test_stages_take_very_long_texts_and_odd_rows(spark, tables):
    long = " ".join(f"{w} and the other of it." for w in "abcdefghij" for _ in range(8000))  # 480,000 words
    data = [(1, long, "en", "s", 1), (2, long + " more", "en", "s", 1), (None, None, None, None, None), (3, "", "en", None, 0),
            (None, "a text of a few words that has no id", "en", "s", 1), (1, long, "en", "s", 1)]
    docs = table(spark, data)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stored(stage(spark, docs, tables), name)
        assert out.columns == docs.columns
        if name == "simhash_dedup":  # of the three long ones, one stays
            assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "3", "None"]
    pieces = stored(corpus_pipeline.STAGES[-1][1](spark, docs, tables), "pieces")
    assert pieces.where("doc_id = 2").agg({"n_words": "sum"}).first()[0] == len(data[1][1].split())


def test_registered_names():
    numbers = {re.match(r"op(\d+)_\w+$", name)[1] for name in QUERIES}
    assert numbers == {str(n) for n in range(1, 14)} and len(QUERIES) == 13
    assert set(QUERIES) | {"pipeline"} <= set(driver.queries())
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_its_sql(spark, name):
    want = connect(SF_SMALL).execute(ORACLE[name]).df()
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    assert sorted(got.columns) == sorted(want.columns) and plain(got) == plain(want)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLE])  # all of which name documents
def test_query_runs_on_its_whole_table(spark, name):
    n = spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    assert QUERIES[name](spark, SF_SMALL).select("doc_id").distinct().count() == n
