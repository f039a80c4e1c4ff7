from skymetrics.operators.ranking import largest_first, top_n
from tests.helpers import tuples

ROWS = [("x", "b", 5), ("x", "a", 5), ("x", None, 5), ("x", "c", 9), ("y", "d", 1),
        (None, "e", 2), (None, "f", 3), ("z", "g", None), ("z", "h", 0)]


def table(spark):
    return spark.createDataFrame(ROWS, "g string, k string, n int").repartition(5)


def test_global_top_n_breaks_ties_by_the_other_columns(spark):
    top = top_n(table(spark), largest_first("n", "k"), n=3)
    assert [r.k for r in top.collect()] == ["c", None, "a"]
    assert top.columns == ["g", "k", "n"]


def test_global_rank(spark):
    top = top_n(table(spark), largest_first("n", "k"), n=2, rank="rank")
    assert [(r.k, r["rank"]) for r in top.collect()] == [("c", 1), (None, 2)]


def test_top_n_per_group(spark):
    top = top_n(table(spark), largest_first("n", "k"), n=2, per=["g"], rank="rank")
    assert tuples(top) == sorted(
        [("x", "c", 9, 1), ("x", None, 5, 2), ("y", "d", 1, 1), (None, "f", 3, 1),
         (None, "e", 2, 2), ("z", "h", 0, 1), ("z", "g", None, 2)], key=repr,
    )
    one = top_n(table(spark), largest_first("n", "k"), per=["g"])
    assert one.columns == ["g", "k", "n"]
    assert tuples(one.select("k")) == [("c",), ("d",), ("f",), ("h",)]


def test_empty_input(spark):
    none = table(spark).filter("false")
    assert top_n(none, largest_first("n"), per=["g"]).collect() == []
    assert top_n(none, largest_first("n")).collect() == []
