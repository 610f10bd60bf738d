"""Near copies among rows without a doc_id."""

from corpus_pipeline import near_dedup

from .test_groups import brute_groups, got_near

BASE = [f"word{k}" for k in range(60)]


def edited(*places):
    return " ".join(f"edit{k}" if k in places else w for k, w in enumerate(BASE))


def other(start, end=""):
    return " ".join(f"other{k}" for k in range(start, start + 40)) + end


# 1 and 2 are near each other only through the row without an id between them
BRIDGE = [(1, edited()), (None, edited(0, 1, 2, 3)), (2, edited(0, 1, 2, 3, 59, 58, 57, 56))]
COPIES = [(None, other(0)), (None, other(0, " end")), (None, other(500)), (9, other(700)), (None, other(700, " end")), (None, ""), (None, " ")]


def test_components_hang_together_through_rows_without_an_id(spark):
    assert len({name for _, _, name in brute_groups(BRIDGE)}) == 1 and len({name for i, _, name in brute_groups(BRIDGE[::2])}) == 2
    docs = spark.createDataFrame(BRIDGE + COPIES, "doc_id long, text string")
    assert got_near(docs) == brute_groups(BRIDGE + COPIES)


def test_one_row_of_a_group_is_kept_without_ids(spark):
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(BRIDGE + COPIES)], "doc_id long, text string, n int")
    kept = {r.n: r.doc_id for r in near_dedup(spark, docs, "").collect()}
    assert len(kept.keys() & {3, 4}) == 1
    assert {n: i for n, i in kept.items() if n not in (3, 4)} == {0: 1, 5: None, 6: 9, 8: None, 9: None}


def test_near_copies_that_share_an_id_are_one(spark):
    docs = spark.createDataFrame([(7, other(0)), (7, other(0, " end")), (7, other(300))], "doc_id long, text string")
    assert near_dedup(spark, docs, "").count() == 2
