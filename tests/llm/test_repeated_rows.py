"""Rows that come several times and repeat a passage within themselves lose the repetition only."""

import pytest

from rivulet.llm import substrings

PASSAGE = " ".join(f"p{i}" for i in range(25))
TEXT = f"{PASSAGE} a b c {PASSAGE}"


@pytest.mark.parametrize("copies, partitions", [(1, 1), (2, 1), (3, 1), (2, 2), (4, 3)])
@pytest.mark.parametrize("doc_id", [7, None])
def test_repeated_rows_keep_the_original_passage(spark, copies, partitions, doc_id):
    rows = [(doc_id, TEXT)] * copies + [(9, "x " + PASSAGE), (1, "nothing in common with the others here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    got = substrings.remove_repeated(docs).collect()
    assert len(got) == len(rows)
    mine = [r for r in got if r.n_words == 53]
    assert len(mine) == copies and {r.n_removed for r in mine} == {25} and {r.kept_text for r in mine} == {f"{PASSAGE} a b c"}
    assert {(r.doc_id, r.n_removed) for r in got if r.n_words != 53} == {(9, 25), (1, 0)}
