"""Operators delete the tables they save on the way, once their result is written."""

import os

from starkit.llm import common, exact_dedup, minhash_dedup, substring_dedup
from starkit.session import shared_dir


def folders(spark):
    root = shared_dir(spark).removeprefix("file://")
    return {f for f in os.listdir(root) if f.startswith("llm-")}


def test_only_the_result_remains(spark):
    rows = [(i, " ".join(f"w{(i // 2) * 40 + k}" for k in range(60)), "en", "s", 5) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for operator in (exact_dedup.keep_first, minhash_dedup.near_dedup, substring_dedup.remove_repeats):
        before = folders(spark)
        out = operator(docs)
        left = folders(spark) - before
        assert len(left) == 1 and operator.__name__ in left.pop()
        assert out.count() == out.count() == (15 if operator is exact_dedup.keep_first else 30)


def test_nested_operators_leave_one_table(spark):
    inner = common.tidy(lambda df: common.saved(df.filter("id > 2"), "a"))
    outer = common.tidy(lambda df: common.saved(inner(df).filter("id < 7"), "b"))
    before = folders(spark)
    out = outer(spark.range(10))
    assert sorted(r.id for r in out.collect()) == [3, 4, 5, 6] and len(folders(spark) - before) == 1
