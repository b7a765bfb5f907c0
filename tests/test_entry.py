import os
import re

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"


def test_registry():
    names, sql = set(entry.queries()), set(entry.oracle_sql())
    assert sql <= names
    assert {f"p{n}_found" for n in (1, 2, 3, 5, 6)} <= names
    assert all(re.fullmatch(r"\w+", n) for n in names)


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test data")
def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:2] == ["key_field", "key_text"] and df.count() > 0


@pytest.mark.skipif(not os.path.exists(DATA), reason="no test data")
@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p5_found", "p6_found", "tpm", "clinical_unify", "finalize_report"])
def test_queries_run(spark, name):
    assert entry.queries()[name](spark, DATA).collect() is not None


def test_nothing_outside_imports_the_text_package():
    root = os.path.dirname(os.path.abspath(entry.__file__))
    for folder, _, files in os.walk(os.path.join(root, "cohortloom")):
        if os.path.basename(folder) != "llm":
            for f in files:
                if f.endswith(".py"):
                    with open(os.path.join(folder, f), encoding="utf-8") as file:
                        assert "cohortloom.llm" not in file.read()
