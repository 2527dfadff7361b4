"""All operators and the pipeline are registered, and those with SQL agree with it."""

import pytest
from harness import compare, oracle

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def test_every_number_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op") and n[2].isdigit())
    assert numbers == list(range(1, 14))
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op2_exact_dedup", "op4_warc_bundles", "op6_raked_mixture"])
def test_sql(spark, name):
    _, diff = compare(entry.queries()[name](spark, SF_DIR), oracle(SF_DIR), entry.oracle_sql()[name])
    assert diff == ""
