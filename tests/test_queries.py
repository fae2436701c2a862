"""Every query of the library against its SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
import compare

SF = os.environ.get("ADLAKE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLE = entry.QUERIES, entry.ORACLE

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare.difference(QUERIES[name](spark, SF), compare.duck(SF), ORACLE[name]) == ""
