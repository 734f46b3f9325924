"""A few registered queries against their oracle, and the driver contract."""

import pytest

import __spark_entry__ as entry
from clearspan.catalogue.compare import compare

FOLDER = "/root/testdata/sf0.01"
CHECKED = ["bin_range_enrich", "rule_first_match_cmp", "scd2_merge", "settlement_report", "typed_text", "hourly_summary"]


def test_every_query_of_the_catalogue_has_an_oracle():
    own = [m for m in entry._MODULES if m.__name__.startswith("clearspan.catalogue.")]
    assert own
    assert all(set(m.QUERIES) == set(m.ORACLE) for m in own)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, name):
    ok, note = compare(spark, FOLDER, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note
