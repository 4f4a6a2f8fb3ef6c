"""Numbers inside groups, when a group is spread over ranges."""

import random
import re

import pytest

from facetforge.operators import ordering
from facetforge.plans import load


def test_rows_of_a_group_are_numbered_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS", 20)
    rng = random.Random(2)
    rows = [(i, rng.choice(["a", "a", "b", None])) for i in rng.sample(range(1000), 300)]
    got = ordering.numbered(spark.createDataFrame(rows, "id long, source string"), "id", by=("source",)).collect()
    want, seen = {}, {}
    for i, s in sorted(rows, key=lambda r: r[0]):
        want[i] = seen[s] = seen.get(s, 0) + 1
    assert len(got) == 300 and {r.id: r.rn for r in got} == want


def test_equal_leads_are_spread_over_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS", 10)
    rows = [(7 if i % 3 else None, i) for i in range(200)]
    got = ordering.running(spark.createDataFrame(rows, "lead long, id long"), "lead", ["id"], "id", "upto").collect()
    total, want = 0, {}
    for _, i in sorted(rows, key=lambda r: (r[0] is not None, r[1])):
        want[i] = total = total + i
    assert {r.id: r.upto for r in got} == want


@pytest.mark.parametrize("name", ["q_sheets", "q_report"])
def test_no_window_over_rows_takes_a_whole_source(spark, sf_dir, name, monkeypatch):
    monkeypatch.setattr(ordering, "ROWS", 20)
    plan = load()[0][name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    windows = [re.sub(r"#\d+L?", "", line) for line in plan.splitlines() if re.search(r"\bWindow \[", line)]
    # One over the ranges' sums, one over the rows of a range.
    assert any("[_range, source]" in w for w in windows)
    assert not [w for w in windows if "row_number()" in w and re.search(r"\], \[source\], \[doc_id", w)]
