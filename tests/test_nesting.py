from __future__ import annotations

from builders import drug, reaction, report

from casewise.operators.nesting import cap_cases, cases_from_documents, cases_from_tables
from casewise.operators.silver import latest_versions, silver_tables
from casewise.schema import CASE_SCHEMA


def both_ways(frame):
    latest = latest_versions(frame)
    return cases_from_documents(latest), cases_from_tables(*silver_tables(latest))


def test_columns_and_types(bronze):
    for cases in both_ways(bronze(report())):
        assert cases.schema.simpleString() == CASE_SCHEMA.simpleString()


def test_children_in_order_with_null_elements_dropped(bronze):
    frame = bronze(report(drugs=[drug("B"), None, drug("A")], reactions=[reaction("Y"), reaction("X")]))
    for cases in both_ways(frame):
        row = cases.first()
        assert [d.active_substance for d in row.drugs] == ["B", "A"]
        assert [r.reaction_term for r in row.reactions] == ["Y", "X"]
        assert row.label_seriousness == "serious"


def test_no_children_gives_null_arrays(bronze):
    for cases in both_ways(bronze(report(drugs=[], reactions=[]), report("R2", drugs=[None]))):
        rows = cases.orderBy("safetyreportid").collect()
        assert (rows[0].drugs, rows[0].reactions) == (None, None)
        assert rows[1].drugs is None


def test_both_ways_agree(bronze):
    frame = bronze(
        *(
            report(f"R{i}", drugs=[drug(f"S{j}") for j in range(i % 4)], reactions=[reaction(f"T{i}")] * (i % 3))
            for i in range(20)
        )
    )
    one, other = (sorted(map(repr, cases.collect())) for cases in both_ways(frame))
    assert one == other


def test_documents_need_no_further_shuffle(bronze):
    latest = latest_versions(bronze(report()))
    plan = cases_from_documents(latest)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the version cut


def test_limited_tables(bronze):
    frame = bronze(*(report(f"R{i}", drugs=[drug(f"S{i}")]) for i in range(5)))
    tables = silver_tables(latest_versions(frame))
    rows = cases_from_tables(*tables, limit=2).orderBy("safetyreportid").collect()
    assert [(r.safetyreportid, r.drugs[0].active_substance) for r in rows] == [("R0", "S0"), ("R1", "S1")]


def test_cap(cases_of):
    from builders import case

    cases = cases_of(*(case(f"R{i:02}") for i in range(60)))
    assert cap_cases(cases).count() == 60
    assert [r.safetyreportid for r in cap_cases(cases, 3).collect()] == ["R00", "R01", "R02"]
    assert cap_cases(cases, None).count() == 60
