from riskfeat.plans.extras import CROSS_TERMS
from testbed.operator_queries import cross_table_interactions
from testbed.row_queries import ID, application
from testbed.registry import QUERIES

SF = "/root/testdata/sf0.01"


def test_all_cross_terms_of_all_customers(spark):
    got = {r[ID]: r for r in cross_table_interactions(spark, SF).collect()}
    every, pays, cash = ({r[ID] for r in df.select(ID).collect()} for df in (
        application(spark, SF), QUERIES["installments_table"](spark, SF), QUERIES["pos_table"](spark, SF)))
    assert set(got) == every and every - (pays & cash)
    assert set(next(iter(got.values())).asDict()) == {ID, *CROSS_TERMS}
    for name, (needs, _) in CROSS_TERMS.items():
        assert any(r[name] is not None for r in got.values()), name
        for key, r in got.items():
            if key not in pays and any(c.startswith("INS_") for c in needs):
                assert r[name] is None
            if key not in cash and any(c.startswith("POS_") for c in needs):
                assert r[name] is None
