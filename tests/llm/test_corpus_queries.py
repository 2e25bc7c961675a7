"""Every query of the subpackage against its SQL, where it has one."""

import pytest

from checks.compare import connect, rows_of
from guichet.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query(spark, data_dir, name):
    df = QUERIES[name](spark, data_dir)
    relation = connect(data_dir).sql(ORACLES[name])
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(relation.columns, relation.fetchall())


def test_all_are_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
