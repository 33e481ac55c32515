import pytest

from gradeloom.llm import queries

from ..conftest import SF
from ..test_queries import canon, duck  # noqa: F401


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, duck, name):  # noqa: F811
    df = queries.QUERIES[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    if name in queries.SQL:
        res = duck.execute(queries.SQL[name])
        assert got == canon([c[0] for c in res.description], res.fetchall())
