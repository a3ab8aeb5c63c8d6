"""Every query against its SQL in DuckDB, on the driver's tables."""

import math
import os

import pytest

duckdb = pytest.importorskip("duckdb")

from siftline.plans import catalog  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_like_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    if (sql := catalog.oracle_sql().get(name)) is None:
        return
    cur = duck.execute(sql)
    theirs = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(theirs)
    order = sorted(theirs)
    key = lambda r: repr(r)
    want = sorted((tuple(plain(r[theirs.index(c)]) for c in order) for r in cur.fetchall()), key=key)
    got = sorted((tuple(plain(r[c]) for c in order) for r in rows), key=key)
    diff = [(a, b) for a, b in zip(got, want) if a != b]  # noqa: B905
    assert len(got) == len(want) and not diff, (len(got), len(want), diff[:3])
    for i, c in enumerate(order):
        assert len({r[i] for r in want}) > 1 or len(want) < 3 or c in ("label", "observed_at", "source", "verification_time") or any(r[i] is not None for r in want), c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_code_is_generated(spark, name):
    """No stage of a query's plan is too large to be compiled."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = catalog.queries()[name](spark, SF)._jdf.queryExecution().executedPlan()
        for x in iter_of(spark.sparkContext._jvm.org.apache.spark.sql.execution.debug.__getattr__("package").codegenStringSeq(plan)):
            assert x._3().maxMethodCodeSize() != -1, x._1()[:1000]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def iter_of(seq):
    return [seq.apply(i) for i in range(seq.length())]
