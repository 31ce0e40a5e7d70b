import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH")]))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from stepweave.session import build_session

    s = build_session(
        "tests",
        **{
            "spark.master": "local[4]", "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            "spark.ui.showConsoleProgress": "false", "spark.default.parallelism": "4",
        },
    )
    s.sparkContext.setLogLevel("OFF")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf(request):
    path = f"{DATA}/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("the test tables are not here")
    return path


def plain(value):
    """Values of both engines in one form, floats rounded."""
    if value is None:
        return "N"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        return "nan" if value != value else repr(round(value, 6) + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(map(plain, value)) + "]"
    return str(value)


def compare(spark, sf, query, sql):
    import duckdb

    con = duckdb.connect()
    for name in os.listdir(sf):
        con.sql(f"create view {name.removesuffix('.parquet')} as select * from '{sf}/{name}'")
    df = query(spark, sf)
    cols = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in df.collect())
    con_result = con.execute(sql)
    names = [d[0] for d in con_result.description]
    want = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in con_result.fetchall())
    assert sorted(names) == cols
    assert got == want
