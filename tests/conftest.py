import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def same():
    """Compares a query with its SQL on a folder of tables, as multisets of rows by column name."""
    from collections import Counter

    import duckdb

    tables = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

    def plain(v):
        if v is None or isinstance(v, (bool, int)):
            return v if not isinstance(v, bool) else int(v)
        return round(float(v), 6) if isinstance(v, float) or type(v).__name__ == "Decimal" else str(v)

    def check(spark, query, sql, folder):
        frame = query(spark, folder)
        names = sorted(frame.columns)
        got = Counter(tuple(plain(v) for v in r) for r in frame.select(*[f"`{c}`" for c in names]).collect())
        con = duckdb.connect()
        for t in tables:
            con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
        cursor = con.execute(sql)
        given = [d[0] for d in cursor.description]
        assert sorted(given) == names
        at = [given.index(c) for c in names]
        want = Counter(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())
        assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])

    return check
