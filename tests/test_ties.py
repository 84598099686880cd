"""rows that an ORDER BY or DISTINCT ON leaves equal count in the order of their table, whichever file a task reads first."""

import duckdb
import pandas as pd
import pytest

from strandwork.plans.queries import QUERIES, SQL
from tests.test_sweeps import internal

LINE = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")


@pytest.fixture(scope="module")
def tied(tmp_path_factory):
    """Lines in two files, the second of which is larger and is read first; each tied pair lies in both."""
    d = tmp_path_factory.mktemp("tied")
    (d / "lineitem.parquet").mkdir()
    pairs = [((1.0, 900.0), (4.0, 100.0)), ((4.0, 5.0), (1.0, 100.0)), ((3.0, 77.0), (3.0, 900.0)), ((9.0, 950.0), (9.0, 40.0))]
    first, second = [], []
    for k in range(40):
        a, b = pairs[k % 4]
        own = (1000 * k, k % 10, k, 1)
        first.append((*own, *a, "N"))
        second += [(*own, *b, "N"), (1000 * k, 10 + k % 10, k, 2, 16.0, 800.0, "N"), (1000 * k, k % 10, k, 4, 9.0, 300.0, "A")]
    second += [(10**6 + k, 999, k, 1, 1.0, k / 7, "A") for k in range(5000)]
    for k, rows in enumerate((first, second)):
        pd.DataFrame(rows, columns=LINE).astype({"l_linenumber": "int32"}).to_parquet(d / "lineitem.parquet" / f"part-{k}.parquet", index=False)
    part = pd.DataFrame([(k, f"Brand#{k % 3}", 7) for k in range(20)] + [(999, "Brand#9", 1)], columns=["p_partkey", "p_brand", "p_size"]).astype({"p_size": "int32"})
    part.to_parquet(d / "part.parquet", index=False)
    return d


def of(tied, sql):
    """Its rows on lines of which ties are taken out, with the lines in order."""
    con = duckdb.connect(config={"threads": 1})
    con.execute(f"CREATE VIEW part AS SELECT * FROM '{tied}/part.parquet'")
    con.execute(f"CREATE VIEW placed AS SELECT * FROM read_parquet('{tied}/lineitem.parquet/*.parquet', filename = true, file_row_number = true)")
    con.execute("CREATE VIEW lineitem AS SELECT * FROM placed QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey, l_linenumber % 3, l_returnflag = 'R', floor(l_quantity) ORDER BY filename, file_row_number) = 1")
    return con.execute(sql).df()


plain = lambda frame: sorted(tuple(map(str, r)) for r in frame.itertuples(index=False))


def test_distinct_hits_by_place(spark, tied):
    want = of(tied, SQL["search_stage"])
    assert plain(QUERIES["search_stage"](spark, str(tied)).toPandas()[list(want.columns)]) == plain(want)


def test_internal_filter_by_place(spark, tied):
    lines = of(tied, "SELECT * FROM placed JOIN part ON l_partkey = p_partkey ORDER BY l_orderkey, l_linenumber, l_partkey, filename, file_row_number")
    want = []
    for header, own in lines.groupby("l_orderkey"):
        ranges = [(int(q), int(q) + 10 + p % 30) for q, p in zip(own["l_quantity"], own["l_partkey"], strict=True)]
        want += [(str(header), str(n)) for n, kept in zip(own["l_linenumber"], internal(ranges, 0.3), strict=True) if kept]
    assert plain(QUERIES["internal_filter_greedy"](spark, str(tied)).select("header", "line").toPandas()) == sorted(want)
