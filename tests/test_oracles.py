import os
import re

import duckdb
import pytest

from dossierforge.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows(columns, found):
    return sorted((tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in found), key=lambda r: tuple((x is None, str(x)) for x in r))


def same(spark, query, sql):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = query(spark, SF)
    names = sorted(df.columns)
    want = con.sql(sql)
    assert sorted(want.columns) == names
    at = [list(want.columns).index(c) for c in names]
    assert rows(names, ([r[c] for c in names] for r in df.collect())) == rows(names, ([r[i] for i in at] for r in want.fetchall()))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_sql(spark, name):
    same(spark, catalog.QUERIES[name], catalog.ORACLES[name])


NATIVE = ["company_id_derive", "url_slug", "postcode_candidates", "dataset_assemble", "scores_validate", "detect_language"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_have_no_python_node(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and not re.search("InArrow|ArrowEval", plan)  # names of character references end in Arrow, too
