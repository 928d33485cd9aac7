"""Every registered query against its SQL twin, and the shape of key plans."""

import math
import re

import duckdb
import pytest

import __spark_entry__
from pagesift.plans.backfill import run_range
from pagesift.fixed import EXACT, EXACT_MEMBERS, NEAR_MEMBERS, REPORT, UNION
from pagesift.session import new_path
from pagesift.sources.tables import StageStore, write_days
from pagesift.testbed import data, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_TYPE = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is None, "" if v is None else str(v)) for v in row)


OWN = sorted(queries.QUERIES)


def test_every_query_has_a_twin():
    assert set(queries.QUERIES) <= set(__spark_entry__.oracle_sql())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", OWN)
def test_query_matches_sql(spark, sf_dir, duck, name):
    got = __spark_entry__.queries()[name](spark, sf_dir)
    want = duck.sql(__spark_entry__.oracle_sql()[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    kinds = {c: SPARK_TYPE[str(t)] for c, t in zip(want.columns, want.types)}
    assert dict(got.dtypes) == kinds
    order = [want.columns.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=_key)
    rows = sorted((tuple(r) for r in got.select(*columns).collect()), key=_key)
    assert len(rows) == len(expected)
    # No query pairs everything with everything.
    plan = _plan(got)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    for a, b in zip(rows, expected):
        for x, y in zip(a, b):
            assert x == y or (isinstance(x, float) and math.isclose(x, y, abs_tol=2e-6)), (name, a, b)


def test_scans_read_only_what_they_need(spark, sf_dir):
    plan = _plan(queries.QUERIES["source_whitelist"](spark, sf_dir))
    schemas = re.findall(r"ReadSchema: (struct<.*?>)", plan)
    assert any(s == "struct<doc_id:bigint,source:string>" for s in schemas), schemas
    assert "In(source" in plan


def test_labels_shuffle_words_once_per_column(spark, sf_dir):
    tokens, models = queries._words_and_models(spark, sf_dir)
    plan = _plan(queries.label_articles(tokens, models, models, data.LISTED, ("fid",)))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    # The two text columns, spread by id and row; each is written twice in the
    # plan and run once. Other shuffles carry no words.
    words = [s for s in shuffles if "_row" in s]
    assert len(words) == 4 and all(s.startswith("fid") for s in shuffles), shuffles
    assert "BroadcastHashJoin" in plan


def test_backfill_equals_single_days(spark, sf_dir):
    path = new_path(spark, "crawl")
    write_days(data.crawl(spark, sf_dir), path)
    models = queries._words_and_models(spark, sf_dir)[1]
    options = dict(
        rules=data.RULES, sources=data.SOURCES, listed=data.LISTED, drop_script=data.NOT_LETTERS, threshold=1,
        steps=("duplicates", "labels", "articles"),
    )
    ranged, daily = (StageStore(spark, new_path(spark, "store")) for _ in range(2))
    run_range(ranged, path, "20240101", "20240103", models, models, **options)
    for start, end in (("20240101", "20240102"), ("20240102", "20240103")):
        run_range(daily, path, start, end, models, models, **options)
    for name in (EXACT, EXACT_MEMBERS, NEAR_MEMBERS, REPORT, UNION, "etl"):
        a, b = (sorted(map(tuple, s.read(name, "20240101", "20240103").collect()), key=_key) for s in (ranged, daily))
        assert a == b and a
