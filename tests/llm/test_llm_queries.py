"""Queries on the smallest example tables: against their SQL, and the pipeline against its stages one by one."""

import os

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the example tables are not there")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SMALL):
        c.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{SMALL}/{f}'")
    return c


def rows(df):
    return sorted(map(str, df[sorted(df.columns)].itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", ["op2_suffix_dedup", "op5_exact_dedup", "op7_ngram_join", "op8_substring_dedup", "op9_line_dedup", "op10_secret_scan"])
def test_query_against_sql(spark, con, name):
    from gridloom.llm.queries import ORACLES, QUERIES

    assert rows(QUERIES[name](spark, SMALL).toPandas()) == rows(con.sql(ORACLES[name]).df())


def test_every_query_is_registered_and_runs():
    from gridloom.llm.queries import QUERIES

    assert [int(n[2:].split("_")[0]) for n in QUERIES] == list(range(1, 11))


def test_no_python_on_native_paths(spark):
    from gridloom.llm.queries import QUERIES

    for name in ("op5_exact_dedup", "op10_secret_scan"):
        plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_pipeline_is_its_stages(spark):
    """Each stage against brute force over what the one before kept."""
    import corpus_pipeline
    from gridloom.llm import mixing, toxicity
    from tests.llm.test_llm_operators import brute_components, brute_contaminated, brute_exact

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, steps = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SMALL)
        docs = spark.createDataFrame(docs.toPandas(), docs.schema)
        steps.append((name, before, docs))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
    ids = lambda df: {r["doc_id"] for r in df.collect()}
    pairs = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    scored = toxicity.toxicity(steps[0][1], spark.read.parquet(f"{SMALL}/labels.parquet"))
    assert ids(steps[0][2]) == ids(scored.filter("predicted = 0"))
    assert ids(steps[1][2]) == {keep for _, keep, _, _ in brute_exact(pairs(steps[1][1]))}
    assert ids(steps[2][2]) == {c for _, _, c in brute_components(pairs(steps[2][1]))}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    gone = ids(steps[3][1]) - ids(steps[3][2])
    assert gone == {int(r.split(",")[0].lstrip("(")) for r in brute_contaminated(pairs(steps[3][1]), items)} and gone
    assert ids(steps[4][2]) == ids(steps[3][2])
    assert rows(corpus_pipeline.run(spark, SMALL).toPandas()) == rows(mixing.mix(steps[3][2]).toPandas())
