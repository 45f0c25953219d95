"""The pipeline against its stages done by hand, and the oracles."""

import duckdb

import corpus_pipeline
from daybook.llm import packing, pii, toxicity
from daybook.llm.queries import ORACLE, QUERIES
from scripts.compare import digest

SF = "/root/testdata/sf0.001"


def test_oracles(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    for key, sql in ORACLE.items():
        df = QUERIES[key](spark, SF)
        res = con.execute(sql)
        cols = [d[0] for d in res.description]
        assert sorted(cols) == sorted(df.columns)
        assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(cols, res.fetchall())


def test_run_equals_the_stages_by_hand(spark, texts):
    from tests.llm.test_line_dedup import _expected
    from tests.llm.test_near_dedup import _truth

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    machine = toxicity.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    index = toxicity.TermIndex(machine.column)
    clean = sorted((i, t) for i, t in texts.items() if machine.logits([toxicity.present(t, index)])[0] < 0)
    lines = sorted(_expected(clean, 10, "first").items())
    near = _truth(lines, 5)
    left = [(i, t) for i, t in lines if near[i][1] == i]
    model = pii.learn(spark.createDataFrame(left, "doc_id long, text string"))
    final = {i: pii.redacted(t, pii.all_spans([t], model)[0][1]) for i, t in left}
    lengths = {i: len(t.encode().split()) + 1 for i, t in final.items()}
    rows = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in rows} == lengths
    h = {}
    for n in lengths.values():
        h[n] = h.get(n, 0) + 1
    assert sum(r["padding"] for r in rows) == packing.padding(h, packing.best_bounds(h, packing.BUCKETS))


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "pii", "packing"]
