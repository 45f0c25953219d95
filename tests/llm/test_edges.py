"""Every query and stage over awkward rows: nulls, empty and very long texts,
ties, repeated rows, extra columns named like results, and empty tables."""

import hashlib
import tempfile

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from daybook.llm import importance_resampling, periodic_runs, sentencepiece_codec, token_counts
from daybook.llm.queries import QUERIES

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score string, kept string, n_lines string, spans string, ids string, shard string, component_id string")
LONG = " ".join(f"w{i % 977}x{i}" for i in range(30000))
TEXTS = [(1, None), (2, ""), (3, " \n\t "), (4, "the same text here now\nand more of it"), (4, "the same text here now\nand more of it"),
         (5, "the same text here now\nand more of it"), (6, LONG), (7, LONG + " end"), (None, "text without an id 12 a@b.example.com"),
         (None, None), (8, "a" * 40000), (9, "é 日本 😀\r\nline\x0btab"), (10, "card 4111 1111 1111 1111, +1 (555) 123-4567")]


def _write(spark, rows, labels):
    at = tempfile.mkdtemp(prefix="daybook-edge-")
    full = [(i, t, None, None, None if t is None else len(t), *["own"] * 7) for i, t in rows]
    spark.createDataFrame(full, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    items = [("b1", "the same text now and w1x1"), ("b2", None), ("b3", "")] if rows else []
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{at}/benchmark.parquet")
    return at


@pytest.fixture(scope="module")
def edge_dir(spark):
    return _write(spark, TEXTS, [(4, 1, 1), (5, None, 0), (9, 1, None), (None, 1, 1), (99, 1, 0)])


@pytest.fixture(scope="module")
def empty_dir(spark):
    return _write(spark, [], [])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_awkward_rows(spark, edge_dir, name):
    rows = QUERIES[name](spark, edge_dir).collect()
    assert len(rows) == len(TEXTS)
    assert sorted(r["doc_id"] or 0 for r in rows) == sorted(i or 0 for i, _ in TEXTS)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_table(spark, empty_dir, name):
    assert QUERIES[name](spark, empty_dir).collect() == []


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_awkward_rows(spark, edge_dir, name, stage):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    out = stage(spark, docs, edge_dir)
    rows = out.collect()
    if name == "packing":
        assert len(rows) == len(TEXTS)
        return
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert all(r["score"] == r["kept"] == r["spans"] == r["n_lines"] == "own" for r in rows)
    if name in ("line_dedup", "pii"):
        assert len(rows) == len(TEXTS)
        assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
    if name == "near_dedup":  # 5 and the two long ones go; no empty text and no null id does
        assert sorted(r["doc_id"] or 0 for r in rows) == [0, 0, 1, 2, 3, 4, 4, 6, 8, 9, 10]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_empty_table(spark, empty_dir, name, stage):
    assert stage(spark, spark.read.parquet(f"{empty_dir}/documents.parquet"), empty_dir).collect() == []


def test_defined_results(spark, edge_dir):
    got = {r["doc_id"]: r for r in QUERIES["op10_exact_dedup"](spark, edge_dir).collect()}
    assert got[3]["group_size"] == 4 and got[2]["keep_id"] == 3  # longest original text of the blank ones
    assert got[5]["keep_id"] == 4 and got[4]["kept"] and got[4]["group_size"] == 3
    near = {r["doc_id"]: r for r in QUERIES["op3_near_dedup"](spark, edge_dir).collect()}
    assert near[1]["n_shingles"] == near[2]["n_shingles"] == near[3]["n_shingles"] == 0
    assert near[1]["component_id"] == 1 and near[2]["kept"] and near[7]["component_id"] == 6 and near[5]["component_id"] == 4
    assert near[8]["n_shingles"] == 1 and near[None]["component_id"] is None and near[None]["kept"]
    prints = {r["doc_id"]: r for r in QUERIES["op6_fingerprints"](spark, edge_dir).collect()}
    assert prints[1]["fingerprint"] == "" and prints[2]["near_edited"] == 1.0
    assert prints[4]["fingerprint"] == prints[5]["fingerprint"]
    spans = {r["doc_id"]: r for r in QUERIES["op2_pii"](spark, edge_dir).collect()}
    assert spans[10]["n_card"] == 1 and spans[10]["n_phone"] == 1 and spans[1]["spans"] == ""
    assert [r["slot"] for r in sorted(QUERIES["op8_sharding"](spark, edge_dir).collect(), key=lambda r: r["shard"])] == [0] * 13


def test_defined_results_of_counts_draws_and_runs(spark, edge_dir):
    count = {r["doc_id"]: r for r in QUERIES["op11_token_counts"](spark, edge_dir).collect()}
    assert all(count[i]["n_tokens"] == count[i]["n_bytes"] == count[i]["fitting_chars"] == 0 for i in (1, 2))
    assert count[6]["over_limit"] and 0 < count[6]["fitting_chars"] < len(LONG) and not count[4]["over_limit"]
    assert count[4]["n_tokens"] == count[5]["n_tokens"] and count[9]["n_bytes"] == len(dict(TEXTS)[9].encode())
    draw = QUERIES["op12_importance_resampling"](spark, edge_dir).collect()
    by_id = {r["doc_id"]: r for r in draw}
    assert by_id[1]["n_features"] == by_id[2]["n_features"] == by_id[3]["weight"] == 0
    assert by_id[4]["weight"] == by_id[5]["weight"] and by_id[4]["n_features"] == 17
    # two documents have 20 words, so floor(25 * 2 / 100) = 0 are drawn
    assert [r["rank"] for r in draw] == [None] * len(TEXTS)
    runs = {r["doc_id"]: r for r in QUERIES["op13_periodic_runs"](spark, edge_dir).collect()}
    none = hashlib.sha256(b"").hexdigest()
    for i in (1, 2, 3):
        assert (runs[i]["n_runs"], runs[i]["start"], runs[i]["exponent_milli"]) == (0, None, None)
        assert runs[i]["runs_sha256"] == runs[i]["collapsed_sha256"] == none
    assert runs[4]["collapsed_sha256"] == hashlib.sha256(" ".join(dict(TEXTS)[4].split()).encode()).hexdigest()


def test_new_operators_pass_extra_columns_and_replace_clashing_ones(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").withColumns({c: F.lit("own") for c in ("n_tokens", "weight", "rank", "start", "runs")})
    pieces = sentencepiece_codec.Pieces.load(sentencepiece_codec.MODEL)
    out = [token_counts.count_tokens(docs, pieces), periodic_runs.detect(docs),
           importance_resampling.resample(docs, spark.read.parquet(f"{edge_dir}/benchmark.parquet"))]
    for df in out:
        rows = df.collect()
        assert len(rows) == len(TEXTS) and len(set(df.columns)) == len(df.columns)
        assert all(r["kept"] == r["shard"] == "own" for r in rows)
    assert dict(out[0].dtypes)["n_tokens"] == "bigint" and dict(out[1].dtypes)["start"] == "bigint" and dict(out[2].dtypes)["rank"] == "bigint"


def test_defined_results_of_ids_scores_lines_and_places(spark, edge_dir):
    def by_id(name):
        return {r["doc_id"]: r for r in QUERIES[name](spark, edge_dir).where("doc_id IS NOT NULL").collect()}
    ids = by_id("op1_sentencepiece")
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"]) for r in ids.values())
    assert ids[1]["ids"] == ids[2]["ids"] == [] and ids[4]["ids"] == ids[5]["ids"] and ids[6]["n_ids"] > 30000
    toxic = by_id("op4_toxicity")
    assert toxic[1]["score"] == toxic[2]["score"] == toxic[3]["score"] and toxic[4]["score"] == toxic[5]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in toxic.values())
    lm = by_id("op5_lm_scoring")
    assert [lm[i]["n_tokens"] for i in (1, 2, 3, 8)] == [1, 1, 1, 2] and lm[4]["score"] == lm[5]["score"]
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in lm.values())
    lines = by_id("op7_line_dedup")
    assert [lines[i]["n_lines"] for i in (1, 2, 3, 4, 9)] == [1, 1, 2, 2, 2] and all(r["n_dropped"] == 0 for r in lines.values())
    assert lines[1]["kept_sha256"] == lines[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    packed = by_id("op9_packing")
    assert [packed[i]["n_tokens"] for i in (1, 2, 3, 8, 6)] == [1, 1, 1, 2, 30001]
    assert all(r["padding"] == r["bucket_len"] - r["n_tokens"] >= 0 for r in packed.values())
