"""The pipeline against its operators one by one, and planted documents."""

from array import array

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF001
from pacewise.llm import decontaminate, linededup, neardup, oracle, quality, queries


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF001}/documents.parquet')")
    got = queries.QUERIES[name](spark, SF001)
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({oracle.ORACLE_SQL[name]})").fetchall()
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_stages_in_order(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "bpe_encoding"]
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = quality.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    kept = {r["doc_id"]: r["text"] for r in quality.rules(docs, model).where("kept").collect()}
    frame = lambda d: spark.createDataFrame(sorted(d.items()), "doc_id bigint, text string")
    lines = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(frame(kept)).collect() if r["n_removed"] == 0 or r["text"].split()}
    near = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(frame(lines)).collect()}
    single = {d: t for d, t in lines.items() if near[d] == d}
    clean = {r["doc_id"]: r["text"] for r in decontaminate.contamination(frame(single), spark.read.parquet(f"{SF001}/benchmark.parquet")).collect()
             if not r["contaminated"]}
    assert len(docs.collect()) > len(kept) > len(single) > len(clean) > 0
    library = Tokenizer.from_file(queries.VOCABULARY)
    want = {d: array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for d, t in clean.items()}
    assert {r["doc_id"]: bytes(r["ids"]) for r in corpus_pipeline.run(spark, SF001).collect()} == want


def test_stages_keep_the_columns_and_stand_odd_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = docs.limit(30).unionByName(spark.createDataFrame([(900, None, None, None, None), (None, "", "en", "s", 0), (901, "x " * 3000, "en", "s", 6000)], docs.schema))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, odd, SF001).columns == docs.columns, name
        stage(spark, odd, SF001).collect()
    assert corpus_pipeline.near_dedup(spark, odd.unionByName(odd), SF001).where("doc_id is not null").count() == \
        corpus_pipeline.near_dedup(spark, odd, SF001).where("doc_id is not null").count()


def test_near_dedup_keeps_texts_of_rows_without_or_with_shared_ids(spark):
    text = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    rows = [(None, text(0)), (None, text(1)), (None, text(1)), (None, text(2)), (None, text(2) + " more"), (None, text(3)),
            (5, text(3)), (7, text(4)), (7, text(5)), (7, text(5)), (8, text(6)), (6, text(6) + " end"), (9, ""), (9, ""), (9, None), (None, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars int")
    kept = [(r["doc_id"], r["text"]) for r in corpus_pipeline.near_dedup(spark, docs, SF001).collect()]
    two = [x for x in kept if x[0] is None and x[1].startswith("w2x0")]
    assert len(two) == 1
    rest = [x for x in kept if x not in two]
    want = [(None, text(0)), (None, text(1)), (5, text(3)), (7, text(4)), (7, text(5)), (6, text(6) + " end"), (9, ""), (9, None), (None, "")]
    assert sorted(rest, key=str) == sorted(want, key=str)
