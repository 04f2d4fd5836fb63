"""The pipeline's stages on a small corpus with planted cases, and the queries that have SQL."""

import duckdb
import numpy as np
import public_tokenizers
import sentencepiece
from comparing import connect, duckdb_rows, spark_rows

import corpus_pipeline
from headway.llm import queries, simhash
from headway.llm.shared import keep

FOLDER = "/root/testdata/sf0.001"


def test_stages_with_planted_cases(spark, tmp_path):
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    item = duckdb.sql(f"SELECT text FROM '{FOLDER}/benchmark.parquet' WHERE length(text) > 120 LIMIT 1").fetchall()[0][0]
    base = source.where("lang = 'en' and n_chars between 800 and 2000").orderBy("doc_id").first()
    planted = [
        (9001, base.text, "en", "p", 1),
        (9002, base.text.replace(base.text.split()[40], "changed", 1), "en", "p", 1),
        (9003, "Of the and in that was by. " + item.upper() + " And the of it is for.", "en", "p", 1),
        (9004, "The that of and this with from. password=abcdef123456 Was in the on.", "en", "p", 1),
        (9005, "123 456", "en", "p", 1),
        (9006, None, "en", "p", 1),
    ]
    source.select("doc_id", "text", "lang", "source", "n_chars").unionByName(
        spark.createDataFrame(planted, "doc_id long, text string, lang string, source string, n_chars long")
    ).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, str(tmp_path)))
        kept[name] = {r.doc_id for r in docs.select("doc_id").collect()}
        if name != "tokens":
            assert docs.columns == source.columns
        if name == "secrets":
            text = docs.where("doc_id = 9004").first()
            assert text.text == "The that of and this with from. [SECRET] Was in the on." and text.n_chars == len(text.text)
            texts = {r.doc_id: r.text for r in docs.collect()}
    assert not {9005, 9006} & kept["language_id"] and {9001, 9002, 9003, 9004} <= kept["language_id"]
    assert 9001 not in kept["near_duplicates"] and {9003, 9004} <= kept["near_duplicates"]
    a, b = (simhash.fingerprint(t.encode()) for t in (base.text, planted[1][1]))
    assert (9002 in kept["near_duplicates"]) == (((a ^ b) % (1 << 64)).bit_count() > 3)
    assert 9003 not in kept["decontamination"] and kept["decontamination"] == kept["secrets"] == kept["tokens"]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECES))
    for r in docs.collect():
        assert r.ids == library.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(r.ids) and np.array(r.ids).min() >= 1


def test_queries_equal_their_sql(spark):
    duck = connect(FOLDER)
    for name, sql in queries.SQL.items():
        columns, rows = spark_rows(queries.QUERIES[name](spark, FOLDER))
        expected_columns, expected = duckdb_rows(duck, sql)
        assert columns == expected_columns and rows == expected and rows
