"""The pipeline against the same stages in SQL, plain Python and the tokenizer's own library."""

import duckdb
import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from pricetide.llm import mixing, quality_rules, sentencepieces
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"


def expected():
    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    kept = {r[0] for r in connection.execute(f"SELECT doc_id FROM ({quality_rules.SQL}) WHERE kept").fetchall()}
    docs = [r for r in connection.execute("SELECT doc_id, text, lang, source FROM documents ORDER BY doc_id").fetchall() if r[0] in kept]
    sizes = [len(docs)]
    root, _ = brute.classes([r[:2] for r in docs])
    docs = [r for i, r in enumerate(docs) if root[i] == i]  # rows ascend by id, so roots are the smallest
    sizes.append(len(docs))
    cut = brute.repeated_strings([r[:2] for r in docs], 200)
    docs = [(r[0], c[5], *r[2:]) for r, c in zip(docs, cut) if c[5]]
    sizes.append(len(docs))
    connection.execute("CREATE OR REPLACE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", docs)
    mixed = connection.execute(f"SELECT doc_id FROM ({mixing._sql(corpus_pipeline.RECIPE)}) WHERE copies > 0").fetchall()
    chosen = {r[0] for r in mixed}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(sentencepieces.MODEL))
    docs = [(d, lang, source, library.encode(t)) for d, t, lang, source in docs if d in chosen]
    return docs, [*sizes, len(docs)]


def test_pipeline(spark):
    docs, sizes = expected()
    assert sizes[0] > sizes[1] and sizes[2] > sizes[3]
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.lang, r.source, list(r.ids)) for r in rows) == sorted(docs)


@pytest.mark.parametrize("nulls", [False, True])
def test_stages_take_empty_and_odd_tables(spark, nulls):
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (None, "", None, "src1", 0), (None, None, None, None, None), (2, "a b c", "en", None, 5)] if nulls else []
    for name, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(rows, kinds)
        out = stage(spark, docs, FOLDER)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        out.collect()
