import os
import random

import duckdb
import pytest

import corpus_pipeline
from terroir.llm import queries
from terroir.storage import shared_dir, written

STAGES = ["quality", "near_duplicates", "repeats", "benchmark", "tokens"]


def test_stages_keep_the_columns_of_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    counts = [docs.count()]
    assert [name for name, _ in corpus_pipeline.STAGES] == STAGES
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.dtypes
        docs = written(stage(spark, docs, sf), f"test-{name}")
        assert docs.dtypes == columns
        counts.append(docs.count())
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    whole = corpus_pipeline.run(spark, sf)
    rows = [sorted(map(str, x.select("doc_id", "n_tokens", "ids_sha256").collect())) for x in (final, whole)]
    assert len(rows[0]) == counts[4] and rows[0] == rows[1]
    left = [x for x in os.listdir(shared_dir(spark)) if x.startswith(("scratch", "stage"))]
    assert len(left) == 1 and left[0].startswith("stage-tokens")


def test_every_operator_is_registered():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and queries.oracle_sql().keys() <= names.keys()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_statements(spark, sf, name):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "conversations"):
        db.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    result = db.execute(queries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    expected = sorted(result.fetchall(), key=str)
    assert expected and sorted(map(tuple, queries.queries()[name](spark, sf).select(*names).collect()), key=str) == expected


def test_repeated_passages_of_51_words_go(spark):
    """A passage of short words, far below 400 bytes, between texts that share nothing else; one of 50 words stays."""

    def words(seed, n):
        draw = random.Random(seed)
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 4))) for _ in range(n))

    passage, short = words(1, 51), words(2, 50)
    assert len(passage) < 300
    texts = [f"{words(i, 70)} {passage if i % 2 else short} {words(100 + i, 80)}" for i in range(10, 16)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    left = [r["text"] for r in corpus_pipeline.drop_repeats(spark, docs, "").collect()]
    assert sum(short in t for t in left) == 3 and not any(passage[20:60] in t for t in left)
    assert sorted(left) == sorted(t.replace(passage, "") for t in texts)
