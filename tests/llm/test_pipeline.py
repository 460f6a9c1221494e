"""The pipeline's stages on a small table with planted cases."""

import random

import duckdb
import pytest

import corpus_pipeline
from loghelm.llm.queries import QUERIES, SQL
from test_operators import documents, prose

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    rng = random.Random(3)
    texts = [prose(rng, 60) for _ in range(40)]
    passage, item = prose(rng, 30), prose(rng, 14)
    texts[10] = texts[2]
    texts[11] += " " + passage
    texts[12] = passage + " " + texts[12]
    texts[13] += " " + item
    toxic = set(range(20, 32))
    for i in toxic:
        texts[i] = texts[i].replace(" ", " grumblefoot ", 2)
    docs = documents(spark, texts).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = {}
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.store(stage(spark, rows, str(tmp_path)), name)
        assert rows.schema == docs.schema
        kept[name] = {r["doc_id"]: r["text"] for r in rows.collect()}
    assert set(kept["toxicity"]) == set(range(40)) - toxic
    assert set(kept["simhash_dedup"]) == set(kept["toxicity"]) - {10}
    assert len(kept["suffix_dedup"][12]) < len(texts[12]) and kept["suffix_dedup"][11] == texts[11]
    assert set(kept["decontamination"]) == set(kept["suffix_dedup"]) - {13}
    packed = corpus_pipeline.run(spark, str(tmp_path))
    words = {i: len(t.split()) for i, t in kept["decontamination"].items()}
    assert {r["doc_id"]: r["length"] for r in packed.collect()} == words


def stored(spark, path, docs, toxic, items):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(toxic, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


def test_rows_without_an_id_and_of_one_id_are_judged_alone(spark, tmp_path):
    rng = random.Random(9)
    item = prose(rng, 14)
    texts = [prose(rng, 60) for _ in range(12)]
    texts[1] += " " + item  # no id, contaminated
    texts[4] += " " + item  # shares an id with a clean row
    texts[7] = texts[6]
    ids = [None, None, None, 5, 5, 6, 7, 8, 9, 9, 10, 11]
    rows = [(i, t, "en", "s", len(t)) for i, t in zip(ids, texts)] + [(12, None, None, None, None), (None, None, "en", "s", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stored(spark, tmp_path, docs, [(5, 1, 0)], [(1, item), (2, None), (None, item[:9])])
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = corpus_pipeline.store(stage(spark, rows, str(tmp_path)), name)
        assert rows.schema == docs.schema
    got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or "") for r in rows.collect())
    clean = [(i is not None, i or 0, t) for k, (i, t) in enumerate(zip(ids, texts)) if k not in (1, 4, 7)]
    # of the two rows without a text, equal to each other, the one with an id stays
    assert got == sorted([*clean, (True, 12, "")])
    assert corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().count() == 8


def test_empty_tables(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    stored(spark, tmp_path, spark.createDataFrame([], schema), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for table in ("pages", "documents", "benchmark", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = QUERIES[name](spark, SF)
    result = con.execute(SQL[name])
    columns = [d[0] for d in result.description]
    rows = lambda names, found: sorted(str(tuple(r[names.index(c)] for c in sorted(names))) for r in found)
    assert rows(got.columns, got.collect()) == rows(columns, result.fetchall())
