"""The stages one after the other, and what the entry point registers."""

import random

import pytest
from helpers import OTHER, PROSE, jaccard_components, removed

import __spark_entry__ as entry
import corpus_pipeline


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    random.seed(8)
    words = (PROSE + " " + OTHER).lower().replace(",", "").replace(".", "").split()
    item = "which of these seven rivers carries most water past the old stone bridge in a wet spring"
    docs = [(i, " ".join(random.choice(words) for _ in range(90)), "en", "s", None) for i in range(60)]
    docs += [(100 + i, docs[i][1] + (" more" if i % 2 else ""), "en", "s", 5) for i in range(10)]
    docs += [(200 + i, " ".join(random.choice(words) + "***" for _ in range(90)), "en", "s", 5) for i in range(20)]
    docs += [(300, docs[3][1] + " " + item + " " + PROSE, "en", "s", 1), (301, docs[4][1][:200] + OTHER, None, None, 2)]
    labels = [(i, 1, 0) for i in range(0, 60, 2)] + [(200 + i, 0, 0) for i in range(0, 20, 2)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(
        f"{path}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_each_stage_works_on_what_is_left(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, tables).cache()
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        seen[name] = (docs.collect(), after.collect())
        docs = spark.createDataFrame(after.collect(), after.schema)
    before, after = seen["quality_classifier"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == set(range(200, 220))
    before, after = seen["ngram_jaccard_join"]
    kept = {d for d, _, c in jaccard_components([(r.doc_id, r.text) for r in before]) if d == c}
    assert {r.doc_id for r in after} == kept and not kept & set(range(100, 110))
    before, after = seen["suffix_array_dedup"]
    masks = removed([(r.doc_id, r.text) for r in before])
    left = {r.doc_id: r for r in after}
    for r in before:
        data = zip(r.text.encode(), masks[r.doc_id, r.text], strict=True)
        text = bytes(x for x, gone in data if not gone).decode()
        assert left[r.doc_id].text == text and left[r.doc_id].n_chars == len(text)
    before, after = seen["benchmark_decontamination"]
    assert {r.doc_id for r in before} - {r.doc_id for r in after} == {300}
    before, after = seen["bpe_encoding"]
    assert {r.doc_id: r.text for r in after} == {r.doc_id: r.text for r in before}
    assert all(r.n_tokens * 4 == len(r.ids) for r in after)


def test_the_whole_run_equals_its_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    assert sorted(corpus_pipeline.run(spark, tables).collect()) == sorted(docs.collect())


def test_registered_queries():
    names = list(entry.queries())
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(entry.oracle_sql()) <= set(names)
