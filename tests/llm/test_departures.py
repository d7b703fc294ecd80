"""Cases that went wrong once: clashing names, layouts, units, letters, large hosts, executors without the package."""

import os
import subprocess
import sys
import textwrap
from pathlib import Path

import public_tokenizers
import pyarrow as pa
from helpers import OTHER, PROSE

from rowsmith.llm import classifier, decontam, html, jaccard, langid, lm
from rowsmith.llm.text import free_name

BPE = public_tokenizers.path("byte_bpe_50k.json")


def test_stages_take_columns_with_the_names_they_use(spark):
    names = ["__key", "__GONE", "__body", "__noise", "__found", "n", "__id", "__text"]
    docs = [(i, f"{PROSE} {OTHER} {i}", *[f"{n}{i}" for n in names]) for i in range(8)] + [(90, None, *names)]
    frame = spark.createDataFrame(docs, ["doc_id", "text", *names])
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id bigint, quality int, toxic int")
    items = spark.createDataFrame([(1, OTHER)], "item_id bigint, text string")
    for kept in (
        classifier.keep_quality(frame, labels),
        jaccard.keep_one(frame),
        decontam.clean(frame, items),
    ):
        assert kept.columns == frame.columns
        rows = kept.collect()
        assert rows and all(r["__key"] == (f"__key{r.doc_id}" if r.text else "__key") for r in rows)
    assert free_name(frame, "__gone") == "__gone_" and free_name(frame, "other") == "other"


def test_units_count_only_after_numbers():
    t = decontam.Template(pa.array(["a cat sat a second on a mat", "12 km in 5 min or 3.5 kg, km 4", "9 \n m", "7", "km"]))
    by_row = [t.kinds[1][t.row == i].tolist() for i in range(5)]
    assert by_row[0] == [0] * 8
    assert by_row[1] == [1, 3, 0, 1, 3, 0, 1, 3, 0, 1] and by_row[2] == [1, 3] and by_row[4] == [0]


def test_letters_are_of_category_l(spark):
    assert not any(map(langid.has_letter, ["½ ² Ⅷ ①", "", None, "12 - _ ‿", "😀"]))
    assert all(map(langid.has_letter, ["1a", "漢", "ª", "½é"]))


def test_scores_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_DOCS", 5)
    docs = [(i, f"{PROSE[i % 40:]} {OTHER[: 3 * i]} w{i % 7}") for i in range(90)] + [(95, None), (None, "x")]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = [
        sorted((str(r.doc_id), r.base_score, r.score) for r in lm.score(frame.repartition(n, "text"), BPE).collect())
        for n in (1, 7)
    ]
    assert found[0] == found[1]


def test_large_hosts_keep_their_texts(spark):
    def page(i, tag):
        own = "".join(f"<p>Paragraph {k} of page {i}</p>" for k in range(2))
        return f"<html><head><title>t</title></head><body><div class=top><b>Slogan</b></div><{tag}><h1>Head {i}</h1>{own}</{tag}></body></html>"

    rows = [(i, f"http://big.example/{i}", page(i, "article")) for i in range(1_000)]
    rows += [(2_000 + i, f"http://plain.example/{i}", page(i, "div")) for i in range(1_000)]
    rows += [(4_000 + i, f"http://few{i % 3}.example/{i}", page(i, "div")) for i in range(6)]
    found = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    own = lambda i: f"Head {i}\nParagraph 0 of page {i}\nParagraph 1 of page {i}"
    # Without an article the slogan goes because all pages of the site have it; of two pages it stays.
    assert all(found[i] == own(i) and found[2_000 + i] == own(i) for i in range(1_000))
    assert all(found[4_000 + i].endswith(own(i)) for i in range(6))


def test_importance_of_a_branch_is_that_of_its_best_node():
    tree = {1: (None, 0.0, None), 2: (1, 0.0, None), 3: (2, 0.0, 0.9), 4: (1, 0.1, 0.05), 5: (4, 0.0, 0.0)}
    assert html.importance(tree) == {1: 0.9, 2: 0.9, 3: 0.9, 4: 0.1, 5: 0.0}


def test_executors_need_no_copy_of_the_package(tmp_path):
    """The driver finds the package by an import path that its workers don't get."""
    top = Path(lm.__file__).resolve().parents[2]
    script = f"""
    import sys
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    sys.path.insert(0, {str(top)!r})
    from rowsmith.llm import langid, lm, retrieval, runs, superkmers

    docs = spark.createDataFrame([(i, "one two three four five " * 5, "en") for i in range(9)], "doc_id bigint, text string, lang string")

    def without(batches):
        import importlib.util

        assert importlib.util.find_spec("rowsmith") is None
        yield from batches

    assert spark.range(3).mapInArrow(without, "id bigint").count() == 3
    assert lm.score(docs, {BPE!r}).count() == 9
    assert langid.identify(docs, {public_tokenizers.path("piece_bpe_32k.model")!r}).count() == 9
    assert runs.find_runs(docs).count() == 9 and superkmers.dedup(docs).count() == 9
    assert retrieval.search(docs, docs.withColumnRenamed("doc_id", "item_id")).count() == 81
    """
    file = tmp_path / "fresh.py"
    file.write_text(textwrap.dedent(script))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(file)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
