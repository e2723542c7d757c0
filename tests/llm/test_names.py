"""Columns that have the names operators use inside, items without id, and workers without the package."""

import subprocess
import sys

from pyspark.sql import functions as F

from ledgerflow.llm import common, decontaminate, main_text, passages, quality, url_filter

INSIDE = ("doc_b", "_spans", "_gone", "_sieve_bit", "_best", "_url", "_host", "_salt", "_GONE_")


def crowded(df):
    return df.select("*", *[F.lit(n).alias(n) for n in INSIDE])


def kept(rows):
    return all(r[n] == n for r in rows for n in INSIDE)


def test_no_inner_name_clashes(spark):
    base = " ".join(f"w{i}" for i in range(70))
    docs = crowded(spark.createDataFrame([(1, base), (2, f"{base} tail of it"), (3, "other words")], "doc_id long, text string"))
    ids = spark.createDataFrame([(3,)], "doc_id long")
    left = common.drop_ids(docs, ids).collect()
    assert {r["doc_id"] for r in left} == {1, 2} and kept(left)
    cut = passages.remove_passages(docs, passages.passage_pairs(docs)).collect()
    assert {r["doc_id"]: r["text"] for r in cut} == {1: base, 2: "tail of it", 3: "other words"} and kept(cut)
    rules = spark.createDataFrame([("net", "/", "block")], "host string, path string, action string")
    pages = crowded(spark.createDataFrame([(1, "http://a.net/x", "<article><p>Text</p></article>"), (2, None, None)], "page_id long, url string, html string"))
    judged = url_filter.judge_urls(pages, rules).collect()
    assert {r["page_id"]: r["verdict"] for r in judged} == {1: "block", 2: "allow"} and kept(judged)
    texts = main_text.extract(pages).collect()
    assert {r["page_id"]: r["text"] for r in texts} == {1: "Text", 2: ""} and kept(texts)


def test_items_without_id_are_items(spark):
    item = " ".join(f"q{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"a b {item} c"), (2, "clean text of its own")], "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (None, item), (7, None)], "item_id long, text string")
    assert [r["doc_id"] for r in decontaminate.clean(docs, items).collect()] == [2]


def test_scores_on_workers_without_the_package(tmp_path):
    """The workers start in a folder from which the package cannot be imported."""
    script = tmp_path / "job.py"
    script.write_text(f"""
import os, sys
sys.path.insert(0, {str(common.__file__.rsplit('/ledgerflow/', 1)[0])!r})
os.environ.pop("PYTHONPATH", None)
from ledgerflow.config import session
from ledgerflow.llm import quality
spark = session("bare", "local[1]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "1", "spark.checkpoint.dir": {str(tmp_path)!r}}})
docs = spark.createDataFrame([(i, "good words here " * 5 if i % 2 else "bad bad bad bad") for i in range(20)], "doc_id long, text string")
labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
print("rows", quality.judge(docs, labels).count(), quality.judge(docs, labels).where("predicted = doc_id % 2").count())
""")
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows 20 20" in done.stdout, done.stderr[-2000:]
    assert quality.Settings().sample == 4000
