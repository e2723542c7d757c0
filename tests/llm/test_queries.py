"""The registered queries on the smallest tables: against their SQL, or against a plain computation."""

import os
import zlib

import pytest

from ledgerflow.llm import queries

duckdb = pytest.importorskip("duckdb")
SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_agrees_with_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr([r[c] for c in columns]) for r in df.collect())
    cursor = duck.execute(queries.ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == sorted(repr([r[names.index(c)] for c in columns]) for r in cursor.fetchall())


def test_decontamination_finds_the_items_a_scan_finds(spark, duck):
    """Every item that stands in a document word for word, and no pair below the similarity."""
    norm = lambda t: f" {' '.join(t.lower().split())} "
    docs, items = (duck.execute(f"SELECT * FROM {t}").fetchall() for t in ("documents", "benchmark"))
    whole = {(d[0], i[0]) for d in docs for i in items if norm(i[1]) in norm(d[1])}
    got = queries.QUERIES["op10_decontaminate"](spark, SF).collect()
    pairs = {(r["doc_id"], r["item_id"]) for r in got}
    assert whole and whole <= pairs
    assert all(r["similarity"] >= 0.8 for r in got)
    assert {(r["doc_id"], r["item_id"]) for r in got if r["similarity"] == 1.0} == whole


def test_quality_on_held_out_labels(spark, duck):
    labels = dict(duck.execute("SELECT doc_id, quality FROM labels").fetchall())
    rows = queries.QUERIES["op8_quality"](spark, SF).collect()
    assert len(rows) == duck.execute("SELECT count(*) FROM documents").fetchone()[0]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == q for p, q in judged) >= 0.85 * len(judged)


def test_pieces_decode_to_the_documents(spark):
    rows = queries.QUERIES["op2_sentencepiece"](spark, SF).collect()
    assert rows and all(r["round_trip"] and r["n_pieces"] > 0 for r in rows)
