"""Corpus queries and the pipeline on the smallest test tables."""

import glob
import os
import re

import duckdb
import pytest

pytest.importorskip("public_tokenizers")

import corpus_pipeline  # noqa: E402
from meterloom.llm import queries  # noqa: E402
from tools.check import rows_of  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.parametrize("name", list(queries.CHECKS))
def test_matches_sql(spark, con, name):
    got = rows_of(queries.QUERIES[name](spark, FOLDER).toPandas())
    assert got == rows_of(con.execute(queries.CHECKS[name]).df())


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in queries.CHECKS and not n.startswith("op13")])
def test_has_a_row_for_each_document(spark, name):
    got = queries.QUERIES[name](spark, FOLDER)
    ids = [r.doc_id for r in got.select("doc_id").collect()]
    n = spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert len(ids) == len(set(ids)) == n


def test_pieces_cover_each_document_and_fill_sequences(spark):
    got = queries.QUERIES["op13_tournament_packing"](spark, FOLDER).collect()
    docs, inside = {}, {}
    for r in got:
        docs.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length))
        inside.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(docs) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for spots, whole in [(sorted(v), k[1]) for k, v in docs.items()] + [(sorted(v), None) for v in inside.values()]:
        ends = [0]
        for at, n in spots:
            assert at == ends[-1]
            ends.append(at + n)
        assert ends[-1] == whole if whole else ends[-1] <= 2048
    total = sum(r.length for r in got)
    padded = sum(2048 - n for n in (sum(n for _, n in v) for v in inside.values()) if n & (n - 1))
    assert padded < 0.03 * total


def test_url_query_runs_without_python(spark):
    plan = queries.QUERIES["op4_redirect_equivalence"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_pipeline_stages(spark):
    import sentencepiece

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    bad = {r.doc_id for r in spark.read.parquet(f"{FOLDER}/labels.parquet").filter("quality = 0").collect()}
    steps = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == columns
        steps.append(docs.collect())
    good, exact, near, mixed = steps
    assert not bad & {r.doc_id for r in good}
    body = lambda r: re.sub(r"[\x20\x09-\x0D]+", "", r.text)
    assert {body(r) for r in good} == {body(r) for r in exact} and len(exact) == len({body(r) for r in exact})
    sets = {}
    for r in exact:
        w = r.text.lower().split()
        sets[r.doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    kept = [r.doc_id for r in near]
    alike = lambda a, b: len(sets[a] & sets[b]) * 100 >= 80 * len(sets[a] | sets[b]) > 0
    assert not any(alike(a, b) for i, a in enumerate(kept) for b in kept[:i])
    assert all(any(alike(a, b) for b in sets if b != a) for a in set(sets) - set(kept))
    of = {r.doc_id: " ".join(r.text.encode().decode().split()) for r in near}
    assert all(r.text in of[r.doc_id] and r.n_chars == len(r.text) for r in mixed)
    path = queries.public_tokenizers.path(queries.PIECE_VOCABULARY)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = corpus_pipeline.encode(spark, docs, FOLDER).collect()
    assert sorted((r.doc_id, *r.ids) for r in ids) == sorted((r.doc_id, *sp.encode(r.text, add_eos=True)) for r in mixed)
    assert all(r.n_tokens == len(r.ids) for r in ids)
