"""The pipeline's stages one by one against brute force on the small tables, and the registered queries."""

import os
from collections import defaultdict

import pytest
from test_dedup import brute_kept, brute_removed
from test_tokens import check_pieces, tokenizer  # noqa: F401

import __spark_entry__ as entry
import check_oracle
import corpus_pipeline
from tidemark.llm import queries, substring
from tidemark.llm.common import written

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


def test_stages(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact_dedup", "simhash_near_dedup", "substring_dedup", "packing"]

    clean = written(stages["toxicity"](spark, docs, FOLDER), "test")
    assert clean.columns == docs.columns and 0 < clean.count() <= docs.count()

    once = written(stages["exact_dedup"](spark, clean, FOLDER), "test")
    groups = defaultdict(list)
    for r in clean.collect():
        groups[r.text].append(r.doc_id)
    assert {r.doc_id for r in once.collect()} == {max(ids) for ids in groups.values()}

    near = written(stages["simhash_near_dedup"](spark, once, FOLDER), "test")
    rows = sorted((r.doc_id, r.text) for r in once.collect())
    assert sorted(r.doc_id for r in near.collect()) == brute_kept(rows)

    rest = written(stages["substring_dedup"](spark, near, FOLDER), "test")
    assert rest.columns == docs.columns
    rows = sorted((r.doc_id, r.text) for r in near.collect())
    want = brute_removed(rows, substring.Span())
    got = {r.doc_id: r.text for r in rest.collect()}
    for i, text in rows:
        kept = [text[a:b] for (a, b), stay in zip(substring.sentences(text), want[i]) if stay]
        assert got[i].split() == " ".join(kept).split()  # what is left of an overlong sentence may be one sentence

    packed = stages["packing"](spark, rest, FOLDER)
    check_pieces([tuple(r) for r in packed.collect()], got, tokenizer)


def test_run_is_the_stages(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    con = check_oracle.connect(FOLDER)
    assert check_oracle.compare(spark, con, FOLDER, name) == ""


def test_one_query_per_operator():
    numbers = [int(q[2:].split("_")[0]) for q in entry.queries() if q.startswith("op")]
    assert sorted(numbers) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_run_on_odd_documents(spark, odd_docs, no_docs, tmp_path):
    """Nulls, repeats and clashing names from the first stage to the last, and no documents at all."""
    labels = spark.createDataFrame([(5, 1, 0), (8, 0, 0), (9, 1, 0)], "doc_id long, quality int, toxic int")
    for name, docs in (("odd", odd_docs), ("none", no_docs)):
        docs.drop("dotted.name").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
    odd = corpus_pipeline.run(spark, f"{tmp_path}/odd").collect()
    assert {5, 9} <= {r.doc_id for r in odd} and all(r.length > 0 for r in odd)
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
