"""The pipeline's stages, each on what its predecessor kept."""

from __future__ import annotations

import re
from pathlib import Path

import corpus_pipeline
import public_tokenizers
from test_near_dedup import brute_force as near_groups
from tokenizers import Tokenizer

from martloom.llm.common import materialize


def test_stages(spark, sf_dir):
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "test-stage")
        seen.append(docs.collect())
        assert stage is corpus_pipeline.stage_bpe or docs.columns == columns
    good, exact, near, mixed, encoded = seen
    left = {r.doc_id for r in good}
    clean = [d for d, (quality, toxic) in labels.items() if quality and not toxic]
    assert sum(d in left for d in clean) >= 0.98 * len(clean)

    newest = {}
    for r in good:
        newest[r.text or ""] = max(newest.get(r.text or "", -1), r.doc_id)
    assert {r.doc_id for r in exact} == set(newest.values()) and len(exact) == len(newest)

    rows = [(r.doc_id, r.text) for r in exact]
    heads = {component for _, component in near_groups(rows, 5, 80)}
    assert {r.doc_id for r in near} == heads and len(near) == len(heads)

    known = {r.doc_id: r for r in near}
    assert all(known[r.doc_id] == r for r in mixed)
    words = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text or "")) for r in near)
    taken = sum(len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in mixed)
    longest = max(len((r.text or "").split()) for r in near)
    assert abs(taken - words) <= longest * len({r.source for r in near})

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    assert sorted(r.doc_id for r in encoded) == sorted(r.doc_id for r in mixed)
    for r in encoded:
        assert r.ids == library.encode(known[r.doc_id].text or "", add_special_tokens=False).ids and r.decodes


def test_only_results_stay_in_the_shared_folder(spark, sf_dir, tmp_path):
    """Folders of a stage are gone once the next has begun, and a stage's documents stay readable."""
    app = spark.sparkContext.applicationId
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = list(corpus_pipeline._left.get(app, []))
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{tmp_path}/{name}")
        assert not any(Path(p.removeprefix("file:")).exists() for p in before)
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    # A result that is not stored keeps what it reads.
    lazily = corpus_pipeline.stage_exact(spark, corpus_pipeline.stage_exact(spark, docs, sf_dir), sf_dir)
    assert lazily.count() == docs.count()


def test_a_task_of_a_stage_needs_one_python_worker(spark, sf_dir, tmp_path):
    docs = spark.createDataFrame([(1, "a  b\x0bc", "en", "web"), (2, None, None, None), (3, "h\u00e9 \U0001f600", "en", "web")], "doc_id long, text string, lang string, source string")
    docs.write.parquet(f"{tmp_path}/docs")
    out = corpus_pipeline.stage_bpe(spark, spark.read.parquet(f"{tmp_path}/docs"), sf_dir)
    assert out._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert out.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decodes"]
    assert [(r.doc_id, r.n_tokens > 0, len(r.ids) == r.n_tokens, r.decodes) for r in out.orderBy("doc_id").collect()] == [
        (1, True, True, True), (2, False, True, True), (3, True, True, True),
    ]


def test_odd_documents(spark, sf_dir, tmp_path):
    rows = [(1, None, None, None), (2, "", "en", "web"), (3, "a b\x0bc", "en", None), (3, "a b\x0bc", "en", None), (None, "tie", None, "web")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 AS size", "2 AS `a.b`", "true AS KEPT")
    for some in (docs, docs.limit(0)):
        for n, (_, stage) in enumerate(corpus_pipeline.STAGES[1:]):
            some = materialize(stage(spark, some, sf_dir), f"odd-{n}")
            assert n == 3 or some.columns == docs.columns


def test_registered(spark):
    import __spark_entry__ as driver

    names = driver.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14))
