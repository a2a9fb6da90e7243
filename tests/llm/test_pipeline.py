"""The pipeline against its stages done one after the other in Python, and the entry without this package."""

import os
import subprocess
import sys

import numpy as np
import pyarrow as pa

import __spark_entry__ as E
import corpus_pipeline
from tests.llm.helpers import SF, components
from tillsight.llm import decontaminate, pii, registry, toxicity
from tillsight.llm.common import slices, worker_state
from tillsight.llm.tokens import BatchEncoder, tokenizer_path

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_queries_are_registered():
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "decontamination", "personal_data",
                                                      "packing"]


def test_stages_take_effect(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r.text for r in docs.collect()}
    model = registry.toxicity_model(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    matcher = model.matcher()
    rows = {d: t for d, t in rows.items() if model.score(matcher.load(toxicity.words_of(t or ""))[0]) < 0.5}
    first = components(rows.items())
    rows = {d: t for d, t in rows.items() if first[d] == d}
    items = spark.read.parquet(f"{sf}/benchmark.parquet").collect()
    texts = decontaminate.normalise(pa.array([r.text for r in items])).to_pylist()
    found = decontaminate.Matcher([(r.item_id, t) for r, t in zip(items, texts, strict=True)])
    clean = decontaminate.normalise(pa.array([t or "" for t in rows.values()])).to_pylist()
    rows = {d: t for (d, t), c in zip(rows.items(), clean, strict=True) if not found.matches(c)}
    anchors = pii._automaton()
    rows = {d: pii.mask(t or "", pii.find_spans(t or "", anchors)) for d, t in rows.items()}
    sizes = np.diff(BatchEncoder(tokenizer_path(registry.BYTE_BPE)).encode(pa.array(rows.values()))[1]) + 1
    got = corpus_pipeline.run(spark, sf)
    total = {r.doc_id: (r.n, r.m) for r in got.groupBy("doc_id").agg(
        {"length": "sum", "doc_tokens": "max"}).toDF("doc_id", "n", "m").collect()}
    assert total == {d: (int(n), int(n)) for d, n in zip(rows, sizes, strict=True)}


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_entry_works_without_the_package():
    code = ("import sys\nfor m in ('tillsight.llm', 'corpus_pipeline'): sys.modules[m] = None\n"
            "import __spark_entry__ as e\nassert 'get_customers' in e.queries() and 'pipeline' not in e.queries()\n"
            "assert not any(k.startswith('op') for k in e.queries())")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=ROOT, env=os.environ | {"PYTHONPATH": ROOT})


def test_a_worker_keeps_nothing_of_another_stage(spark):
    def remember(batches):
        list(slices(batches))
        store = worker_state()
        store["tasks"] = store.get("tasks", 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array([store["tasks"]], pa.int64())], ["tasks"])

    one = spark.createDataFrame([("a",)], "text string").coalesce(1)
    for _ in range(5):  # one job after the other, so a worker is used again
        assert [r.tasks for r in one.mapInArrow(remember, "tasks long").collect()] == [1]
