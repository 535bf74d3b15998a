import random

import corpus_pipeline
import pytest

from viewtide.llm import bpe, simhash
from test_classifiers import DOC, LABEL, corpus, odd  # noqa: F401


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):  # noqa: F811
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, labels = corpus
    rng = random.Random(2)
    clean = [d for d, q in zip(docs, labels) if q[1] and not q[2] and len(d[1]) > 300][:30]
    copies = [(10_000 + k, d[1] if k % 2 else d[1] + " " + rng.choice(["the", "and"]), *d[2:]) for k, d in enumerate(clean)]
    spark.createDataFrame(docs + copies + odd(), DOC).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, LABEL).write.parquet(f"{path}/labels.parquet")
    return path


def test_stages_one_by_one(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, before = docs.columns, docs.count()
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, folder)
        out.write.parquet(f"{tmp_path}/{k}")
        kept = spark.read.parquet(f"{tmp_path}/{k}")
        assert kept.columns[:len(columns)] == columns
        if k < len(corpus_pipeline.STAGES) - 1:
            assert kept.columns == columns
        if name.startswith("SimHash"):
            fps = [r.fingerprint for r in simhash.groups(kept).collect()]
            values = [int(f, 16) for f in fps]
            assert all((a ^ b).bit_count() > 3 for i, a in enumerate(values) for b in values[i + 1:])
        if k < 3:
            assert 0 < kept.count() < before
            before = kept.count()
        docs = kept


def test_run_matches_its_parts(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    codec = bpe.codec(bpe.default_path())
    assert rows and all(r.n_tokens == codec.encode(r.text)[0] for r in rows)


def test_empty(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).collect() == []
