"""The pipeline's stages one after the other, each against its own input."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from aeroseries.llm import langid
from test_contamination import plain as contaminated
from test_jaccard import plain as classes
from test_lines import plain as lines

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    tests = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontamination", "sentencepiece"]
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        after = {r["doc_id"]: r["text"] for r in docs.collect()}
        if name != "sentencepiece":
            assert docs.columns == columns
        if name == "language_id":
            want = {k: t for k, t in before if t and any(c.isalpha() for c in t)}
        elif name == "line_dedup":
            gone = lines(before, radius=64)
            want = {}
            for k, t in before:
                text = "\n".join(x for i, x in enumerate(t.split("\n")) if i not in set(gone[k, t]))
                if not gone[k, t] or any(c.isalnum() for c in text):
                    want[k] = text
            assert docs.where(F.col("n_chars") != F.length("text")).count() == 0
        elif name == "jaccard_join":
            want = {k: t for k, t in before if k in {c for _, c, _ in classes(before)}}
        elif name == "decontamination":
            bad = {r[0] for r in contaminated(before, tests, 10) if r[-1]}
            want = {k: t for k, t in before if k not in bad}
        else:
            want = dict(before)
            assert docs.where("not round_trip or size(ids) = 0").count() == 0
        assert after == want, name


def test_run_is_the_stages(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "text", "lang", "source", "n_chars", "ids", "round_trip"} == set(got.columns)
    assert 0 < got.count() <= 200


def test_language_stage_keeps_only_learned_languages(spark, docs):
    kept = corpus_pipeline.language_stage(spark, docs, SF)
    model = langid.train(docs)
    assert kept.columns == docs.columns
    assert kept.count() == langid.identify(docs, model).where("lang_pred <> 'und'").count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_odd_empty_and_clashing_rows(spark, docs, empty, clashing, stage):
    assert stage(spark, empty, SF).count() == 0
    got = stage(spark, docs, SF)
    assert set(docs.columns) <= set(got.columns)
    key = lambda df: sorted(str((r["doc_id"], r["text"], r["lang"])) for r in df.select("doc_id", "text", "lang").collect())
    both = stage(spark, clashing, SF)
    assert set(clashing.columns) <= set(both.columns) and key(both) == key(got)
    ids = [r["doc_id"] for r in got.select("doc_id").collect()]
    # Null ids and repeated rows go through; equal rows fold only where near duplicates do.
    if stage is not corpus_pipeline.near_duplicate_stage:
        assert ids.count(13) == 2
    assert 5 in ids
