import pytest

import corpus_pipeline
from attesta.llm import latent_leaks, line_spread, ngram_join, queries

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{DATA}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / "out")
        stage(spark, docs, DATA).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(steps):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "near duplicates", "decontamination", "packing"]
    for docs, kept in steps[:-1]:
        assert kept.dtypes == docs.dtypes


def test_quality_rules_follow_the_labels(spark, steps):
    docs, kept = steps[0]
    labels = spark.read.parquet(f"{DATA}/labels.parquet").collect()
    left = ids(kept)
    low = [r.doc_id in left for r in labels if r.quality == 0]
    assert sum(low) <= 0.03 * len(low)
    good = [r.doc_id in left for r in labels if r.quality == 1]
    assert sum(good) >= 0.95 * len(good)


def test_line_dedup_changes_texts_only(steps):
    docs, kept = steps[1]
    assert ids(docs) == ids(kept)
    assert kept.filter("n_chars <> length(text)").count() == 0
    again = line_spread.drop_boilerplate(kept, corpus_pipeline.MIN_SITES).filter("n_removed > 0")
    assert again.count() == 0


def test_one_document_of_each_class_stays(steps):
    docs, kept = steps[2]
    joined = ngram_join.ngram_join(docs).collect()
    assert ids(kept) == {r.class_id for r in joined}


def test_no_leaks_remain(spark, steps):
    docs, kept = steps[3]
    found = ids(latent_leaks.leaks(docs, spark.read.parquet(f"{DATA}/benchmark.parquet"), latent_leaks.fit(docs)))
    assert found and ids(kept) == ids(docs) - found


def test_all_that_is_left_is_packed(spark, steps):
    docs, pieces = steps[4]
    assert ids(pieces) == ids(docs)
    assert queries.pipeline(spark, DATA).count() > 0
