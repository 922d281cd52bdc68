import pytest
from procura.llm import decontaminate, quality, secret_scan, simhash, stages

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, step in corpus_pipeline.STAGES[:-1]:
        out.append(step(spark, out[-1], SF).persist())
    yield out
    for df in out[1:]:
        df.unpersist()


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns(steps):
    for df in steps:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_each_stage_acts_on_all_its_predecessor_kept(spark, steps):
    good = {r.doc_id for r in quality.score(steps[0], spark.read.parquet(f"{SF}/labels.parquet")).collect() if r.predicted}
    assert set(rows(steps[1])) == good
    found = simhash.near_duplicates(steps[1]).collect()
    assert set(rows(steps[2])) == {r.component_id for r in found}
    hits = decontaminate.find_items(steps[2], spark.read.parquet(f"{SF}/benchmark.parquet")).collect()
    assert set(rows(steps[3])) == set(rows(steps[2])) - {r.doc_id for r in hits}
    before, after = rows(steps[3]), rows(steps[4])
    spans = {r.doc_id: r.spans for r in secret_scan.scan(steps[3])[0].collect()}
    assert before.keys() == after.keys()
    for k in before:
        assert (before[k].text == after[k].text) == (not spans[k])
        assert after[k].n_chars == (before[k].n_chars if not spans[k] else len(after[k].text))
    assert not any(r.spans for r in secret_scan.scan(steps[4])[0].collect())


def test_run_packs_what_is_left(spark, steps):
    want = stages.best_fit_packing(spark, steps[4], SF).drop("sequence_id", "offset").collect()
    got = corpus_pipeline.run(spark, SF).drop("sequence_id", "offset").collect()
    assert sorted(want) == sorted(got) and {r.doc_id for r in got} == set(rows(steps[4]))


def test_rows_without_id_or_with_a_repeated_one(spark):
    a, b = "one two three four five", "six seven eight nine ten"
    df = spark.createDataFrame([(1, a, 1), (2, a, 2), (None, a, 3), (3, b, 4), (3, b, 5), (3, a + " x", 6), (None, None, 7), (None, "", 8),
                                (None, None, 9)], "doc_id long, text string, __x int")
    left = simhash.drop_near_duplicates(df, 3, 0).collect()
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted(
        [(1, a), (3, b), (3, a + " x"), (None, None), (None, "")], key=repr)


def test_empty_documents(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, step in corpus_pipeline.STAGES:
        df = step(spark, df, SF)
    assert df.collect() == []
