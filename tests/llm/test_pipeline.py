import pytest

import corpus_pipeline
from stintlab.llm import decontaminate, jaccard_join, langid, mixing
from stintlab.llm.common import crc_fold, read
from tests.llm.tables import ODD_ROWS, docs, with_extra_columns

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage but the last, on the smallest tables."""
    from stintlab.llm.common import stage

    table, out = read(spark, DATA, "documents"), []
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, table, DATA))
        out.append((name, table, after))
        table = after
    return {name: (before, after) for name, before, after in out}


def ids(table):
    return {r["doc_id"] for r in table.select("doc_id").collect()}


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "jaccard_join", "decontaminate", "mix_sources", "token_output"]
    for name, (before, after) in stages.items():
        assert name == "token_output" or after.columns == before.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_every_decision_takes_effect(spark, stages):
    before, after = stages["jaccard_join"]
    classes = jaccard_join.similarity_classes(before).collect()
    assert ids(after) == {r["doc_id"] for r in classes if r["doc_id"] == r["component_id"]}
    before, after = stages["decontaminate"]
    leaks = decontaminate.find_leaks(before, decontaminate.leak_indexes(read(spark, DATA, "benchmark")))
    assert ids(after) == ids(before) - ids(leaks)
    before, after = stages["mix_sources"]
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect()}
    assert {r["doc_id"]: r["count"] for r in after.groupBy("doc_id").count().collect()} == {i: n for i, n in taken.items() if n}
    before, after = stages["language_id"]
    model = langid.train_languages(before, crc_fold(before["doc_id"], 4) != 2)
    known = {r["doc_id"] for r in langid.predict_languages(before, model).collect() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    assert ids(after) == known
    before, after = stages["token_output"]
    assert after.count() == before.count()


def test_run_gives_the_last_stage(spark, stages):
    rows = lambda t: sorted(tuple(r) for r in t.collect())
    assert rows(corpus_pipeline.run(spark, DATA)) == rows(stages["token_output"][1])


def test_stages_take_awkward_rows_and_empty_tables(spark):
    for table in (with_extra_columns(docs(spark, ODD_ROWS)), docs(spark, []), docs(spark, [(1, None, None, None)])):
        for name, step in corpus_pipeline.STAGES[:-1]:
            assert step(spark, table, DATA).columns == table.columns
        step(spark, table, DATA).count()
