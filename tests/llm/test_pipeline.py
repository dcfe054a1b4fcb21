"""The pipeline on the small documents: its stages' contracts and a brute-force walk."""

import corpus_pipeline as C
from quarry.llm import packing
from quarry.sources.tables import table
from tests.conftest import SF_SMALL
from tests.llm.fixtures import awkward
from tests.llm.test_model_ops import brute_classes
from tests.llm.test_text_ops import brute_repeats


def test_stages_against_brute_force(spark):
    docs = table(spark, SF_SMALL, "documents")
    kept = C.near_duplicates(spark, C.materialize(C.quality_rules(spark, docs, SF_SMALL), "t1"), SF_SMALL)
    one = C.materialize(kept, "t2")
    first = {r["doc_id"]: r["text"] for r in C.quality_rules(spark, docs, SF_SMALL).collect()}
    classes = brute_classes(list(first.items()))
    assert {r["doc_id"] for r in one.collect()} == {d for d, c in classes.items() if d == c}
    assert one.columns == docs.columns
    three = C.materialize(C.repeated_passages(spark, one, SF_SMALL), "t3")
    want = brute_repeats([(r["doc_id"], r["text"]) for r in one.collect()])
    got = {r["doc_id"]: r["text"] for r in three.collect()}
    assert set(got) == {d for d, (n, gone, _) in want.items() if gone < n or not n}
    assert all(" ".join(got[d].split()) == want[d][2] for d in got)
    four = C.materialize(C.source_mix(spark, three, SF_SMALL), "t4")
    assert four.columns == docs.columns and {r["doc_id"] for r in four.collect()} <= set(got)
    five = C.packed(spark, four, SF_SMALL).collect()
    assert sum(r["n_words"] for r in five) == sum(len(packing.split_words(r["text"])) for r in four.collect())


def test_run_and_awkward_rows(spark):
    assert C.run(spark, SF_SMALL).count() > 0
    df = awkward(spark)
    for _, stage in C.STAGES[:-1]:
        df = C.materialize(stage(spark, df, SF_SMALL), "t")
        assert df.columns == awkward(spark).columns
    assert C.packed(spark, df, SF_SMALL).count() > 0
