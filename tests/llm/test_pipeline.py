import pathlib
import sys

import pytest

SF = "/root/testdata/sf0.001"
sys.path.insert(0, str(pathlib.Path(__file__).parents[2]))


@pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test data")
def test_run_equals_brute_force(spark):
    import corpus_pipeline
    from quern.llm import bpe, toxicity
    from quern.llm.labelled import remainder
    from test_decontamination import brute, norm
    from test_exact_dedup import low
    from test_ngram_join import closure, grams

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    model = toxicity.trained(docs, spark.read.parquet(f"{SF}/labels.parquet"), "toxic", remainder("doc_id", 3) != 1)
    score = {r.doc_id: r.score for r in toxicity.scored(docs, model).collect()}
    left = [i for i in sorted(text) if score[i] < 0.7]
    last = {low(text[i]): i for i in left}
    left = [i for i in left if last[low(text[i])] == i]
    sets = {i: grams(text[i]) for i in left}
    edges = [(a, b) for k, a in enumerate(left) for b in left[k + 1 :] if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    root = closure(left, edges)
    left = [i for i in left if root[i] == i]
    items = [norm(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {i for i in left if any(t in norm(text[i]) for t in items)}
    left = [i for i in left if i not in exact]
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) <= set(left)
    for i in set(left) - set(out):  # near copies of an item
        assert any(brute(t, norm(text[i])) <= 0.2 * len(t) for t in items)
    own = bpe.Bpe(bpe.vocabulary())
    assert all(out[i].n_tokens == len(own.encode([text[i]])[0]) for i in out)


def test_stages_keep_columns_and_survive_empty_tables(spark):
    import corpus_pipeline

    empty = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SF)
        assert out.collect() == []
        if name != "bpe":
            assert out.dtypes == empty.dtypes


@pytest.mark.skipif(not pathlib.Path(SF).exists(), reason="no test data")
def test_stages_with_nulls_repeats_and_clashing_columns(spark):
    import corpus_pipeline

    a = "one two three four five six seven eight nine ten eleven twelve"
    leak = spark.read.parquet(f"{SF}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(5, a), (6, a.upper()), (6, "quite another text"), (6, "quite another text"), (None, a), (None, None), (7, None), (8, ""), (9, f"so {leak} it is"), (3, a + " more"), (4, "w " * 150_000), (4, leak)]
    schema = "doc_id long, text string, lang string, source string, n_chars int, place int, gone string, own_sha int, hits int, kid int, score double, y int"
    docs = spark.createDataFrame([(i, t, None, "s", None, n, "g", 1, 2, 3, 0.5, 4) for n, (i, t) in enumerate(rows)], schema).repartition(3)
    stages = dict(corpus_pipeline.STAGES)
    left = {}
    for name in ("toxicity", "exact_dedup", "ngram_jaccard", "decontamination"):
        out = stages[name](spark, docs, SF)
        assert out.dtypes == docs.dtypes
        left[name] = sorted(r.place for r in out.collect())
    assert set(left["toxicity"]) >= {5, 6, 7}
    assert left["exact_dedup"] == [1, 2, 3, 7, 8, 9, 10, 11]
    assert left["ngram_jaccard"] == [2, 3, 4, 5, 6, 7, 9, 10, 11]  # the passage with words around it is a near copy of the passage
    assert left["decontamination"] == [0, 1, 2, 3, 4, 5, 6, 7, 9, 10]
    assert stages["bpe"](spark, docs, SF).count() == len(rows)
