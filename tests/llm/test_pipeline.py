import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lineflow.llm import pii, quality
from lineflow.llm.common import tokenizer_path, written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What goes into each stage, and the last result."""
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(written(stage(spark, docs[-1], SF), f"test-{name}"))
    return docs


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "pii", "packing"]


def test_all_but_the_last_return_documents(stages):
    assert all(s.schema == stages[0].schema for s in stages[1:-1])


def test_quality_keeps_clean_and_drops_junk(spark, stages):
    labels = rows(spark.read.parquet(f"{SF}/labels.parquet"))
    before, after = rows(stages[0]), rows(stages[1])
    assert set(after) <= set(before)
    kept = [(d in after, labels[d].quality == 1) for d in before if d in labels]
    assert np.mean([k for k, good in kept if good]) > 0.97
    assert np.mean([not k for k, good in kept if not good]) > 0.85
    model = quality.learn(stages[0], spark.read.parquet(f"{SF}/labels.parquet"))
    plain = {d for d, r in before.items() if model.score(np.array([quality.statistics((r.text or "").encode())]))[0] >= quality.THRESHOLD}
    assert plain == set(after)


def test_language_keeps_texts_with_letters(stages):
    before, after = rows(stages[1]), rows(stages[2])
    assert set(after) <= set(before) and len(after) > 0.98 * len(before)
    assert all(any(c.isalpha() for c in r.text) for r in after.values())


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_duplicates_leave_one_of_each_group(stages):
    before, after = rows(stages[2]), rows(stages[3])
    sets = {d: shingles(r.text) for d, r in before.items()}
    holders = {}
    for d, s in sets.items():
        for g in s:
            holders.setdefault(g, []).append(d)
    pairs = {(a, b) for ds in holders.values() for a in ds for b in ds if a < b}
    alike = {p: len(sets[p[0]] & sets[p[1]]) / len(sets[p[0]] | sets[p[1]]) for p in pairs}
    assert not [p for p, j in alike.items() if j >= 0.8 and p[0] in after and p[1] in after]
    for d in set(before) - set(after):  # every document that went has a near copy
        assert max(j for p, j in alike.items() if d in p) >= 0.8
    assert min(before) in after


def test_pii_is_replaced(stages):
    before, after = rows(stages[3]), rows(stages[4])
    assert set(before) == set(after)
    spans = {r.doc_id: r["__spans"] for r in pii.find(stages[3]).collect()}
    for d, r in before.items():
        if spans[d]:
            assert all(s.value not in after[d].text for s in spans[d] if s.kind == 0)
            assert after[d].text != r.text and after[d].n_chars == len(after[d].text)
        else:
            assert after[d].text == r.text
    left = pii.find(stages[4]).select(F.sum(F.size("__base"))).first()[0]
    assert left == 0


def test_packing_holds_every_token(spark, stages):
    from tests.llm.test_tokens_records_packing import assert_packed

    docs = [(r.doc_id, r.text) for r in stages[4].collect()]
    assert_packed(stages[5].collect(), docs, Tokenizer.from_file(tokenizer_path()), 2048)


def test_run_equals_its_stages(spark, stages):
    assert corpus_pipeline.run(spark, SF).count() == stages[5].count()


def test_empty_and_odd_documents_pass_through(spark, odd_docs, no_docs):
    for docs in (odd_docs.drop("score"), no_docs):
        for _, stage in corpus_pipeline.STAGES:
            docs = written(stage(spark, docs, SF), "odd")
        docs.count()


def test_clashing_names_stay_as_they_are(spark, odd_docs):
    names = ["__text", "__h", "__g", "__base", "__spans", "__removed", "row", "fp", "component_id", "at", "key", "ids", "lang_pred", "stats", "h"]
    docs = odd_docs.where("doc_id is not null").drop("score").withColumns({n: F.lit(n) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "clash")
        assert docs.columns[-len(names) :] == names, name
        assert all(tuple(r) == tuple(names) for r in docs.select(*names).collect()), name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0


def test_near_duplicates_keep_one_row_of_each_group_whatever_its_id(spark):
    texts = {c: " ".join(f"{c}{i}" for i in range(30)) for c in "abcd"}
    rows = [(1, texts["a"]), (2, texts["a"]), (2, texts["b"]), (None, texts["c"]), (None, texts["c"]), (None, texts["a"]), (3, texts["d"]), (3, texts["d"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(((r.doc_id, r.text[0]) for r in corpus_pipeline.near_duplicate_stage(spark, docs, SF).collect()), key=lambda r: r[1])
    assert kept == [(1, "a"), (2, "b"), (None, "c"), (3, "d")]


def test_removed_documents_have_a_copy_at_the_fixed_bound(stages):
    before, after = rows(stages[2]), rows(stages[3])
    sets = {d: shingles(r.text) for d, r in before.items()}
    for d in set(before) - set(after):
        assert max(len(sets[d] & s) / len(sets[d] | s) for e, s in sets.items() if e != d) >= 0.8
