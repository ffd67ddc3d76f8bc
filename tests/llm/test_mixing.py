"""Mixing of sources: targets, permutations, blocks and what is taken."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lineflow.llm import mixing, queries
from lineflow.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_targets(sizes):
    """Shares by weight 1, 2, 3, repeating; whoever is above three times its size stops there, until none is."""
    weights, out, free = [1 + i % 3 for i in range(len(sizes))], [0.0] * len(sizes), set(range(len(sizes)))
    while free:
        left = sum(sizes) - sum(out[i] for i in range(len(sizes)) if i not in free)
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = {i for i in free if share[i] > 3 * sizes[i]}
        for i in over or free:
            out[i] = 3.0 * sizes[i] if over else share[i]
        free -= over or free
    return out


@given(st.lists(st.integers(0, 10_000), max_size=12))
@settings(max_examples=200, deadline=None)
def test_targets(sizes):
    got = mixing.targets(np.array(sizes, np.int64), np.array([1.0 + i % 3 for i in range(len(sizes))]))
    assert got == pytest.approx(plain_targets(sizes))
    assert sum(got) == pytest.approx(sum(sizes)) and all(t <= 3 * s + 1e-6 for t, s in zip(got, sizes))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 64, 100, 1000])
def test_permutations(n):
    a, b = (mixing.permuted(np.arange(n), np.int64(n), np.int64(key)).tolist() for key in (1, 2))
    assert sorted(a) == sorted(b) == list(range(n))
    assert n < 17 or a != b


def check(out, rows):
    """out: the query's rows; rows: (doc_id, text, source)."""
    size = {}
    for doc_id, text, source in rows:
        size.setdefault((source is None, source or ""), []).append(len(WORD.findall(text or "")))
    order = sorted(size, key=lambda k: (k[0], k[1].encode()))
    target = dict(zip(order, plain_targets([sum(size[k]) for k in order])))
    want = Counter()
    for doc_id, text, source in rows:
        k = source is None, source or ""
        want[doc_id, len(WORD.findall(text or "")), sum(size[k]), round(target[k], 6)] += 1
    assert Counter((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6)) for r in out) == want
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in out)
    got = defaultdict(int)
    for r in out:
        got[r["source_size"], round(r["target"], 6)] += r["taken"]
    asked = defaultdict(float)
    for k in order:
        asked[sum(size[k]), round(target[k], 6)] += target[k]
    for k, n in got.items():
        assert abs(n - asked[k]) <= 2 * mixing.BLOCK + 0.01 * asked[k]


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text", "source").collect()]
    check(queries.op13_mixing(spark, sf_dir).collect(), rows)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    docs = odd_docs.withColumnRenamed("score", "k")
    check(mixing.taken(*mixing.mix(docs, texts=False)).collect(), rows)
    assert mixing.taken(*mixing.mix(no_docs)).count() == 0
    blank = odd_docs.where("size(split(trim(text), ' ')) = 0 or text is null")
    assert [r["taken"] for r in mixing.taken(*mixing.mix(blank)).collect()] == [0] * blank.count()


def test_reruns_agree_however_rows_are_dealt(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    run = lambda d: sorted(tuple(r) for r in mixing.taken(*mixing.mix(d, texts=False)).drop("row").collect())
    assert run(docs) == run(docs.repartition(7))


def test_blocks_hold_the_words_of_their_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BIN_WORDS", 300)  # several bins a source
    texts = {i: " ".join(f"w{i}x{j}" for j in range(n)) for i, n in enumerate([5, 700, 64, 1, 130, 33] * 3)}
    docs = spark.createDataFrame([(i, f" {t}\n", "ab"[i % 2]) for i, t in texts.items()], "doc_id long, text string, source string")
    documents, mixed = mixing.mix(docs, {"a": 1, "b": 5}, shard=10)
    of_row = {r["row"]: r["doc_id"] for r in documents.collect()}
    rows = mixed.collect()
    length = Counter()
    for r in rows:
        assert r["words"].split() == texts[of_row[r["row"]]].split()[r["start"] : r["start"] + r["n"]]
        length[r["shard"], r["k"], r["block"]] += r["n"]
    assert len({r["shard"] for r in rows}) > 1
    assert max(length.values()) <= 3 * mixing.BLOCK and set(Counter(n % mixing.BLOCK for n in length.values())) >= {0}
    total = {r["source"]: (r["source_size"], r["target"]) for r in documents.collect()}
    assert total["b"][1] == pytest.approx(min(sum(s for s, _ in total.values()) * 5 / 6, 3 * total["b"][0]))


def test_more_sources_than_are_sent(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "some words of text " * i, None if i % 7 == 0 else f"s{i % 7}") for i in range(60)], "doc_id long, text string, source string")
    run = lambda: sorted(tuple(r) for r in mixing.taken(*mixing.mix(docs, texts=False)).drop("row").collect())
    first = run()
    monkeypatch.setattr(mixing, "SENT_SOURCES", 0)
    assert run() == first
