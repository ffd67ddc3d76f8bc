import glob
import random
import re
import time

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lineflow.llm import components as components_module
from lineflow.llm import simhash
from lineflow.llm.components import components
from lineflow.llm.queries import QUERIES


def plain_fingerprint(text, k):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(n, linked):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in linked:
        a, b = find(i), find(j)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def test_query_equals_brute_force(spark, sf_dir):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    fps = [plain_fingerprint(t, 3) for _, t in docs]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]
    roots = plain_roots(len(fps), near)
    expected = {d: (f"{f:016x}", docs[r][0]) for (d, _), f, r in zip(docs, fps, roots)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash"](spark, sf_dir).collect()} == expected


def test_odd_texts(odd_docs, no_docs):
    got = simhash.groups(odd_docs).collect()
    assert len(got) == 10
    by = {r.doc_id: (r.fp, r.component_id) for r in got if r.doc_id}
    assert by[1] == by[2] == by[3] == (0, 1)
    assert by[4] == by[5] and by[4][1] == 4
    assert [r.component_id for r in got if r.doc_id is None] == [4]
    assert simhash.groups(no_docs).count() == 0


def test_index_finds_all_pairs_in_dense_and_hot_buckets(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 30, dtype=np.uint64)
    fps = {int(b) ^ sum(1 << int(x) for x in rng.integers(0, 64, rng.integers(0, 5))) for b in base for _ in range(20)}
    fps = sorted(fps)
    array = np.array(fps, np.uint64)[:, None]
    differ = np.bitwise_count(array ^ array.T)
    for limit in (0, 1, 3, 6):
        index = simhash.GrayIndex(array, np.zeros(len(fps), int))
        found = {frozenset(p) for a, b in index.search(limit) for p in zip(a.tolist(), b.tolist())}
        assert found == {frozenset((i, j)) for i, j in zip(*np.nonzero(np.triu(differ <= limit, 1)))}
    monkeypatch.setattr(simhash, "BUCKET_ROWS", 7)
    rows = spark.createDataFrame([(i, int(np.uint64(f).view(np.int64))) for i, f in enumerate(fps)], "v long, f0 long")
    got = {r.v: r.root for r in components(simhash.links(rows, 1, 3, simhash.blocks(len(fps), 3))).collect()}
    roots = plain_roots(len(fps), [(i, j) for i, j in zip(*np.nonzero(np.tril(differ <= 3, -1)))])
    assert [got.get(i, i) for i in range(len(fps))] == roots


def test_near_duplicates_catch_edited_copies_and_leave_others(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    docs, group = [], {}
    for g in range(40):
        base = [word() for _ in range(400)]
        for c in range(3):
            copy = list(base)
            for _ in range(5 if c else 0):
                copy[rng.randrange(400)] = word()
            group[len(docs)] = g
            docs.append((len(docs), " ".join(copy)))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert all(got[d] % 3 == 0 and group[got[d]] == group[d] for d in got)


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(100, 200), (200, 150), (7, 7), (None, 3)]
    got = {r.v: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(51)}, 100: 100, 150: 100, 200: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def drawn(rng, n):
    return [f"w{rng.getrandbits(40):x}" for _ in range(n)]


def test_repeated_lines_do_not_change_what_is_alike(spark):
    rng = random.Random(8)
    line = drawn(rng, 14)
    texts = [drawn(rng, 104) + line * 10 for _ in range(2)]
    same = drawn(rng, 204)
    texts += [same, same[:24] + same[:24] * 9 + same]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert simhash.bit_limit(0.8, 256) >= np.bitwise_count(np.bitwise_xor(*(simhash.fingerprint(" ".join(t).encode(), 5, 4) for t in texts[:2]))).sum()
    assert {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()} == {0: 0, 1: 1, 2: 2, 3: 2}


@pytest.mark.parametrize("exact_to", [simhash.SMALL, 1 << 20])
def test_groups_are_those_of_exact_similarity(spark, exact_to):
    """Tails of all lengths, so that similarities lie around 0.8, in short and long texts and one word added; with the index and without."""
    rng = random.Random(9)
    texts = []
    for n in (8, 12, 20, 40, 60, 70, 80, 90, 120, 300):
        for share in (0.02, 0.06, 0.1, 0.11, 0.12, 0.15, 0.2):
            base, cut_ = drawn(rng, n), round(n * share)
            texts += [base, base[: n - cut_] + drawn(rng, cut_), base + drawn(rng, 1)]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    near = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, exact_to=exact_to).collect()}
    assert [got[i] for i in range(len(texts))] == plain_roots(len(texts), near)


def test_recall_of_the_index_by_length():
    rng = np.random.default_rng(4)
    tables, limit = simhash.drawn_masks(1 << 18, 4, 0.8), simhash.bit_limit(0.8, 256, simhash.DEVIATIONS)
    fine_limit = simhash.bit_limit(0.8, 64 * simhash.FINE_WORDS, simhash.DEVIATIONS)
    for n in (72, 135, 270, 900):
        found = 0
        for _ in range(400):
            a = rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) + rng.integers(0, 2, n, np.uint64)
            b = a.copy()
            b[: n // 9] = rng.integers(0, 1 << 63, n // 9, np.uint64)
            x = simhash._fingerprint(a, simhash.FINE_WORDS) ^ simhash._fingerprint(b, simhash.FINE_WORDS)
            found += int(np.bitwise_count(x[:4]).sum() <= limit and np.bitwise_count(x).sum() <= fine_limit and any(not int(x[w]) & m for w, m in tables))
        print("recall", n, found / 400)
        assert found >= 396, n


@pytest.mark.parametrize(("shape", "task_rows"), [("in order", 40), ("zigzag", 40), ("star", 40), ("zigzag", 100_000)])
def test_components_end_in_few_rounds(spark, monkeypatch, shape, task_rows):
    """With tasks that hold few of the links, and with one that holds all."""
    n, turns = 2000, []
    monkeypatch.setattr(components_module, "TASK_ROWS", task_rows)
    chain = list(range(n)) if shape == "in order" else [x for i in range(n // 2) for x in (i, n - 1 - i)]
    edges = [(7, i) for i in range(n)] if shape == "star" else list(zip(chain, chain[1:]))
    hooks = components_module._hooks
    monkeypatch.setattr(components_module, "_hooks", lambda links, turn: turns.append(turn) or hooks(links, turn))
    got = {r.v: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == dict.fromkeys(range(n), 0) and len(turns) <= (8 if task_rows == 40 else 1)


def near_prints(rng, families, members, limit):
    rows = []
    for f in range(families):
        base = rng.integers(0, 1 << 63, 4, np.uint64)
        for _ in range(members if f else 5 * members):
            bits = rng.choice(256, rng.integers(0, limit), replace=False)
            rows.append(base ^ np.array([sum(1 << int(b % 64) for b in bits if b // 64 == w) for w in range(4)], np.uint64))
    return np.array(rows)


@pytest.mark.parametrize("bucket_rows", [5, 2048])
def test_first_and_rest_links_equal_plain_search(spark, monkeypatch, bucket_rows):
    """first: few links, yet one for everything that has a partner in a bucket; rest: all pairs of different labels."""
    monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket_rows)
    fps, limit = near_prints(np.random.default_rng(12), 12, 8, 20), 30
    tables = simhash.drawn_masks(len(fps), 4, 0.9)[:8]
    pairs = {(i, j) for w, m in tables for i in range(len(fps)) for j in range(i) if not int(fps[i][w] ^ fps[j][w]) & m and np.bitwise_count(fps[i] ^ fps[j]).sum() <= limit}
    sizes = [(90 + i % 20, 70 + i % 31) for i in range(len(fps))]
    finer = np.random.default_rng(13).integers(0, 1 << 63, (len(fps), 2), np.uint64)
    rows = [(i, *(int(x) for x in f.view(np.int64)), i % 3, *sizes[i], bytearray(finer[i].tobytes())) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "v long, f0 long, f1 long, f2 long, f3 long, label long, size int, shared int, fine binary")
    found = lambda mode, fine=128: {tuple(sorted((r.a, r.b), reverse=True)) for r in simhash.links(df, 4, limit, tables, mode, 0.8, fine).collect() if r.a != r.b}
    first = found("first")
    assert first <= pairs and {i for p in pairs for i in p} == {i for p in first for i in p}
    can = {(i, j) for i, j in pairs if 9 * min(sizes[i][1], sizes[j][1]) >= 4 * (sizes[i][0] + sizes[j][0])}
    assert can < pairs
    assert found("rest") == {(i, j) for i, j in can if i % 3 != j % 3}
    near = {(i, j) for i, j in can if i % 3 != j % 3 and np.bitwise_count(finer[i] ^ finer[j]).sum() <= 60}
    assert near < can and found("rest", 60) == near
    chains = {tuple(sorted((r.a, r.b))) for r in simhash.links(df, 4, limit, tables, "chains").collect()}
    assert plain_roots(len(fps), chains) == plain_roots(len(fps), pairs)


def test_blocks_miss_no_link_at_any_number_of_rows():
    for n in (10, 10**7, 10**10, 10**13):
        tables = simhash.blocks(n, 3)
        rng = np.random.default_rng(1)
        for _ in range(300):
            x = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
            assert any(not x & m for _, m in tables)
        assert min(bin(m).count("1") for _, m in tables) >= min(np.log2(n / simhash.BUCKET_GOAL), 40) - 1


def test_a_large_family_makes_few_pairs_and_one_group(spark, monkeypatch):
    rng = random.Random(3)
    base = drawn(rng, 150)
    texts = [" ".join(base[:i] + drawn(rng, 1) + base[i + 1 :]) for i in range(150)] + [" ".join(drawn(rng, 120)) for _ in range(50)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted, alike = [], simhash.alike
    monkeypatch.setattr(simhash, "alike", lambda pairs, *a: counted.append(pairs.count()) or alike(pairs, *a))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert got == {**dict.fromkeys(range(150), 0), **{i: i for i in range(150, 200)}}
    assert sum(counted) < 20 * 150


def test_a_family_around_the_similarity_makes_few_links(spark, monkeypatch):
    """About half of all pairs are alike; most of them are within a group before they are checked."""
    rng = random.Random(5)
    base, texts = drawn(rng, 600), []
    for _ in range(150):
        text = list(base)
        for i in rng.sample(range(600), rng.randint(4, 9)):
            text[i] = drawn(rng, 1)[0]
        texts.append(" ".join(text))
    docs = spark.createDataFrame(list(enumerate([*texts, " ".join(drawn(rng, 600))])), "doc_id long, text string")
    far = simhash.shingle_sets(docs.where("doc_id = 150"), 5, 0, 0).first().v
    made, alike, links = [], simhash.alike, simhash.links
    # first candidates that aren't alike: all is left to the later ones
    monkeypatch.setattr(simhash, "links", lambda df, *a: df.select(F.col("v").alias("a"), F.lit(far).alias("b"), F.lit(0).alias("bits")) if "first" in a else links(df, *a))

    def counted(*a):
        found = simhash.cut(alike(*a))
        made.append(found.count())
        return found

    monkeypatch.setattr(simhash, "alike", counted)
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    words = [t.split() for t in texts]
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in words]
    want = {(i, j) for i in range(150) for j in range(i) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
    assert [got[i] for i in range(150)] == plain_roots(150, want) and len(want) > 3000
    assert sum(made) < 8 * 150, made


def test_rows_that_meet_none_are_left_out_before_finer_fingerprints_are_dealt(spark):
    """Of 300 rows in 40 tables only those of a pair of different labels go on, each in the bucket that the pair comes from."""
    rng = np.random.default_rng(14)
    fps = rng.integers(0, 1 << 63, (300, 4), np.uint64)
    fps[1:3] = fps[0] ^ np.array([[0, 0, 1, 0], [0, 2, 0, 0]], np.uint64)
    fps[11] = fps[10] ^ np.array([4, 0, 0, 0], np.uint64)  # of one label
    tables = simhash.drawn_masks(len(fps), 4, 0.9)[:40]
    rows = [(i, *(int(x) for x in f.view(np.int64)), 10 if i in (10, 11) else i, 100, 100) for i, f in enumerate(fps)]
    df = spark.createDataFrame(rows, "v long, f0 long, f1 long, f2 long, f3 long, label long, size int, shared int")
    met = simhash.cut(simhash.links(df, 4, 30, tables, "met", 0.8))
    assert {r.v for r in met.collect()} == {0, 1, 2} and met.count() <= 6
    fine = spark.createDataFrame([(i, bytearray(16)) for i in range(300)], "v long, fine binary")
    found = lambda labels: {tuple(sorted((r.a, r.b))) for r in simhash.told_apart(met, labels.join(fine, "v"), 4, 30, tables, 0.8, 0).collect()}
    assert found(df.select("v", "label")) == {(0, 1), (0, 2), (1, 2)}
    assert found(df.select("v", F.when(F.col("v") == 1, 0).otherwise(F.col("label")).cast("long").alias("label"))) == {(0, 2), (1, 2)}
    held = [(r.a, r.bits) for r in simhash.told_apart(met, df.select("v", "label").join(fine, "v"), 4, 30, tables, 0.8, 0, 0).collect()]
    assert len(held) == met.count() and set(held) == {(0, -1), (1, -1), (2, -1)}


def test_files_of_shuffles_go_with_their_action(spark):
    files = lambda: {p for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for p in glob.glob(f"{d}/*/shuffle_*.data")}
    before, key = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    with simhash.shuffles_removed(spark):
        assert simhash.cut(spark.range(1000).repartition(4, "id").groupBy((F.col("id") % 7).alias("k")).count()).count() == 7
    assert spark.conf.get(key, None) == was
    for _ in range(50):  # files are removed behind the action
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before


def test_links_that_one_task_holds_take_no_rounds(spark, monkeypatch):
    monkeypatch.setattr(components_module, "_hooks", None)
    got = components(spark.createDataFrame([(5, 3), (3, 9), (8, 7), (4, 4), (None, 1)], "a long, b long")).collect()
    assert sorted((r.v, r.root) for r in got) == [(3, 3), (5, 3), (7, 7), (8, 7), (9, 3)]
