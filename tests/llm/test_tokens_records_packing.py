import struct
import zlib
from random import Random
from types import SimpleNamespace

import numpy as np
import pytest
from tokenizers import Tokenizer

from lineflow.llm import packing, records
from lineflow.llm.common import new_path, tokenizer_path
from lineflow.llm.queries import QUERIES
from lineflow.llm.tokens import WordTokenizer


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def plain_ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_table_equals_library(library, monkeypatch):
    texts = [
        "It's the END, don't stop!!' 12 345", "Straße ÄÖÜ × ÷ ÿ", "á é ñ", "İstanbul ΣΑΣ", "<|endoftext|> x <|startoftext|>", "\x1c\x00 odd \x85 \xa0", "日本語 😀😀 text",
        "", " \n\t ", "x" * 5000, "'s 's's '", "$$$ ### &&& %%%",
    ]
    texts += [" ".join(texts)] * 2
    for limit in (10**6, 5):
        monkeypatch.setattr("lineflow.llm.tokens.KNOWN_WORDS", limit)
        monkeypatch.setattr("lineflow.llm.tokens.PIECE", 64)
        mine = WordTokenizer(tokenizer_path())
        for text in texts:
            assert mine.document(text).tolist() == plain_ids(library, text), text


def test_chunks_of_words_equal_library(library):
    r = Random(3)
    parts = [".", ",", "..", ".'s", "'", "'s", "'ll", "!", "$", "×", "÷", " ", " ", "\n", "\t", "a", "Word", "größe", "É", "3", "12", "-", "(", "|>", "é", "²"]
    texts = ["".join(r.choice(parts[:-1] if r.random() < 0.97 else parts) for _ in range(r.randrange(1, 40))) for _ in range(3000)]
    texts += [".", ",.", "a.b,c", "3.5, it's. don't, x'. 'y.", "÷.", "a .", "a. .b", ".,", "_, a_.", "\n.a"]
    for text, ids in zip(texts, WordTokenizer(tokenizer_path()).documents(texts)):
        assert ids.tolist() == plain_ids(library, text), text


def test_known_words_are_not_split_again(library):
    mine, got = WordTokenizer(tokenizer_path()), []
    pattern = mine.split
    mine.split = SimpleNamespace(findall=lambda text: got.append(text) or pattern.findall(text))
    text = "Words with stops, and others. It's 12 o'clock (or 3.5) not more."
    assert mine.document(text).tolist() == plain_ids(library, text)
    got.clear()
    assert mine.document(text).tolist() == plain_ids(library, text)
    assert not [t for t in got if t.isalpha() or len(t) > 10]


def test_record_file_query(spark, sf_dir, library):
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    expected, start = {}, 0
    for doc_id, text in docs:
        ids = plain_ids(library, text)
        expected[doc_id] = (start, len(ids), crc(ids))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in QUERIES["op6_token_records"](spark, sf_dir).collect()} == expected


def test_records_round_trip_in_any_order(spark, odd_docs, no_docs, library, monkeypatch):
    path, index = records.write_with_index(odd_docs)
    rows = odd_docs.collect()
    want = sorted((r.doc_id is not None, r.doc_id or 0, plain_ids(library, r.text)) for r in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.ids) for r in records.read(spark, path, index).collect()) == want
    some = index.where("doc_id in (6, 8)")
    assert {r.doc_id for r in records.read(spark, path, some, seed=4).collect()} == {6, 8}
    placed = sorted(records.numbered(index).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in placed] == sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d))
    assert records.write_with_index(no_docs)[1].count() == 0


def test_files_are_bounded_by_bytes(spark, library, monkeypatch):
    """Long texts fill a file each few, short ones many; the order and the starts stay."""
    monkeypatch.setattr(records, "ROW_BYTES", 1000)
    docs = [(i, "word " * (2000 if i % 10 == 0 else 3)) for i in range(200)]
    path, index = records.write_with_index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    longest = max(r.length for r in index.collect())
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path + "/data").select("length").collect()
    assert len(files) > 2 and all(f.length <= records.FILE_ROWS * (1000 + longest) for f in files)
    start, want = 0, []
    for i, t in docs:
        want.append((i, start))
        start += len(plain_ids(library, t))
    assert sorted((r.doc_id, r.start) for r in records.numbered(index).collect()) == want


def test_ranges_follow_the_bytes():
    assert packing.range_count(0) == 1 and packing.range_count(packing.RANGE_BYTES * 7) == 7
    assert packing.range_count(packing.LEAST_BYTES * 5, 8) == 5 and packing.range_count(packing.RANGE_BYTES * 7, 4) == 7
    assert packing.range_count(10**14) * packing.LARGE_RANGE_BYTES < 1.1 * 10**14


def test_broken_record_is_noticed():
    good = records.frame(3, np.arange(5, dtype="<u2"))
    assert records.parse(memoryview(good), 0)[1].tolist() == [0, 1, 2, 3, 4]
    for at in (0, 9, 20, len(good) - 2):
        bad = bytearray(good)
        bad[at] ^= 1
        with pytest.raises((ValueError, struct.error)):
            records.parse(memoryview(bytes(bad)), 0)


def assert_packed(pieces, docs, library, length):
    total = 0
    for key, text in docs:
        ids = plain_ids(library, text)
        mine = sorted((p for p in pieces if p.doc_id == key), key=lambda p: p.start)
        assert [p.start for p in mine] == [0, *np.cumsum([p.length for p in mine])[:-1]]
        assert all(p.doc_tokens == len(ids) and p.ids_crc32 == crc(ids[p.start : p.start + p.length]) for p in mine)
        assert sum(p.length for p in mine) == len(ids)
        total += len(ids)
    sequences = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    sizes = {}
    for k, parts in sequences.items():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([n for _, n in parts])[:-1]]
        sizes[k] = sum(n for _, n in parts)
    assert sorted(sizes) == list(range(len(sizes)))
    assert sum(sizes.values()) == total
    assert all(s == length or s < length and s & (s - 1) == 0 for s in sizes.values())


def test_packing_query(spark, sf_dir, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert_packed(QUERIES["op9_packing"](spark, sf_dir).collect(), docs, library, 2048)


def test_packing_odd_texts(spark, odd_docs, no_docs, library):
    docs = odd_docs.where("doc_id is not null and doc_id <> 5")
    assert_packed(packing.pack(docs, 256).collect(), [(r.doc_id, r.text) for r in docs.collect()], library, 256)
    twice = [p for p in packing.pack(odd_docs, 256).collect() if p.doc_id == 5]
    assert sum(p.length for p in twice) == 2 * twice[0].doc_tokens
    assert packing.pack(no_docs).count() == 0


def test_hilbert_curve_visits_every_cell_by_steps_of_one():
    for dimensions, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
        key = packing.hilbert_key(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        walk = grid[np.argsort(key)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_neighbours_on_the_curve_share_words(spark):
    topics = [[f"t{t}w{i}" for i in range(30)] for t in range(6)]
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(topics[i % 6], 200)) for i in range(120)]
    order = np.argsort(packing.curve_keys([t.encode() for t in texts]), kind="stable")
    assert np.mean([order[i] % 6 == order[i + 1] % 6 for i in range(119)]) > 0.6  # 1 in 6 by chance
    assert new_path(spark, "x") != new_path(spark, "x")
