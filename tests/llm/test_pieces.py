import time
import zlib

import numpy as np
import pytest
import sentencepiece as spm
from sentencepiece import sentencepiece_model_pb2 as proto

from lineflow.llm import pieces
from lineflow.llm.common import tokenizer_path
from lineflow.llm.queries import QUERIES

PATH = tokenizer_path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "Hello World  it's  été 日本 \n x\tz", "a", "aaaaaaaaaaaaaaaaaaaaaaaaa", "  two  leading", "trailing   ", "\U0001f600 ⁇ ЖЖ", "The quick brown fox",
    "Thndble erstion, oueaer. Schkeitü äch " * 20, "x" * 3000, "▁ mark▁in it", "12345 67.89", "क्ष", "\x00\x01",
]


def unigram():
    with open(PATH, "rb") as f:
        model = proto.ModelProto.FromString(f.read())
    model.trainer_spec.model_type = 1
    return spm.SentencePieceProcessor(model_proto=model.SerializeToString())


@pytest.mark.parametrize("method", ["merges", "viterbi"])
def test_encoding_equals_library(method, monkeypatch):
    library = spm.SentencePieceProcessor(model_file=PATH) if method == "merges" else unigram()
    for known in (10**6, 3):
        monkeypatch.setattr(pieces, "KNOWN_WORDS", known)
        monkeypatch.setattr(pieces, "PIECE", 40)
        model = pieces.load(PATH)
        for text, ids in zip(TEXTS, (x for (x,) in pieces.encode_texts(model, TEXTS, (method,)))):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or ""), text
            assert pieces.decode_ids(model, ids) == library.decode(library.encode(text or "")) == (text or "").replace("▁", " ")


def test_viterbi_equals_brute_force():
    model = pieces.load(PATH)
    score = dict(zip(model.ids.tolist(), model.scores.tolist()))
    known = {model.surface[i].decode().replace(" ", "▁"): i for i in score}
    for word in ["▁the", "ation", "keiten", "▁▁in", "Zanz"]:
        splits = [[word[a:b] for a, b in zip([0, *c], [*c, len(word)])] for m in range(1 << (len(word) - 1)) for c in [[i + 1 for i in range(len(word) - 1) if m >> i & 1]]]
        best = max(sum(score[known[p]] for p in s) for s in splits if all(p in known for p in s))
        assert sum(score[i] for i in np.frombuffer(pieces.viterbi(model, [word])[0], "<u4").tolist()) == pytest.approx(best)


def test_query(spark, sf_dir):
    library, other = spm.SentencePieceProcessor(model_file=PATH), unigram()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    model = pieces.load(PATH)
    score = dict(zip(model.ids.tolist(), map(float, model.scores)))
    got = QUERIES["op2_sentencepiece"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id])
        assert (r.merges_tokens, r.merges_crc32, r.round_trip) == (len(ids), crc(ids), True)
        # the library sums scores over the whole text in single precision, so it may miss the best sum by a little
        mine = next(pieces.encode_texts(model, [docs[r.doc_id]], ("viterbi",)))[0]
        assert (r.n_tokens, r.ids_crc32) == (len(mine) // 4, zlib.crc32(mine))
        total = lambda x: sum(score[i] for i in x if i in score)
        assert total(np.frombuffer(mine, "<u4").tolist()) >= total(other.encode(docs[r.doc_id])) - 1e-3


def test_long_words_equal_batches():
    """The two ways give the same ids, with repeats, ties and characters that no piece covers."""
    model, rng = pieces.load(PATH), np.random.default_rng(7)
    words = ["a" * 90, "ab" * 60, "▁the" * 20, "ж日क😀" * 20, "xyzzy" * 33 + "\x00é"] + ["".join(rng.choice(list("etaoinshr▁éж\x01"), 200)) for _ in range(20)]
    for w in words:
        assert pieces.long_viterbi(model, w) == pieces.viterbi(model, [w])[0], w
        assert pieces.long_merges(model, w) == pieces.merges(model, [w])[0], w


def test_a_word_of_a_million_letters_takes_seconds():
    model, rng = pieces.load(PATH), np.random.default_rng(7)
    word = "".join(rng.choice(list("etaoinshrdlu"), 1_000_000))
    began = time.process_time()
    (found,) = pieces.encode_texts(model, [word], ("viterbi", "merges"))
    print("seconds", time.process_time() - began)
    assert time.process_time() - began < 60
    assert all(pieces.decode_ids(model, x) == word for x in found)


def test_odd_texts(odd_docs, no_docs):
    rows = odd_docs.collect()
    encoded = pieces.encode(odd_docs, PATH)
    assert sorted(((r.doc_id or -1), r.ids_0) for r in pieces.decode(encoded, PATH, ["ids_0"]).collect()) == sorted((r.doc_id or -1, r.text or "") for r in rows)
    assert pieces.encode(no_docs, PATH).count() == 0
