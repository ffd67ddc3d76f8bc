"""Alignment of two tokenizers against a plain version over whole texts."""

import hashlib
from collections import Counter
from random import Random

import pytest

from lineflow.llm import align, queries
from lineflow.llm.common import table, tokenizer_path, written

PATHS = "byte_bpe_50k.json", "piece_bpe_32k.model"


@pytest.fixture(scope="module")
def tool():
    return align.Aligner(*map(tokenizer_path, PATHS))


def plain_alignment(tool, text):
    """(ids of A, ids of B, groups, links) by the bytes of the tokens of the whole text."""
    nothing = 0, 0, "", []
    if not text:
        return nothing
    data = f" {text}".encode()
    a, b = tool.a.encode(f" {text}", add_special_tokens=False).ids, tool.b.encode(text)
    sides = [[tool.a_bytes[i] for i in a], [tool.b_bytes[i] for i in b]]
    if any(b"".join(side) != data for side in sides):
        return nothing
    ends = []
    for side in sides:
        at = 0
        ends.append([at := at + len(x) for x in side])
    links, i, j, held, groups = [], 0, 0, ([], []), []
    while i < len(a):
        links.append((a[i], b[j]))
        x, y = ends[0][i], ends[1][j]
        if x <= y:
            held[0].append(str(a[i]))
            i += 1
        if y <= x:
            held[1].append(str(b[j]))
            j += 1
        if x == y:
            groups.append(",".join(held[0]) + "|" + ",".join(held[1]))
            held = [], []
    return len(a), len(b), ";".join(groups), links


def plain_table(tool, rows):
    """Per document the columns of the query."""
    found = [(doc_id, *plain_alignment(tool, text)) for doc_id, text in rows]
    count = Counter(link for *_, links in found for link in links)
    best = Counter()
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return sorted(
        (
            (d, n_a, n_b, groups.count(";") + bool(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links), groups and hashlib.sha256(groups.encode()).hexdigest())
            for d, n_a, n_b, groups, links in found
        ),
        key=str,
    )


ODD = [
    None, "", " ", "  ", "\n", "a▁b", "ok then ▁ no", "▁ x", "😀😀 a 中文  x", "<|endoftext|> a <s> </s> <0x41>", "don't we'll ", "x\r\ny  z ", "\x00 a b", "\x1c \x1d a", "ﬁ ½ ① é é",
    "מה شي ไทย कि ‍", "a" * 300 + " b", " lead", "tail ", "﻿x � y", "　wide space x", "𒀀𒀁 𐍈",
]


def test_texts_of_all_kinds(tool):
    r = Random(1)
    parts = [" ", "  ", "a", "Bc", "é", "😀", "中", "\n", "\t", "1", "!", "'s", " ", "한", "-", " the"]
    texts = ODD + ["".join(r.choice([*parts, "▁"] if r.random() < 0.05 else parts) for _ in range(r.randrange(1, 60))) for _ in range(2000)]
    for text, (n_a, n_b, n_groups, keys, groups) in zip(texts, tool.documents(texts)):
        a, b, want, links = plain_alignment(tool, text)
        pairs = [(k % tool.width, k // tool.width) for k in align.np.frombuffer(keys, tool.dtype).tolist()]
        assert (n_a, n_b, n_groups, groups, pairs) == (a, b, want.count(";") + bool(want), want, links), text


def test_pieces_are_learned_anew_when_there_are_too_many(tool, monkeypatch):
    monkeypatch.setattr(align, "KNOWN", 5)
    monkeypatch.setattr(align, "LONGEST", 4)
    monkeypatch.setattr(align, "BATCH", 30)
    texts = ["some words here and there", "other words there", None, "there and here again, " * 5]
    own = align.Aligner(*map(tokenizer_path, PATHS))
    assert [x[4] for x in own.documents(texts)] == [plain_alignment(tool, t)[2] for t in texts]


def test_words_with_stops_and_at_line_ends(tool):
    r = Random(2)
    parts = [".", ",", "!?", "...", ".,;:!?", " ", " ", "\n", "\n", "\r\n", "\t", "\x1c", "a", "Word", "größe", "²", "ª", "1", "é", "中", "'s", "\"", "ñ.", "the", "▁"]
    texts = ["".join(r.choice(parts[:-1] if r.random() < 0.97 else parts) for _ in range(r.randrange(1, 40))) for _ in range(3000)]
    texts += ["\nword", "word\n", "a\nword.\nword", "\n", "\n\n", ".", " .", "a.", "▁\na.", "a ▁. b", "\n.", "a \nb.", "a\n b."]
    for text, (n_a, n_b, n_groups, keys, groups) in zip(texts, tool.documents(texts)):
        a, b, want, links = plain_alignment(tool, text)
        pairs = [(k % tool.width, k // tool.width) for k in align.np.frombuffer(keys, tool.dtype).tolist()]
        assert (n_a, n_b, n_groups, groups, pairs) == (a, b, want.count(";") + bool(want), want, links), text


def test_words_with_stops_and_at_line_ends_are_not_learned_anew(monkeypatch):
    own, sent = align.Aligner(*map(tokenizer_path, PATHS)), []
    learn = own.learn
    monkeypatch.setattr(own, "learn", lambda pieces: sent.extend(pieces) or learn(pieces))
    words = [x + y + z for x in "ancient" for y in ("ou", "ière", "st") for z in ("tion", "ß", "able")]
    stops = [".", ",", "?!"]
    list(own.documents([" ".join(words), " ".join(f"a\n{w}" for w in words)]))
    sent.clear()
    texts = [" ".join(w + s for w in words for s in stops), " ".join(f"a{s}\n{w}{s}" for w in words for s in stops)]
    assert [x[4] for x in own.documents(texts)] == [plain_alignment(own, text)[2] for text in texts]
    assert sorted(sent) == sorted(stops)


def columns(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


def test_query(spark, sf_dir, tool):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    assert columns(queries.op12_token_alignment(spark, sf_dir)) == plain_table(tool, rows)


@pytest.mark.parametrize("size", [align.SLICE, 40])
def test_odd_documents_and_slices_of_the_table(spark, tool, odd_docs, monkeypatch, size):
    monkeypatch.setattr(align, "SLICE", size)
    odd = spark.createDataFrame([(100 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    docs = odd_docs.withColumnRenamed("score", "keys").unionByName(odd, allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert columns(align.aligned_counts(docs)) == plain_table(tool, rows)


def test_groups_as_text_and_no_documents(spark, no_docs, tool):
    one = spark.createDataFrame([(1, "Straße 中文")], "doc_id long, text string")
    assert align.align(one).first()["groups"] == plain_alignment(tool, "Straße 中文")[2]
    assert align.aligned_counts(no_docs).count() == 0
    assert written(align.align(no_docs), "none").columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "keys", "times"]
