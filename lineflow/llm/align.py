"""Alignment of the tokens that two tokenizers give one text.

A is a byte-level file of the tokenizers library, B a SentencePiece model with byte
fallback; both see a space before the text. The libraries' spans (character offsets of A,
byte spans of B's proto) are the coarse cuts. Where tokens share a character, or bytes
stand for one, the spans overlap or are empty, and the tokens' decoded bytes place the ends.

Neither tokenizer has a token across a single space or line end between other characters, or
across a letter and the stop after it, so a text is cut there, each distinct piece is aligned
once, and a task keeps the pieces it has seen. Tokenizers of another kind get whole texts.

Counts of linked ids are sums over the corpus: tasks add up theirs before the shuffle. The
table of counts goes back to the tasks in slices of bounded size, each met by all
documents, so that the number of id pairs plays no part in memory.

Results in odd cases: texts that are null or empty, or whose tokens' bytes aren't the
text's (as with U+2581 in it), have zeros and '' and add to no count; repeated rows each
count; rows without an id stay; equal counts are all the best; an empty table gives an empty one;
other columns are not looked at.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import os
import re
from collections.abc import Iterable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineflow.llm.common import tokenizer_path, written

SPACE = "▁"
#: Pieces that a worker keeps, and the longest of them in characters; then those that were not seen lately go.
KNOWN, LONGEST = 500_000, 80
#: Characters of new pieces that the libraries get at a time.
LEARNED = 1 << 14
#: Documents' characters between two looks for new pieces.
BATCH = 1 << 20
#: Bytes of links that are gathered before rows are handed on.
BATCH_BYTES = 4 << 20
#: Pairs of ids in a slice of the table of counts, 17 bytes each.
SLICE = 4_000_000

#: Number of A's tokens, keys of links, and groups, each with a semicolon at its end.
Entry = tuple[int, bytes, str]
#: Of a piece whose tokens' bytes aren't its own; no text has so many tokens.
BAD: Entry = (1 << 40, b"", "")
#: A piece that is a word and stops, which are aligned each for itself.
_STOPPED = re.compile(r"(\n?[A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]{1,3})")


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable ones as they are, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def placed(begin: np.ndarray, end: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Ends of tokens from their coarse spans: a span as long as the token is taken, others go on from the token before by decoded length."""
    exact = end - begin == length
    total = np.cumsum(length)
    anchor = np.maximum.accumulate(np.where(exact, np.arange(len(end)), -1))  # the last token placed by its span
    shift = np.where(anchor >= 0, end[anchor] - total[anchor], begin[0] if len(begin) else 0)
    return total + shift


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        alphabet, vocab = byte_alphabet(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.a_bytes[i] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.width = len(self.a_bytes)  # of a pair's key: id of B times width, plus id of A
        self.dtype = np.dtype("<u4" if self.width * len(pieces) < 1 << 32 else "<u8")
        self.cut = re.compile(r"(?<=\S)(?=[ \n]\S)") if self._local(pieces) else None
        # what is written of each token: A's within a group and at the end of its part, then B's
        self.words = [f"{i}{c}" for n, ends in ((self.width, ",|"), (len(pieces), ",;")) for c in ends for i in range(n)]
        self.word_length = np.array([len(x) for x in self.words], np.int64)
        self.known: dict[str, Entry] = {}
        self.older: dict[str, Entry] = {}
        self.stops: dict[str, Entry] = {}

    def _local(self, pieces: list[str]) -> bool:
        """Whether texts may be cut before a single space or line end, and between a letter and a stop."""
        import json

        spec = json.loads(self.a.to_str())
        split = spec["pre_tokenizer"] or {}
        return not spec["normalizer"] and split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split["add_prefix_space"] and not any(SPACE in p.lstrip(SPACE) or "\n" in p or re.search("[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]", p) for p in pieces)

    def pieces(self, text: str) -> list[str]:
        """The pieces of a space and the text; one that begins with neither space nor line end has a space before it."""
        if not self.cut:
            return [f" {text}"]
        flat = text.replace("\n", " ")
        if " ".join(flat.split()) == flat:  # every white space is one to cut at
            return text.replace("\n", " \n").split(" ")
        return [p[1:] if p[0] == " " and not p[1].isspace() else p for p in self.cut.split(f" {text}")]

    def learn(self, own: list[str]) -> list[Entry]:
        """Entries of pieces, with their spaces, that the libraries get as one text; one that begins otherwise gets a word before it."""
        pieces: list[str] = []
        at_own = []
        for piece in own:
            if piece[0] != " ":
                pieces.append(" a")
            at_own.append(len(pieces))
            pieces.append(piece)
        text = "".join(pieces)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        at = np.concatenate([[0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))])  # byte where a character begins
        starts = at[np.concatenate([[0], np.cumsum([len(p) for p in pieces])])]
        data = text.encode()

        found = self.a.encode(text, add_special_tokens=False)
        a = np.array(found.ids, np.int64)
        spans = at[np.fromiter(itertools.chain.from_iterable(found.offsets), np.int64, 2 * len(a)).reshape(-1, 2)]
        a_first, a_end, a_good = self._assigned(a, spans[:, 0], spans[:, 1], self.a_bytes, self.a_length, starts, data)
        proto = self.b.encode(text[1:], return_type="proto")
        tokens = list(proto.pieces)
        b, begin, end = (np.fromiter(map(attrgetter(x), tokens), np.int64, len(tokens)) for x in ("id", "begin", "end"))
        begin = np.where(np.arange(len(b)) == 0, 0, begin + 1)  # the space in front is not in B's text
        b_first, b_end, b_good = self._assigned(b, begin, end + 1, self.b_bytes, self.b_length, starts, data)

        good = a_good & b_good
        a_keep, b_keep = (np.repeat(good, np.diff(first)) for first in (a_first, b_first))
        a, a_end, b, b_end = a[a_keep], a_end[a_keep], b[b_keep], b_end[b_keep]
        both = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        twice = np.append(both[1:] == both[:-1], False)[: len(both)]
        ends, common = both[~twice], both[twice]  # a link ends at each end: the tokens of A and B that hold the bytes before it
        keys = (b[np.searchsorted(b_end, ends)] * self.width + a[np.searchsorted(a_end, ends)]).astype(self.dtype)
        a_group, b_group = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
        a_to, b_to = np.searchsorted(a_end, common, "right"), np.searchsorted(b_end, common, "right")
        words = np.empty(len(a) + len(b), np.int64)  # a group's tokens of A, then its tokens of B
        words[np.arange(len(a)) + np.append(0, b_to)[a_group]] = a + self.width * (a_end == common[a_group])
        words[np.arange(len(b)) + a_to[b_group]] = 2 * self.width + b + len(self.b_bytes) * (b_end == common[b_group])
        groups = "".join(map(self.words.__getitem__, words.tolist()))
        chars = np.append(0, np.cumsum(self.word_length[words]))
        of_a, of_b, of_link = (np.searchsorted(x, starts, "right") for x in (a_end, b_end, ends))
        raw, w = keys.tobytes(), self.dtype.itemsize
        good, of_a, of_link, of_char = (x.tolist() for x in (good, of_a, of_link * w, chars[of_a + of_b]))
        return [(of_a[i + 1] - of_a[i], raw[of_link[i] : of_link[i + 1]], groups[of_char[i] : of_char[i + 1]]) if good[i] else BAD for i in at_own]

    @staticmethod
    def _assigned(ids, begin, end, table, lengths, starts, data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first token of each piece, ends of tokens, pieces whose tokens' bytes are the piece's); tokens go to pieces by their spans."""
        piece = np.searchsorted(starts, begin, "right") - 1
        first = np.searchsorted(piece, np.arange(len(starts)), "left")
        ends = placed(begin, end, lengths[ids])
        decoded = list(map(table.__getitem__, ids.tolist()))
        last = first[1:]
        whole = (last > first[:-1]) & (np.append(ends, 0)[last - 1] == starts[1:])
        if b"".join(decoded) == data and whole.all():
            return first, ends, whole
        good = np.array([b"".join(decoded[i:j]) == data[s:t] for i, j, s, t in zip(first, last, starts, starts[1:])], bool)
        ends = np.concatenate([s + np.cumsum(lengths[ids[i:j]]) for i, j, s in zip(first, last, starts)]) if len(ids) else ends
        return first, ends, good

    def documents(self, texts: Iterable[str | None]) -> Iterator[tuple[int, int, int, bytes, str]]:
        """(n_a, n_b, n_groups, keys of links, groups) of each text."""
        held, size = [], 0
        for text in texts:
            held.append(self.pieces(text) if text else [])
            size += len(text or "")
            if size > BATCH:
                yield from self._looked_up(held)
                held, size = [], 0
        yield from self._looked_up(held)

    def _learned(self, pieces: list[str]) -> Iterator[tuple[str, Entry]]:
        """Pieces with their entries; the libraries get LEARNED characters at a time."""
        at = 0
        while at < len(pieces):
            to, size = at, 0
            # what B reads as white space at the end of a piece would run into the next one, so it ends a batch
            while to < len(pieces) and (to == at or size + len(pieces[to]) <= LEARNED and not (pieces[to - 1][-1].isspace() or pieces[to - 1][-1] == SPACE)):
                size += len(pieces[to])
                to += 1
            yield from zip(pieces[at:to], self.learn([p if p[0] in " \n" else f" {p}" for p in pieces[at:to]]))
            at = to

    def _looked_up(self, docs: list[list[str]]) -> Iterator[tuple[int, int, int, bytes, str]]:
        if len(self.known) > KNOWN // 2:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        new = set().union(*docs).difference(known)
        stopped = {p: m.groups() for p in new if (m := _STOPPED.fullmatch(p))} if self.cut else {}
        new = new.difference(stopped).union(word for word, _ in stopped.values() if word not in known)
        seen = new.intersection(older)
        known.update(zip(seen, map(older.__getitem__, seen)))
        passing = list(stopped)  # pieces that aren't kept
        for piece, entry in self._learned(list(new.difference(seen))):
            known[piece] = entry
            if len(piece) > LONGEST:
                passing.append(piece)
        stops = list({stop for _, stop in stopped.values()}.difference(self.stops))
        if stops:
            self.stops.update(zip(stops, self.learn(stops)))
        for piece, (word, stop) in stopped.items():
            (n, keys, groups), (more_n, more_keys, more_groups) = known[word], self.stops[stop]
            known[piece] = n + more_n, keys + more_keys, groups + more_groups
        for pieces in docs:
            n, keys, groups = zip(*map(known.__getitem__, pieces)) if pieces else ((), (), ())
            n_a = sum(n)
            if not n_a or n_a >= BAD[0]:
                yield 0, 0, 0, b"", ""
                continue
            keys, groups = b"".join(keys), "".join(groups)
            n_groups = groups.count(";")
            # ends of links are those of either's tokens, ends of groups those of both
            yield n_a, len(keys) // self.dtype.itemsize + n_groups - n_a, n_groups, keys, groups[:-1]
        for piece in passing:
            del known[piece]


@functools.cache
def aligner(a_path: str, b_path: str) -> Aligner:
    """One pair of tokenizers and table of pieces for each worker process."""
    return Aligner(a_path, b_path)


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, id_col: str = "doc_id", text_col: str = "text", groups: bool = True) -> DataFrame:
    """(id_col, n_a, n_b, n_groups, n_links, groups string, keys binary, times binary): the links of each document, by distinct pair of ids.

    keys are B's id times A's number of ids plus A's id, ascending, as little-endian
    integers of the aligner's width; times, 4 bytes each, tell how many links have the pair.
    Without groups their SHA-256 is given as groups_sha256 instead.
    """
    paths = a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model")
    kinds = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("keys", pa.binary()), ("times", pa.binary())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, rows, size = aligner(*paths), [], 0
        for batch in batches:
            texts = (t.as_py() for t in batch.column(1))
            for doc_id, (n_a, n_b, n_groups, keys, found) in zip(batch.column(0).to_pylist(), tool.documents(texts)):
                pairs, times = np.unique(np.frombuffer(keys, tool.dtype), return_counts=True)
                found = found if groups or not found else hashlib.sha256(found.encode()).hexdigest()
                rows.append((doc_id, n_a, n_b, n_groups, len(keys) // tool.dtype.itemsize, found, pairs.tobytes(), times.astype("<u4").tobytes()))
                size += len(keys) + len(found)
                if size > BATCH_BYTES:
                    yield _batch(rows, kinds)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, kinds)

    name = "groups" if groups else "groups_sha256"
    kinds[5] = (name, pa.string())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_a long, n_b long, n_groups long, n_links long, {name} string, keys binary, times binary").withColumnRenamed("doc_id", id_col)


def _batch(rows: list[tuple], kinds: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)], [k for k, _ in kinds])


def pair_counts(aligned: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """(key, n, best): links of each pair of ids in all documents, and whether no pair of its B id has more."""
    paths = a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model")
    kinds = [("key", pa.int64()), ("n", pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dtype, keys, times, size = aligner(*paths).dtype, [], [], 0

        def out() -> pa.RecordBatch:
            pairs, where = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(where, np.concatenate(times), len(pairs)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs.astype(np.int64)), pa.array(n)], [k for k, _ in kinds])

        for batch in batches:
            for k, t in zip(batch.column(0), batch.column(1)):
                keys.append(np.frombuffer(k.as_py(), dtype))
                times.append(np.frombuffer(t.as_py(), "<u4"))
                size += len(keys[-1])
                if size > SLICE:
                    yield out()
                    keys, times, size = [], [], 0
        if keys:
            yield out()

    width = aligner(*paths).width
    counts = aligned.where("n_links > 0").select("keys", "times").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    most = F.max("n").over(Window.partitionBy(F.floor(F.col("key") / width)))  # a row for each id of A at most
    return counts.select("key", "n", (F.col("n") == most).alias("best"))


def score(aligned: DataFrame, counts: DataFrame, a_path: str | None = None, b_path: str | None = None) -> DataFrame:
    """aligned, a written table, with n_best and count_sum instead of keys and times; counts, a written one, is taken slice by slice."""
    paths = a_path or tokenizer_path("byte_bpe_50k.json"), b_path or tokenizer_path("piece_bpe_32k.model")
    spark, kept = aligned.sparkSession, [c for c in aligned.columns if c not in ("keys", "times")]
    slices = max(1, -(-counts.count() // SLICE))
    bounds = counts.approxQuantile("key", [i / slices for i in range(1, slices)], 0.1 / slices) if slices > 1 else []
    edges = [-1, *(int(b) for b in bounds), (1 << 62)]
    numbered = aligned.withColumn("__row", F.monotonically_increasing_id())

    def scored(low: int, high: int) -> DataFrame:
        some = counts.where((F.col("key") > low) & (F.col("key") <= high)).toArrow()
        order = np.argsort(some["key"].to_numpy())
        sent = spark.sparkContext.broadcast(tuple(some[c].to_numpy(zero_copy_only=False)[order] for c in ("key", "n", "best")))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            dtype, (key, n, best) = aligner(*paths).dtype, sent.value
            for batch in batches:
                bests, sums = [], []
                for k, t in zip(batch.column("keys"), batch.column("times")):
                    pairs, times = np.frombuffer(k.as_py(), dtype).astype(np.int64), np.frombuffer(t.as_py(), "<u4").astype(np.int64)
                    here = (pairs > low) & (pairs <= high)
                    at, times = np.searchsorted(key, pairs[here]), times[here]
                    bests.append(int(times[best[at]].sum()) if len(at) else 0)
                    sums.append(int((times * n[at]).sum()) if len(at) else 0)
                out = batch.drop_columns(["keys", "times"])
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(bests, pa.int64()), pa.array(sums, pa.int64())], [*out.schema.names, "n_best", "count_sum"])

        schema = ", ".join(f"`{c}` {t}" for c, t in numbered.dtypes if c in (*kept, "__row"))
        return numbered.mapInArrow(run, f"{schema}, n_best long, count_sum long")

    parts = [scored(low, high) for low, high in zip(edges, edges[1:])]
    if len(parts) > 1:
        both = functools.reduce(DataFrame.unionByName, parts)
        parts = [both.groupBy("__row", *kept).agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))]
    return parts[0].drop("__row")


def aligned_counts(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, groups: bool = False) -> DataFrame:
    """align(), pair_counts() and score(), with their tables in the shared folder."""
    found = written(align(docs, a_path, b_path, groups=groups), "align", compression="zstd")
    counts = written(pair_counts(found, a_path, b_path), "align-counts")
    return score(found, counts, a_path, b_path)
