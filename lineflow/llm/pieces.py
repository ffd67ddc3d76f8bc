"""SentencePiece encoding and decoding, batched in numpy.

A text is cut where no piece can cross: before each run of spaces, and between
characters of which no piece holds both. New words are sorted by length, and words of one
length advance together. A substring's hash comes from
prefix hashes and is looked up among the sorted hashes of the pieces.

- viterbi: at each position the best sum of piece scores over all pieces that end there,
  with back pointers. This is how a unigram model is meant to be read.
- merges: in each round every word joins its best-scored adjacent pair. This is how a
  BPE model is meant to be read, whose scores are ranks and not log probabilities.

A word over LONG code points is taken by itself: its pieces are found at all positions at
once, and only what was found is gone through, so that time grows with its length.

Characters that no piece covers fall back to byte pieces, or to the unknown piece.

Results in odd cases: null and empty texts have no ids; a text of any length is cut into
words first, and a word of any length is encoded whole; repeated rows are each encoded;
an empty table gives no rows; decoding turns the mark U+2581 into a space, as the
library does, and bytes that aren't UTF-8 into U+FFFD.
"""

from __future__ import annotations

import heapq
import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
#: Words whose ids a task keeps; then it starts afresh.
KNOWN_WORDS = 300_000
#: Words over so many code points are encoded one by one.
LONG = 64
#: Code points of the words of one length that advance together.
BATCH = 1 << 18
#: Characters that are cut into words at a time.
PIECE = 2 << 20
#: Bytes of ids that are gathered before rows are handed on.
BATCH_BYTES = 4 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class PieceModel:
    """What encoding needs of a model file; small, and sent to the tasks."""

    keys: np.ndarray  # sorted hashes of pieces
    first: np.ndarray  # position of the first key of each run that shares its top 16 bits
    longest_run: int
    ids: np.ndarray  # their ids
    scores: np.ndarray  # their scores
    longest: int
    unigram: bool
    byte_ids: np.ndarray  # 256 ids, or -1 each
    unknown: int
    surface: list[bytes]  # of each id
    prefix: bool
    crossing: bool  # whether a piece holds a space mark after another character
    unit: re.Pattern  # spaces with a run of letters that pieces connect, or of other characters
    places: dict  # position among the keys of each piece's text
    known: dict = field(default_factory=dict)


def load(path: str) -> PieceModel:
    """Reads a .model file whose normaliser is the identity and keeps white space."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    with open(path, "rb") as f:
        model = proto.ModelProto.FromString(f.read())
    normal, kinds = model.normalizer_spec, proto.ModelProto.SentencePiece
    if normal.name != "identity" or normal.remove_extra_whitespaces or not normal.escape_whitespaces or model.trainer_spec.treat_whitespace_as_suffix:
        raise ValueError("only models with the identity normaliser that keep white space are read")
    if model.trainer_spec.model_type not in (1, 2):
        raise ValueError("only unigram and BPE models are read")
    usual = [i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)]
    byte_ids, surface, unknown = np.full(256, -1), [], 0
    for i, p in enumerate(model.pieces):
        if p.type == kinds.BYTE:
            byte_ids[int(p.piece[1:-1], 16)] = i
            surface.append(bytes([int(p.piece[1:-1], 16)]))
        else:
            unknown = i if p.type == kinds.UNKNOWN else unknown
            surface.append(b"" if p.type == kinds.CONTROL else " ⁇ ".encode() if p.type == kinds.UNKNOWN else p.piece.replace(SPACE, " ").encode())
    keys = np.array([hash_of(model.pieces[i].piece) for i in usual], np.uint64)
    order = np.argsort(keys)
    if (np.diff(keys[order]) == 0).any():
        raise ValueError("two pieces have one hash")
    scores = np.array([model.pieces[i].score for i in usual], np.float32)
    texts = [model.pieces[i].piece for i in usual]
    letters = re.escape(_joined_letters(texts))
    unit = re.compile(f" *[{letters}]+| *[^ {letters}]+| +")
    keys_ = keys[order]
    runs = np.searchsorted(keys_ >> np.uint64(48), np.arange((1 << 16) + 1, dtype=np.uint64))
    return PieceModel(keys_, runs[:-1].astype(np.int32), int(np.diff(runs).max()), np.array(usual)[order], scores[order], max(map(len, texts)), model.trainer_spec.model_type == 1, byte_ids, unknown, surface, normal.add_dummy_prefix, any(SPACE in t.lstrip(SPACE) for t in texts), unit, {texts[i]: at for at, i in enumerate(order.tolist())})


def _points(words: list[str]) -> np.ndarray:
    """Code points of words of one length, plus one, as rows."""
    return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), -1).astype(np.uint64) + np.uint64(1)


def _prefix_hashes(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial hashes of all prefixes, and the powers of the base."""
    n, length = points.shape
    power = np.ones(length + 1, np.uint64)
    prefix = np.zeros((n, length + 1), np.uint64)
    for i in range(length):
        power[i + 1 : i + 2] = power[i : i + 1] * _BASE
        prefix[:, i + 1] = prefix[:, i] * _BASE + points[:, i]
    return prefix, power


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def hash_of(text: str) -> int:
    prefix, _ = _prefix_hashes(_points([text]))
    return int(_mix(prefix[:, -1])[0])


def _probe(model: PieceModel, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position among the keys, found) of each hash; the top bits tell where to start in the sorted keys."""
    mixed = _mix(hashes)
    last = len(model.keys) - 1
    at = np.minimum(model.first[(mixed >> np.uint64(48)).astype(np.int64)], last)
    for _ in range(model.longest_run):
        at = np.minimum(at + (model.keys[at] < mixed), last)
    return at, model.keys[at] == mixed


def viterbi(model: PieceModel, words: list[str]) -> list[bytes]:
    """Ids, as little-endian unsigned 32-bit integers, of words of one length: the best sum of scores."""
    points = _points(words)
    n, length = points.shape
    prefix, power = _prefix_hashes(points)
    best = np.full((n, length + 1), -np.inf)
    best[:, 0] = 0
    back, piece = np.zeros((n, length + 1), np.int32), np.full((n, length + 1), -1, np.int32)
    uncovered = float(model.scores.min()) - 10
    for end in range(1, length + 1):
        for k in range(min(model.longest, end), 0, -1):  # of equal sums the longest last piece wins
            start = end - k
            at, found = _probe(model, prefix[:, end] - prefix[:, start] * power[k])
            score = np.where(found, best[:, start] + model.scores[at], best[:, start] + uncovered if k == 1 else -np.inf)
            better = score > best[:, end]
            best[better, end] = score[better]
            back[better, end] = start
            piece[better, end] = np.where(found, at, -1)[better]
    cuts = np.zeros((n, length + 1), bool)
    cuts[:, 0] = True
    at, rows = np.full(n, length), np.arange(n)
    while (at > 0).any():
        cuts[rows, at] = True
        at = back[rows, at]
    return _collect(model, words, cuts, piece)


def merges(model: PieceModel, words: list[str]) -> list[bytes]:
    """Like viterbi(), joining the best adjacent pair in each round, the leftmost of equals."""
    points = _points(words)
    n, length = points.shape
    prefix, power = _prefix_hashes(points)
    starts = np.tile(np.arange(length + 2, dtype=np.int64), (n, 1))
    starts[:, length + 1 :] = length
    rows = np.arange(n)
    score_of = lambda r, i: _pair_scores(model, prefix, power, starts, r, i, length)
    scores = np.full((n, max(length - 1, 1)), -np.inf, np.float32)
    for i in range(length - 1):
        scores[:, i] = score_of(rows, np.full(n, i))
    left = rows
    while len(left) and length > 1:
        i = scores[left].argmax(axis=1)
        going = scores[left, i] > -np.inf
        left, i = left[going], i[going]
        if not len(left):
            break
        column = np.arange(length + 1)[None, :]
        shifted = column + (column > i[:, None])
        starts[left, : length + 1] = np.take_along_axis(starts[left], shifted, axis=1)
        moved = np.minimum(np.arange(length - 1)[None, :] + (np.arange(length - 1)[None, :] >= i[:, None]), length - 2)
        fresh = np.take_along_axis(scores[left], moved, axis=1)
        fresh[:, -1] = -np.inf
        scores[left] = fresh
        some = i > 0
        scores[left[some], i[some] - 1] = score_of(left[some], i[some] - 1)
        some = i < length - 1
        scores[left[some], i[some]] = score_of(left[some], i[some])
    cuts = np.zeros((n, length + 1), bool)
    np.put_along_axis(cuts, starts[:, : length + 1], True, axis=1)
    piece = np.full((n, length + 1), -1, np.int32)
    r, end = np.nonzero(cuts[:, 1:])
    end += 1
    start = np.maximum.accumulate(np.where(cuts, np.arange(length + 1), 0), axis=1)[r, end - 1]
    at, found = _probe(model, prefix[r, end] - prefix[r, start] * power[end - start])
    piece[r, end] = np.where(found, at, -1)
    return _collect(model, words, cuts, piece)


def long_viterbi(model: PieceModel, word: str) -> bytes:
    """viterbi() of one long word."""
    points = _points([word])[0]
    length, ends, sizes, places = len(points), [], [], []
    hashes = np.zeros(0, np.uint64)
    for k in range(1, min(model.longest, length) + 1):  # of all substrings of k code points, by where they end
        hashes = (hashes[:-1] * _BASE if k > 1 else np.zeros(length, np.uint64)) + points[k - 1 :]
        for at in range(0, len(hashes), BATCH):
            place, found = _probe(model, hashes[at : at + BATCH])
            hit = np.flatnonzero(found)
            ends.append(hit + at + k), sizes.append(np.full(len(hit), k)), places.append(place[hit])
    end, size, place = map(np.concatenate, (ends, sizes, places))
    order = np.lexsort([-size, end])  # of equal sums the longest last piece wins
    first = np.searchsorted(end[order], np.arange(length + 2)).tolist()
    size, place = size[order].tolist(), place[order]
    scores, place, uncovered = model.scores[place].astype(float).tolist(), place.tolist(), float(model.scores.min()) - 10
    best, back, piece = [0.0] * (length + 1), [0] * (length + 1), [-1] * (length + 1)
    for e in range(1, length + 1):
        top, step, which, single = -np.inf, 1, -1, False
        for i in range(first[e], first[e + 1]):
            k = size[i]
            single |= k == 1
            score = best[e - k] + scores[i]
            if score > top:
                top, step, which = score, k, place[i]
        if not single and best[e - 1] + uncovered > top:
            top, step, which = best[e - 1] + uncovered, 1, -1
        best[e], back[e], piece[e] = top, e - step, which
    cuts = []
    while length:
        cuts.append(length)
        length = back[length]
    return _spelled(model, word, cuts[::-1], piece)


def long_merges(model: PieceModel, word: str) -> bytes:
    """merges() of one long word: the best pair comes from a heap, and a joined pair makes two new ones."""
    places, scores, length = model.places, model.scores.tolist(), len(word)
    after, before = list(range(1, length + 2)), list(range(-1, length + 1))  # ends of the symbol that starts here, start of the one before
    heap: list[tuple[float, int, int]] = []

    def offer(start: int) -> None:
        middle = after[start]
        if middle < length:
            place = places.get(word[start : after[middle]])
            if place is not None:
                heapq.heappush(heap, (-scores[place], start, after[middle]))

    for i in range(length - 1):
        offer(i)
    gone = bytearray(length + 1)
    while heap:
        _, start, end = heapq.heappop(heap)
        middle = after[start]
        if gone[start] or middle >= length or after[middle] != end:
            continue
        gone[middle] = 1
        after[start], before[end] = end, start
        if before[start] >= 0:
            offer(before[start])
        offer(start)
    cuts, piece, at = [], {}, 0
    while at < length:
        piece[after[at]] = places.get(word[at : after[at]], -1)
        at = after[at]
        cuts.append(at)
    return _spelled(model, word, cuts, piece)


def _spelled(model: PieceModel, word: str, cuts: list[int], piece) -> bytes:
    ids = model.ids.tolist()
    parts = ([ids[piece[e]]] if piece[e] >= 0 else _bytes(model, word[e - 1]) for e in cuts)
    return np.array(list(itertools.chain.from_iterable(parts)), "<u4").tobytes()


def _pair_scores(model: PieceModel, prefix: np.ndarray, power: np.ndarray, starts: np.ndarray, rows: np.ndarray, i: np.ndarray, length: int) -> np.ndarray:
    """Score of the piece that joins the i-th and next symbol of each row, or minus infinity."""
    start, middle, end = starts[rows, i], starts[rows, i + 1], starts[rows, i + 2]
    at, found = _probe(model, prefix[rows, end] - prefix[rows, start] * power[end - start])
    return np.where(found & (middle < length) & (end > middle), model.scores[at], np.float32(-np.inf))


def _collect(model: PieceModel, words: list[str], cuts: np.ndarray, piece: np.ndarray) -> list[bytes]:
    row, end = np.nonzero(cuts[:, 1:])
    at = piece[row, end + 1]
    ids = np.where(at >= 0, model.ids[at], -1)
    first = np.searchsorted(row, np.arange(len(words) + 1)).tolist()
    raw = ids.astype("<u4").tobytes()
    out = [raw[4 * a : 4 * b] for a, b in zip(first, first[1:])]
    for w in set(row[ids < 0].tolist()):
        span = slice(first[w], first[w + 1])
        parts = [[i] if i >= 0 else _bytes(model, words[w][e]) for i, e in zip(ids[span].tolist(), end[span].tolist())]
        out[w] = np.array(list(itertools.chain.from_iterable(parts)), "<u4").tobytes()
    return out


def _bytes(model: PieceModel, character: str) -> list[int]:
    if (model.byte_ids < 0).any():
        return [model.unknown]
    return model.byte_ids[list(character.encode("utf-8", "replace"))].tolist()


def _joined_letters(pieces: list[str]) -> str:
    """The characters that pieces connect with `a`, directly or not: no piece crosses from these to others."""
    root: dict[str, str] = {}

    def find(c: str) -> str:
        while root.setdefault(c, c) != c:
            root[c] = c = root[root[c]]
        return c

    for piece in pieces:
        piece = piece.lstrip(SPACE)
        for x, y in zip(piece, piece[1:]):
            root[find(x)] = find(y)
    return "".join(c for c in list(root) if find(c) == find("a") and c != SPACE)


def _units(model: PieceModel, text: str) -> list[str]:
    """What a text is cut into, spaces still as spaces."""
    text = text.replace(SPACE, " ") if SPACE in text else text
    text = " " * (model.prefix and text != "") + text
    return [text] if model.crossing and text else model.unit.findall(text)


def encode_texts(model: PieceModel, texts: Iterable[str | None], methods: tuple[str | None, ...] = (None,)) -> Iterator[tuple[bytes, ...]]:
    """For each text its ids by each method, as little-endian unsigned 32-bit integers; method: viterbi or merges, else the model's own."""
    methods = tuple(m or ("viterbi" if model.unigram else "merges") for m in methods)
    table = model.known.setdefault(methods, {})
    runs = [{"viterbi": viterbi, "merges": merges}[m] for m in methods]
    long_runs = [{"viterbi": long_viterbi, "merges": long_merges}[m] for m in methods]

    def learn(words: set[str]) -> None:
        if len(table) > KNOWN_WORDS:
            table.clear()
        for length, group in itertools.groupby(sorted(words.difference(table), key=len), key=len):
            group = list(group)
            if length > LONG:
                table.update((w, tuple(run(model, w.replace(" ", SPACE)) for run in long_runs)) for w in group)
                continue
            step = max(1, BATCH // length)
            for at in range(0, len(group), step):
                part = group[at : at + step]
                spelled = [w.replace(" ", SPACE) for w in part]
                table.update(zip(part, zip(*(run(model, spelled) for run in runs))))

    held: list[list[str]] = []
    size = 0
    for text in itertools.chain(texts, [StopIteration]):
        if text is not StopIteration:
            held.append(_units(model, text or ""))
            size += len(text or "")
        if size > PIECE or text is StopIteration:
            learn(set().union(*held))
            for words in held:
                found = list(map(table.__getitem__, words))
                yield tuple(b"".join([x[i] for x in found]) for i in range(len(methods)))
            held, size = [], 0


def decode_ids(model: PieceModel, ids: bytes) -> str:
    text = b"".join(map(model.surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
    return (text[1:] if model.prefix and text[:1] == b" " else text).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str, methods: tuple[str | None, ...] = (None,), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), decoded: bool = False) -> DataFrame:
    """(doc_id, ids_0 binary, ids_1 ...) and the columns to keep: the ids of every whole text by each method.

    With decoded there are also text_0, ...: the texts that the ids give, decoded in the same task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(load(path))
    names = [f"ids_{i}" for i in range(len(methods))]
    texts_ = [f"text_{i}" for i in range(len(methods))] if decoded else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, at, size = [], 0, 0
            for ids in itertools.chain(encode_texts(shared.value, (t.as_py() for t in batch.column(1)), methods), [None]):
                if ids is not None:
                    rows.append((*ids, *(decode_ids(shared.value, x) for x in ids if decoded)))
                    size += sum(map(len, ids))
                if rows and (ids is None or size > BATCH_BYTES):
                    columns = [pa.array(c, pa.binary() if i < len(names) else pa.string()) for i, c in enumerate(zip(*rows))]
                    part = batch.slice(at, len(rows))
                    yield pa.RecordBatch.from_arrays([part.column(0), *columns, *part.columns[2:]], ["doc_id", *names, *texts_, *keep])
                    rows, at, size = [], at + len(rows), 0

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep)
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[2:]]
    return narrow.mapInArrow(run, ", ".join(["doc_id long", *(f"{n} binary" for n in names), *(f"{n} string" for n in texts_), *kept]))


def decode(encoded: DataFrame, path: str, columns: list[str]) -> DataFrame:
    """encoded with each of the id columns as its text."""
    shared = encoded.sparkSession.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [pa.array([None if b is None else decode_ids(shared.value, b) for b in c.to_pylist()], pa.string()) if n in columns else c for n, c in zip(batch.schema.names, batch.columns)]
            yield pa.RecordBatch.from_arrays(out, batch.schema.names)

    kinds = ", ".join(f"`{f.name}` {'string' if f.name in columns else f.dataType.simpleString()}" for f in encoded.schema.fields)
    return encoded.mapInArrow(run, kinds)
