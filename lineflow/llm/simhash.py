"""SimHash near-duplicates, found with a Gray-order hierarchical index.

Fingerprints: word shingles are hashed with XXH64; a bit is set where over half of the
hashes have it. Linking: distinct fingerprints are dealt to buckets that share a masked
bit pattern (the top nodes of the index). In a bucket they are sorted by Gray rank, so
that neighbours differ in few bits, and consecutive ones form nodes that keep the bits
all members share. A search goes down level by level, adds up the differences found in
each node's own bits and drops a whole node once they exceed the limit.

Results in odd cases: null and empty texts and texts without words have fingerprint
zero and are linked like any other; equal fingerprints always link; rows with a null id
link others like any row, and their component is null only if no row of it has an id; an
empty table gives no rows; columns other than id and text are not looked at.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineflow.llm.common import cut, released, shuffles_removed, written
from lineflow.llm.components import components, forest

#: A bucket with more fingerprints than this is compared in pairs of chunks, by several tasks.
BUCKET_ROWS = 2048
#: Children of an index node.
FANOUT = 8
#: Words of fingerprints that a task gathers before it builds the index for whole buckets.
BUFFER_WORDS = 200_000
#: Words of (query, node) pairs held at a time in a search.
FRONTIER = 1_000_000
#: Fingerprints of a bucket, about, that the number of blocks or of mask bits is chosen for.
BUCKET_GOAL = 64
#: Pairs with a set of so many shingles at most are found by their members, others by their fingerprints.
SMALL = 64
#: Words of the fingerprints that near duplicates are searched by.
NEAR_WORDS = 4
#: Words of the finer fingerprints that the pairs left over are told apart by.
FINE_WORDS = 64
#: Standard deviations of the estimate that the limit of bits allows, as an exact check follows.
DEVIATIONS = 4.0
#: Share of pairs at the similarity, with the mean number of differing bits, that share a bucket.
RECALL = 0.9999
#: Pairs of a set that are checked before those found alike are joined and the others searched again.
FEW_PAIRS = 2
#: Sets or pairs of sets to compare are broadcast up to this many, and joined by a shuffle beyond it.
BROADCAST_SETS = 200_000
#: Members of more sets than this come last in a prefix; a list of so many rows of them is broadcast.
COMMON, COMMON_ROWS = 100, 200_000
#: Hashes that are summed up at a time.
SLICE = 65_536

_SPREAD = np.zeros(256, np.uint64)  # bit j of a byte -> byte j of a word
for _j in range(8):
    _SPREAD |= ((np.arange(256, dtype=np.uint64) >> np.uint64(_j)) & np.uint64(1)) << np.uint64(8 * _j)


# fingerprints ---------------------------------------------------------------


def shingle_hashes(text: bytes | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the text's word shingles, A-Z lower-cased, repeats included."""
    words = (text or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(itertools.islice(words, i, None) for i in range(shingle))))
    digests = b"".join(map(xxhash.xxh64_digest, grams, itertools.repeat(42)))
    return np.frombuffer(digests, ">u8").astype(np.uint64)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits; eight counters share a word."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), SLICE):
        part = hashes[at : at + SLICE]
        spread = _SPREAD[part.view(np.uint8).reshape(-1, 8)]
        sums = np.add.reduceat(spread, np.arange(0, len(part), 255), axis=0)
        total += np.ascontiguousarray(sums).view(np.uint8).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return total


def _mixed(hashes: np.ndarray, k: int) -> np.ndarray:
    """The k-th independent hash made from the first (splitmix64's finaliser)."""
    z = hashes + np.uint64((0x9E3779B97F4A7C15 * k) & 0xFFFFFFFFFFFFFFFF)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def fingerprint(text: bytes | None, shingle: int, n_words: int = 1, distinct: bool = False) -> np.ndarray:
    """n_words 64-bit words; the first is the plain SimHash. Repeated shingles count once if distinct."""
    hashes = shingle_hashes(text, shingle)
    return _fingerprint(np.unique(hashes) if distinct else hashes, n_words)


def _fingerprint(hashes: np.ndarray, n_words: int) -> np.ndarray:
    out = np.zeros(n_words, np.uint64)
    for k in range(n_words):
        counts = bit_counts(hashes if k == 0 else _mixed(hashes, k))
        out[k] = np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0]
    return out


def fingerprints(docs: DataFrame, shingle: int, n_words: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, fp array<long>) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fps = np.zeros((batch.num_rows, n_words), np.uint64)
            for i in range(batch.num_rows):
                fps[i] = fingerprint(texts[i].as_py(), shingle, n_words)
            flat = pa.array(fps.view(np.int64).ravel())
            offsets = pa.array(np.arange(0, len(flat) + 1, n_words, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, flat)], ["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, fp array<long>")


# the index ------------------------------------------------------------------


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each 64-bit code in the Gray sequence."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Index over the fingerprints of several buckets: fps (n, words), bucket (n), ascending bucket."""

    def __init__(self, fps: np.ndarray, bucket: np.ndarray):
        self.order = np.lexsort([*(gray_rank(fps[:, k]) for k in range(fps.shape[1] - 1, -1, -1)), bucket])
        self.fps, bucket = fps[self.order], bucket[self.order]
        n = len(bucket)
        new = np.ones(n, bool)
        new[1:] = bucket[1:] != bucket[:-1]
        first = np.flatnonzero(new)
        self.bucket_of = np.cumsum(new) - 1
        size = np.diff(np.append(first, n))
        # levels[0] are the fingerprints; a node is (first child, children, last leaf)
        ones, every = np.full_like(self.fps, ~np.uint64(0)), np.arange(n)
        levels = [{"all": self.fps, "any": self.fps, "mask": ones, "child": every, "n": np.ones(n, int), "last": every}]
        while (size > 1).any():
            below = levels[-1]
            within = np.arange(len(below["last"])) - np.repeat(first, size)
            starts = np.flatnonzero(within % FANOUT == 0)
            n_child = np.diff(np.append(starts, len(within)))
            together = np.bitwise_and.reduceat(below["all"], starts, axis=0)
            either = np.bitwise_or.reduceat(below["any"], starts, axis=0)
            levels.append({"all": together, "any": either, "mask": ~(together ^ either), "child": starts, "n": n_child, "last": below["last"][starts + n_child - 1]})
            size = -(-size // FANOUT)
            first = np.concatenate([[0], np.cumsum(size)[:-1]])
        above = np.zeros((len(levels[-1]["last"]), fps.shape[1]), np.uint64)
        for k in range(len(levels) - 1, -1, -1):
            level = levels[k]
            level["own"] = level["mask"] & ~above
            above = np.repeat(level["mask"], level["n"], axis=0)
        self.levels = levels

    def search(self, limit: int, asked: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (p, q) of positions in the original arrays that differ in at most limit bits, each once.

        asked (n, of the original positions): only pairs with a member of these are
        looked for, by searches from these alone; a pair of two comes twice.
        """
        n, widest = len(self.fps), np.bincount(self.bucket_of).max() if len(self.fps) else 1
        queries = np.arange(n) if asked is None else np.flatnonzero(asked[self.order])
        step = max(1, FRONTIER // (int(widest) * self.fps.shape[1]))
        for at in range(0, len(queries), step):
            query = queries[at : at + step]
            node = self.bucket_of[query]
            done = np.zeros(len(query), np.int64)
            for k in range(len(self.levels) - 1, -1, -1):
                level = self.levels[k]
                differ = (self.fps[query] ^ level["all"][node]) & level["own"][node]
                done = done + np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
                keep = done <= limit
                if asked is None:
                    keep &= level["last"][node] > query
                query, node, done = query[keep], node[keep], done[keep]
                if k:
                    n_child = level["n"][node]
                    begin = np.repeat(level["child"][node] - np.cumsum(n_child) + n_child, n_child)
                    query, done = np.repeat(query, n_child), np.repeat(done, n_child)
                    node = begin + np.arange(len(begin))
            apart = query != node
            if apart.any():
                yield self.order[query[apart]], self.order[node[apart]]


# linking --------------------------------------------------------------------


def blocks(n: int, limit: int) -> list[tuple[int, int]]:
    """(word, mask) of the tables of buckets for n fingerprints of one word: none within limit bits is missed.

    The word is cut into blocks; two fingerprints that differ in at most limit bits are
    equal in all but `limit` blocks, so a table for each choice of the blocks that are
    left finds them. More blocks mean longer masks and more tables; as few are taken as
    keep a bucket at BUCKET_GOAL fingerprints, about.
    """
    if limit > 15:
        raise ValueError("blocks need a limit of 15 bits at most")
    count = limit + 1
    while count < 64 and n > BUCKET_GOAL << int(64 * (count - limit) / count) and math.comb(count + 1, limit) <= 256:
        count += 1
    edges = np.linspace(0, 64, count + 1).astype(int).tolist()
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    return [(0, sum(kept)) for kept in itertools.combinations(parts, count - limit)]


def bit_share(similarity: float) -> float:
    """Share of bits in which sets of a Jaccard similarity differ, on average."""
    return float(np.arccos(2 * similarity / (1 + similarity)) / np.pi)


def bit_limit(similarity: float, n_bits: int, deviations: float = 3) -> int:
    """Bits that may differ between texts of a Jaccard similarity, with some standard deviations of the estimate."""
    share = bit_share(similarity)
    return int(n_bits * share + deviations * np.sqrt(n_bits * share * (1 - share)))


def drawn_masks(n: int, n_words: int, similarity: float) -> list[tuple[int, int]]:
    """(word, mask) of the tables of buckets for n fingerprints of several words, for limits too wide for blocks.

    Masks are drawn with a fixed seed: so many bits that a bucket holds BUCKET_GOAL
    fingerprints, about, and so many tables that RECALL of the pairs share a bucket.
    """
    bits = max(8, math.ceil(math.log2(max(n, 2) / BUCKET_GOAL)))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - bit_share(similarity)) ** bits))
    draw = np.random.default_rng(20)
    return [(t % n_words, sum(1 << int(b) for b in draw.choice(64, bits, replace=False))) for t in range(tables)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(fps: DataFrame, n_words: int, limit: int, tables: list[tuple[int, int]], mode: str = "chains", similarity: float = 0.0, fine_limit: int | None = None, most: int | None = None) -> DataFrame:
    """fps (v long, f0 .. long, and label long, size int, shared int where mode is met, and fine binary where it is rest), distinct -> links (a long, b long, bits int) within limit bits.

    bits tells how many bits differ, 0 where that isn't known. chains: a chain through each
    group of a bucket, which spans it. first: of each
    fingerprint its partners among the first of its bucket, the one nearest to the majority
    of the bucket's bits and the one before it in Gray order, or else the first that a search finds; so few that a group of k gives some k
    links, but every fingerprint with a partner in a bucket has a link. rest: all pairs of
    different labels, each once, that can have the similarity: sets of `size` members, of
    which `shared` are in any other set, have the smaller `shared` in common at most, and
    their finer fingerprints differ in fine_limit bits at most. With `most` a task hands on
    so many of one row at most, and rows of bits -1 for those that have more. met: not links, but the rows of
    buckets that the pairs of rest come from but for the finer fingerprints, which told_apart() looks at: most rows of most
    buckets meet none, and finer fingerprints are long.

    In a bucket over BUCKET_ROWS most rows are near to its first fingerprint, or have its
    most frequent label: these need not meet each other, only the others. They are cut
    into chunks, so are the others, and each pair of chunks is a cell of its own.
    """
    if mode == "rest":
        met = links(fps.drop("fine"), n_words, limit, tables, "met", similarity)
        return told_apart(met, fps.select("v", "label", "fine"), n_words, limit, tables, similarity, fine_limit, most).select("a", "b", "bits")
    names = [f"f{i}" for i in range(n_words)]
    extra = ["label", "size", "shared", "t"] if mode == "met" else []
    which = F.posexplode(F.array(*(F.lit(_signed(m)) for _, m in tables))).alias("t", "mask")
    rows = fps.select("v", *names, *extra, which)
    word = F.get(F.array(*names), F.get(F.array(*(F.lit(w) for w, _ in tables)), F.col("t"))) if n_words > 1 else F.col("f0")
    rows = rows.select(F.xxhash64("t", word.bitwiseAND(F.col("mask"))).alias("bucket"), "v", *names, *extra)
    if mode == "met":
        sizes = rows.groupBy("bucket", "label").agg(F.count("*").alias("k")).groupBy("bucket").agg(F.sum("k").alias("count"), F.max_by("label", "k").alias("often"))
        near = F.col("label") == F.col("often")
    else:
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("count"), F.min("v").alias("pivot"), *(F.min_by(f, "v").alias(f"p{f}") for f in names))
        near = sum((F.bit_count(F.col(f).bitwiseXOR(F.col(f"p{f}"))) for f in names), F.lit(0)) <= limit
    hot = cut(sizes.where(F.col("count") > BUCKET_ROWS))
    found = None
    rows = rows.withColumns({"cell": F.lit(0).cast("long"), "asked": F.lit(True)})
    if not hot.isEmpty():
        tagged = cut(rows.drop("cell", "asked").join(hot, "bucket").withColumn("near", near))
        if mode != "met":
            found = tagged.where(F.col("near") & (F.col("v") != F.col("pivot"))).select(F.col("v").alias("a"), F.col("pivot").alias("b"), F.lit(0).alias("bits"))
        parts = tagged.groupBy("bucket").agg(F.count_if("near").alias("n"), F.count_if(~F.col("near")).alias("f"))
        parts = parts.where("f > 0").select("bucket", *(F.ceil(F.col(c) / BUCKET_ROWS).cast("int").alias(c) for c in "nf"))
        tagged = tagged.join(parts, "bucket").withColumn("c", F.pmod(F.xxhash64(*names), F.when(F.col("near"), F.col("n")).otherwise(F.col("f"))).cast("long"))
        upto = lambda k: F.filter(F.sequence(F.lit(0), F.col(k)), lambda i: i < F.col(k))
        cell = lambda low, high: low.cast("long") * (1 << 30) + high.cast("long")
        with_near = F.when(F.col("near"), F.transform(upto("f"), lambda d: cell(F.col("c"), d) + 1)).otherwise(F.transform(upto("n"), lambda d: cell(d, F.col("c")) + 1))
        alone = F.when(~F.col("near"), F.transform(upto("f"), lambda d: cell(F.least("c", d.cast("long")), F.greatest("c", d.cast("long"))) + (1 << 61))).otherwise(F.expr("cast(array() as array<bigint>)"))
        cells = tagged.select("bucket", "v", *names, *extra, F.explode(F.concat(with_near, alone)).alias("cell"), (~F.col("near")).alias("asked"))
        rows = rows.join(hot.select("bucket"), "bucket", "left_anti").unionByName(cells)
    rows = rows.select("bucket", "cell", "asked", "v", *extra, *names)

    if mode == "met":
        pairs = _pairs_of(n_words, limit, tables, similarity)

        def meeting(rows: pa.RecordBatch, bucket: np.ndarray, asked: np.ndarray, v: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            meets = np.zeros(len(v), bool)
            for p, q in pairs(rows, bucket, asked, fp):
                meets[p] = meets[q] = True
            yield rows.filter(pa.array(meets)).drop_columns(["label"])

        return _by_bucket(rows, n_words, meeting, ", ".join(["bucket long, cell long, asked boolean, v long, size int, shared int, t int", *(f"{f} long" for f in names)]))

    def search(rows: pa.RecordBatch, bucket: np.ndarray, asked: np.ndarray, v: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        return map(_link_batch, {"chains": _chains, "first": _first}[mode](fp, bucket, v, asked, limit))

    searched = _by_bucket(rows, n_words, search, "a long, b long, bits int")
    return searched if found is None else searched.union(found)


def told_apart(met: DataFrame, marks: DataFrame, n_words: int, limit: int, tables: list[tuple[int, int]], similarity: float, fine_limit: int | None, most: int | None = None) -> DataFrame:
    """(a, b, bits, bucket, cell): the links of mode rest in links(), from its rows that meet and marks (v, label, fine).

    Labels may have been joined to larger groups since the rows met. Rows of bits -1 are
    those of met, by a, bucket and cell, that have a pair which `most` held back: no other
    row is needed to find these pairs.
    """
    names = [f"f{i}" for i in range(n_words)]
    rows = met.join(marks, "v").select("bucket", "cell", "asked", "v", "label", "size", "shared", "t", *names, "fine")
    pairs = _pairs_of(n_words, limit, tables, similarity)

    def search(rows: pa.RecordBatch, bucket: np.ndarray, asked: np.ndarray, v: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        prints = np.frombuffer(b"".join(rows.column("fine").to_pylist()), np.uint64).reshape(len(v), -1)
        held, key, cell = np.zeros(len(v), bool), rows.column("bucket").to_numpy(), rows.column("cell").to_numpy()
        for p, q in _finer(prints, fine_limit, pairs(rows, bucket, asked, fp), held, most):
            yield _link_batch((v[p], v[q], np.zeros(len(p), np.int32), key[p], cell[p]))
        yield _link_batch((v[held], v[held], np.full(held.sum(), -1, np.int32), key[held], cell[held]))

    return _by_bucket(rows, n_words, search, "a long, b long, bits int, bucket long, cell long")


def _link_batch(found: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    names = ["a", "b", "bits", "bucket", "cell"][: len(found)]
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int32() if c == "bits" else pa.int64()) for x, c in zip(found, names)], names)


def _pairs_of(n_words: int, limit: int, tables: list[tuple[int, int]], similarity: float) -> Callable[..., Iterator[tuple[np.ndarray, np.ndarray]]]:
    def pairs(rows: pa.RecordBatch, bucket: np.ndarray, asked: np.ndarray, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        label, size, shared, t = (rows.column(c).to_numpy() for c in ("label", "size", "shared", "t"))
        can = lambda p, q: np.minimum(shared[p], shared[q]) >= similarity / (1 + similarity) * (size[p] + size[q]) - 1e-6
        return _rest(fp, bucket, label, t, asked, limit, tables, can)

    return pairs


def _by_bucket(rows: DataFrame, n_words: int, search: Callable[..., Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """What search() gives for rows (bucket, cell, asked, v, .., f0 ..), as many whole buckets at a time as fill a buffer."""
    room = BUFFER_WORDS // n_words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                if sum(b.num_rows for b in held) < room:
                    continue
            if not held or not sum(b.num_rows for b in held):
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            n = rows.num_rows
            key, cell = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            new = np.ones(n, bool)
            new[1:] = (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])
            end = n if batch is None else int(np.flatnonzero(new)[-1])  # the last bucket may go on
            held = [rows.slice(end)] if end < n else []
            if not end:
                continue
            rows = rows.slice(0, end)
            asked, v = rows.column(2).to_numpy(zero_copy_only=False), rows.column(3).to_numpy()
            fp = np.column_stack([rows.column(f"f{i}").to_numpy() for i in range(n_words)]).view(np.uint64)
            yield from search(rows, np.cumsum(new[:end]) - 1, asked, v, fp)

    return rows.repartition("bucket", "cell").sortWithinPartitions("bucket", "cell").mapInArrow(released(run), schema)


def _chains(fp: np.ndarray, bucket: np.ndarray, v: np.ndarray, asked: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, ...]]:
    root = forest(len(v), GrayIndex(fp, bucket).search(limit, None if asked.all() else asked))
    by = np.lexsort([np.arange(len(v)), root])
    same = root[by][1:] == root[by][:-1]
    yield v[by][:-1][same], v[by][1:][same], np.zeros(same.sum(), np.int32)


def _first(fp: np.ndarray, bucket: np.ndarray, v: np.ndarray, asked: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, ...]]:
    index, n = GrayIndex(fp, bucket), len(v)
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    by_v = np.lexsort([v, bucket])
    pivot = np.repeat(by_v[starts], np.diff(np.r_[starts, n]))
    # the member nearest to the majority of its bucket's bits: of a family of copies, likely what they were copied from
    size = np.diff(np.r_[starts, n])
    majority = np.empty((len(starts), fp.shape[1]), np.uint64)
    for k in range(fp.shape[1]):  # sums of one word's bits at a time, as they take 256 bytes a row
        bits = np.unpackbits(np.ascontiguousarray(fp[:, k]).view(np.uint8).reshape(n, 8), axis=1)
        majority[:, k] = np.packbits(2 * np.add.reduceat(bits, starts, axis=0, dtype=np.int32) > size[:, None], axis=1).view(np.uint64)[:, 0]
    off = np.bitwise_count(fp ^ np.repeat(majority, size, axis=0)).sum(axis=1)
    middle = np.repeat(np.lexsort([v, off, bucket])[starts], size)
    before = np.arange(n)
    follows = bucket[index.order[1:]] == bucket[index.order[:-1]]
    before[index.order[1:][follows]] = index.order[:-1][follows]
    partnered = ~asked
    for other in (pivot, middle, before):
        bits = np.bitwise_count(fp ^ fp[other]).sum(axis=1, dtype=np.int32)
        near = (bits <= limit) & (v != v[other])
        partnered[near] = partnered[other[near]] = True
        yield v[near], v[other[near]], bits[near]
    best = np.full(n, np.iinfo(np.int64).max)
    for p, q in index.search(limit, ~partnered):
        other = v[p] != v[q]
        np.minimum.at(best, p[other], v[q[other]])
    found = best < np.iinfo(np.int64).max
    yield v[found], best[found], np.zeros(found.sum(), np.int32)


def _finer(fine: np.ndarray, limit: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]], held: np.ndarray, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The near ones of pairs, `most` of one row at most; held is set for the ends of those beyond."""
    taken = np.zeros(len(fine), np.int64)
    for p, q in pairs:
        for at in range(0, len(p), SLICE):
            a, b = p[at : at + SLICE], q[at : at + SLICE]
            near = np.bitwise_count(fine[a] ^ fine[b]).sum(axis=1, dtype=np.int64) <= limit
            a, b = a[near], b[near]
            if most is not None and len(a):
                by = np.argsort(a, kind="stable")
                a, b = a[by], b[by]
                first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
                kept = taken[a] + np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)])) < most
                held[a[~kept]] = held[b[~kept]] = True
                a, b = a[kept], b[kept]
                np.add.at(taken, a, 1)
            yield a, b


def _rest(fp: np.ndarray, bucket: np.ndarray, label: np.ndarray, t: np.ndarray, asked: np.ndarray, limit: int, tables: list[tuple[int, int]], can: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    by = np.lexsort([label, bucket])
    runs = np.flatnonzero(np.r_[True, (bucket[by][1:] != bucket[by][:-1]) | (label[by][1:] != label[by][:-1])])
    length = np.diff(np.r_[runs, len(label)])
    most = np.zeros(bucket[-1] + 1, np.int64)
    np.maximum.at(most, bucket[by[runs]], length)
    frequent = np.flatnonzero(length == most[bucket[by[runs]]])
    frequent = frequent[np.unique(bucket[by[runs[frequent]]], return_index=True)[1]]  # one of equals; its members need not be asked
    whole, asked = np.logical_and.reduceat(asked, np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])), asked.copy()
    for r in frequent[whole[bucket[by[runs[frequent]]]]]:  # in a cell the rows not asked are of one label already
        asked[by[runs[r] : runs[r] + length[r]]] = False
    for p, q in GrayIndex(fp, bucket).search(limit, asked):
        apart = (label[p] != label[q]) & (~asked[q] | (p < q)) & can(p, q)
        p, q = p[apart], q[apart]
        apart = np.ones(len(p), bool)
        for i, (w, mask) in enumerate(tables):  # a pair comes from the first table that has it in one bucket
            apart &= (t[p] <= i) | ((fp[p, w] ^ fp[q, w]) & np.uint64(mask) != 0)
        yield p[apart], q[apart]


def groups(docs: DataFrame, shingle: int = 3, limit: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fp long, component_id): the smallest id reachable over links of at most limit bits between 64-bit fingerprints."""
    prints = cut(fingerprints(docs, shingle, 1, id_col, text_col).select("doc_id", F.col("fp")[0].alias("fp")))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    vertices = distinct.select(F.col("fp").alias("v"), F.col("fp").alias("f0"))
    found = components(links(vertices, 1, limit, blocks(distinct.count(), limit)))
    named = distinct.join(found, F.col("fp") == F.col("v"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    linked = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(named.join(linked, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


# near duplicates ------------------------------------------------------------


#: Rows whose sets are handed on at a time.
SET_ROWS = 1000


def shingle_sets(docs: DataFrame, shingle: int, n_words: int, largest: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h, g, v, n, f0 .., x) of every row.

    h and g are hashes of the text, v is the hash and n the size of its shingle set, f0 ..
    are its fingerprint, x are its members where there are `largest` at most, else null.
    Without words (n_words 0) there is no fingerprint.
    """
    names = [f"f{i}" for i in range(n_words)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, SET_ROWS) for b in batches for at in range(0, b.num_rows, SET_ROWS)):
            v, n, x = [], [], []
            prints = np.zeros((batch.num_rows, n_words), np.uint64)
            for i, text in enumerate(batch.column(3)):
                members = np.unique(shingle_hashes(text.as_py(), shingle))
                v.append(_mixed(members, 101).sum(dtype=np.uint64))
                n.append(len(members))
                x.append(members.view(np.int64) if len(members) <= largest else None)
                if n_words:
                    prints[i] = _fingerprint(members, n_words)
            words = [pa.array(prints[:, i].view(np.int64)) for i in range(n_words)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.array(v, np.uint64).view(np.int64)), pa.array(n, pa.int32()), *words, pa.array(x, pa.list_(pa.int64()))], ["doc_id", "h", "g", "v", "n", *names, "x"])

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("g"), text.cast("binary").alias("text"))
    return rows.mapInArrow(released(run), ", ".join(["doc_id long, h long, g long, v long, n int", *(f"{f} long" for f in names), "x array<long>"]))


def finer(members: DataFrame) -> DataFrame:
    """(v, fine binary) of sets (v, x): fingerprints of FINE_WORDS words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = [_fingerprint(x.values.to_numpy().view(np.uint64), FINE_WORDS).tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fine, pa.binary())], ["v", "fine"])

    return members.select("v", "x").mapInArrow(released(run), "v long, fine binary")


def alike(pairs: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets in members (v, x) have a Jaccard similarity of at least `similarity`."""
    pairs, few = cut(pairs), lambda df: df
    if pairs.count() <= BROADCAST_SETS:  # then only sets that pairs name are shuffled
        few = F.broadcast
    left = members.join(few(pairs), F.col("v") == F.col("a")).select("a", "b", F.col("x").alias("xa"))
    right = members.join(few(pairs.select(F.col("b").alias("v")).distinct()), "v", "left_semi").select(F.col("v").alias("b"), F.col("x").alias("xb"))
    both = left.join(right, "b").select("a", "b", F.size("xa").alias("na"), F.size("xb").alias("nb"), F.size(F.array_intersect("xa", "xb")).alias("i"))
    return both.where(F.col("i") >= F.lit(similarity) * (F.col("na") + F.col("nb") - F.col("i")) - 1e-9).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()


def _labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """rows (v, ..) with the label of v, which is v itself where it has no root."""
    return rows.join(roots.select("v", "root"), "v", "left").withColumn("label", F.coalesce("root", "v")).drop("root")


def duplicate_groups(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, n_words: int = NEAR_WORDS, id_col: str = "doc_id", text_col: str = "text", exact_to: int = SMALL) -> DataFrame:
    """(doc_id, h, g, root) of every row; h and g are hashes of its text, root names its group.

    Pairs with a set of exact_to shingles at most come from a prefix-filter join, which
    misses none; pairs of larger sets come from the index over fingerprints, which misses
    some few in 100,000. With exact_to over the largest set no link is missed, at the cost
    of a join over a fifth of all shingles.

    Pairs from the index are candidates only; each is checked by its shingle sets, so that
    a link means an exact similarity. Rows of one set are one vertex. Two steps keep the
    number of pairs near the number of texts, however large a group is: first each set is
    checked against the smallest and the nearest of its first candidates, and then all
    pairs within the limits of bits, of the fingerprints and of the finer ones, are that are
    in different groups still, in rounds: FEW_PAIRS of each set, and while there are more,
    four times as many of those that were held back and are in different groups by then; but for those whose members in no other set rule the
    similarity out.
    """
    prints = written(shingle_sets(docs, shingle, n_words, int(exact_to / similarity) + 1, id_col, text_col), "sets")
    with shuffles_removed(docs.sparkSession):
        roots = _roots(docs, prints, shingle, similarity, n_words, id_col, text_col, exact_to)
    return prints.select("doc_id", "h", "g", "v").join(roots, "v", "left").select("doc_id", "h", "g", F.coalesce("root", "v").alias("root"))


def _roots(docs: DataFrame, prints: DataFrame, shingle: int, similarity: float, n_words: int, id_col: str, text_col: str, exact_to: int) -> DataFrame:
    """(v, root) of the sets in prints, the table of shingle_sets(), that are linked to another one."""
    names = [f"f{i}" for i in range(n_words)]
    distinct = cut(prints.groupBy("v").agg(F.first("n").alias("n"), *(F.first(f).alias(f) for f in names)))
    large = distinct.where(F.col("n") > exact_to).select("v", "n", *names)
    tables, limit = drawn_masks(large.count(), n_words, similarity), bit_limit(similarity, 64 * n_words, DEVIATIONS)
    small = prefixes(prints.where("x is not null and n > 0").select("v", "n", "x").dropDuplicates(["v"]), similarity)

    pairs = links(large.drop("n"), n_words, limit, tables, "first").union(first_holders(small)).where("a <> b")
    end = lambda v, b: F.struct(F.col(v).alias("v"), F.col(b).alias("b"), "bits")
    both = pairs.select(F.explode(F.array(end("a", "b"), end("b", "a"))).alias("x")).select("x.*")
    partners = cut(both.groupBy("v").agg(F.min("b").alias("least"), F.min_by("b", "bits").alias("nearest")))
    needed = cut(partners.select("v").union(small.select("v")).distinct())
    if needed.count() <= BROADCAST_SETS:
        needed = F.broadcast(needed)
    sets = shingle_sets(docs, shingle, 0, 1 << 62, id_col, text_col).select("v", "x")
    members = cut(sets.join(needed, "v", "left_semi").dropDuplicates(["v"]))

    pairs = _ordered(partners.select(F.col("v").alias("a"), F.explode(F.array("least", "nearest")).alias("b")))
    good = cut(alike(pairs, members, similarity))
    labels = cut(_labelled(needed, components(good)))
    asked = large.join(labels.select("v"), "v").join(lone(members.where(F.size("x") > exact_to)), "v", "left").select("v", *names, F.col("n").alias("size"), (F.col("n") - F.coalesce("lone", F.lit(0))).cast("int").alias("shared"))
    asked = cut(asked.where(F.col("shared") >= F.lit(similarity) * F.col("size") - 1e-9))
    few = asked.select("v")
    fine = written(finer(members.join(F.broadcast(few) if asked.count() <= BROADCAST_SETS else few, "v", "left_semi")), "fine")
    good = cut(good.union(alike(_ordered(other_holders(small.join(labels, "v"), similarity)), members, similarity)))
    fine_limit, most, met, waiting = bit_limit(similarity, 64 * FINE_WORDS, DEVIATIONS), FEW_PAIRS, None, None
    while True:
        named = _labelled(asked, components(good))
        if met is None:
            met = written(links(named, n_words, limit, tables, "met", similarity), "met")
        more = written(told_apart(met, named.select("v", "label").join(fine, "v"), n_words, limit, tables, similarity, fine_limit, most), "rest")
        pairs = more.where("bits >= 0").select("a", "b")
        if waiting is not None:
            label = lambda c: named.select(F.col("v").alias(c), F.col("label").alias(f"l{c}"))  # noqa: B023, E731
            pairs = pairs.union(waiting.join(label("a"), "a").join(label("b"), "b").where("la <> lb").select("a", "b"))
        place = F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64("a", "b")))
        pairs = cut(_ordered(pairs).withColumn("place", place))
        good = cut(good.union(alike(pairs.where(F.col("place") <= most).select("a", "b"), members, similarity)))
        waiting, held = pairs.where(F.col("place") > most).select("a", "b"), more.where("bits < 0").select("bucket", "cell", F.col("a").alias("v"))
        if held.isEmpty() and waiting.isEmpty():
            break
        met, most = written(met.join(held, ["bucket", "cell", "v"], "left_semi"), "met"), 4 * most
    return components(good)


def lone(members: DataFrame) -> DataFrame:
    """(v, lone): how many members of each set (v, x) no other set has; sets without any are left out."""
    held = members.select("v", F.explode("x").alias("s")).groupBy("s").agg(F.count("*").alias("k"), F.min("v").alias("v"))
    return held.where("k = 1").groupBy("v").agg(F.count("*").alias("lone"))


def prefixes(sets: DataFrame, similarity: float) -> DataFrame:
    """(v, n, s): the first members of each set (v, n, x), rare ones coming first; two sets of the similarity share one."""
    listed = sets.select("v", "n", F.explode("x").alias("s"))
    common = cut(listed.groupBy("s").agg(F.count("*").alias("often")).where(F.col("often") > COMMON))
    ranked = listed.join(F.broadcast(common) if common.count() <= COMMON_ROWS else common, "s", "left").select("v", "n", F.struct(F.coalesce("often", F.lit(0)).alias("often"), "s").alias("s"))
    place = F.row_number().over(Window.partitionBy("v").orderBy("s"))
    return cut(ranked.withColumn("place", place).where(F.col("place") <= F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1).select("v", "n", "s.s"))


def first_holders(first: DataFrame) -> DataFrame:
    """(a, b, bits 0): of the holders of each member in prefixes() the smallest with each other."""
    least = first.groupBy("s").agg(F.min("v").alias("a"))
    return first.join(least, "s").where("a <> v").select("a", F.col("v").alias("b"), F.lit(0).alias("bits"))


def other_holders(first: DataFrame, similarity: float) -> DataFrame:
    """(a, b): all pairs of holders with different labels, and sizes that allow the similarity; first has a label."""
    several = first.groupBy("s").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("s")
    first = first.join(several, "s", "left_semi")
    a, b = (first.select(F.col("v").alias(c), F.col("n").alias(f"n{c}"), F.col("label").alias(f"l{c}"), "s") for c in "ab")
    return a.join(b, "s").where((F.col("a") < F.col("b")) & (F.col("la") != F.col("lb")) & (F.least("na", "nb") >= F.lit(similarity) * F.greatest("na", "nb") - 1e-9)).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 5, similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", exact_to: int = SMALL) -> DataFrame:
    """(doc_id, component_id): the smallest id reachable over texts whose shingle sets have a Jaccard similarity of `similarity` or more.

    Sets are compared by the 64-bit hashes of their shingles; exact_to as in duplicate_groups().
    """
    groups = cut(duplicate_groups(docs, shingle, similarity, id_col=id_col, text_col=text_col, exact_to=exact_to))
    return groups.join(groups.groupBy("root").agg(F.min("doc_id").alias("component_id")), "root").select("doc_id", "component_id")
