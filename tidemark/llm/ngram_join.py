"""N-gram Jaccard join by parity sketches.

Two texts link when the Jaccard similarity of their shingle sets reaches a threshold. For sets A and B that link, the
symmetric difference has at most d = floor((|A| + |B|) * (1 - t) / (1 + t)) members. Every member is dealt by its hash to
one of d + 1 blocks, of which at least one therefore holds the same members in both (pigeonhole); more precisely, around
the ring of blocks there is one that is equal while it and its successor together differ in one member at most (cycle
lemma). A block is known by the sum of its members' hashes, so that only texts with the same shingles share one, however
many texts there are. Blocks with one member or none are joined with the successor's block and each way to take one
member from it. Documents are dealt by (size band, block, content), never by pairs of documents.

Parity sketches rule pairs out: they hash every member to a bit and flip it, so that the Hamming distance of two sketches
is at most the sets' symmetric difference.

Stages, each of which is bounded in memory:

1. set ids: every distinct set gets a 128-bit id; copies collapse into classes before anything is compared;
2. block rows (key, set id), shuffled once; keys with a single set are dropped in a streaming pass over sorted rows;
3. in each remaining bucket, the member with the most company is the pivot. Of the (member, pivot) pairs whose sizes and
   short sketches allow a link, each member's with the pivot that it shares the most buckets with are verified on the
   exact sets first, then those that this has not connected; the links give components. Before whole sets are fetched,
   sketches in proportion to them rule out what the short ones can't;
4. buckets whose members are still in different components are dealt anew, by two agreeing blocks: the lemma's block and
   what its successor may be. Most of the documents that met because they share a passage part there. Of the members of
   such a finer bucket those pairs are verified that are in different components and whose sizes and sketches of 1,024
   bits allow a link; no other pair leaves the join. That makes the result exact: every pair that links is either
   verified or already connected.

Hot groups: a group of near copies is dealt over as many keys as it has blocks, aggregates are partial, and the joins on
pivots are plain equi-joins that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, drop, fresh, released

U = np.uint64
_M1, _M2, _GOLD = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)
_P = U(0xD6E8FEB86659FD93)
#: A block with fewer members than this is joined with its successor.
SPARSE = 2
#: Bits of the filter that keeps documents without candidates out of the verification; 8 MB at any input size.
FILTER_BITS = 26
BATCH_ROWS = 200_000
#: Pairs of whole sets that a worker gets at once.
PAIRS = 200
#: A second, short sketch of each set, which rules most chance candidates out before any set is fetched.
SKETCH_WORDS = 32
SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]
#: Words of the sketches that pairs with a pivot are ruled out by first, and pairs within a finer bucket.
FOLDED = 4
FINER = 16


def times(k: int, factor: np.uint64) -> np.uint64:
    """k * factor modulo 2 ** 64."""
    return U(k * int(factor) & 0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


#: A random 64-bit value for each byte; A-Z have those of a-z. Fixed by the seed, so that every worker has the same.
_BYTE = np.random.default_rng(20240607).integers(0, 1 << 64, 256, U, endpoint=False)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_P_INVERSE = U(pow(int(_P), -1, 1 << 64))
#: Bytes of text that are hashed at once (a longer text by itself).
CHUNK = 1 << 18


class _Powers:
    """Powers of a factor modulo 2 ** 64, as many as were asked for."""

    def __init__(self, factor: np.uint64):
        self.factor, self.values = factor, np.ones(1, U)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            self.values = np.concatenate([self.values, self.values * (self.values[-1] * self.factor if len(self.values) > 1 else self.factor)])
        return self.values[:n]


def _wrapping(function):
    def run(*a):
        with np.errstate(over="ignore"):
            return function(*a)

    return run


_up, _down = _Powers(_P), _Powers(_P_INVERSE)


@_wrapping
def _word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts that lie one after another, and where each text's words begin. A word's hash is a
    polynomial of its bytes' values, read off running sums."""
    n = len(data)
    blank = _BLANK[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    word = ~blank
    before = np.ones(n, bool)
    before[1:] = blank[:-1]
    starts = np.flatnonzero(word & (before | edge[:n]))
    after = np.ones(n, bool)
    after[:-1] = blank[1:]
    ends = np.flatnonzero(word & (after | edge[1:])) + 1
    sums = np.zeros(n + 1, U)
    np.cumsum(_BYTE[data] * _up.upto(n), out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _down.upto(n)[starts] + (ends - starts).astype(U) * _GOLD)
    return hashes, np.searchsorted(starts, bounds)


@_wrapping
def _shingles(h: np.ndarray, k: int) -> np.ndarray:
    acc = h[: len(h) - k + 1].copy()
    for i in range(1, k):
        acc *= _P
        acc += h[i : len(h) - k + 1 + i]
    return mix(acc + times(k, _GOLD))


def shingle_sets(texts: pa.Array, width: int) -> Iterator[np.ndarray]:
    """For each text, the sorted distinct 64-bit hashes of its word shingles; A-Z count as a-z.

    A text of fewer words than the width is one shingle, a text without words (or null) has none.
    """
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    valid = texts.is_valid().to_numpy(zero_copy_only=False)
    at = 0
    while at < len(texts):
        upto = max(at + 1, int(np.searchsorted(offsets, offsets[at] + CHUNK, "right")) - 1)
        bounds = offsets[at : upto + 1] - offsets[at]
        hashes, first = _word_hashes(data[offsets[at] : offsets[upto]], bounds)
        whole = _shingles(hashes, width) if len(hashes) >= width else hashes[:0]
        for i in range(upto - at):
            lo, hi = int(first[i]), int(first[i + 1])
            if hi == lo or not valid[at + i]:
                yield hashes[:0]
            elif hi - lo < width:
                yield _shingles(hashes[lo:hi], hi - lo)
            else:
                yield np.unique(whole[lo : hi - width + 1])
        at = upto


def shingle_set(text: str | None, width: int) -> np.ndarray:
    return next(shingle_sets(pa.array([text], pa.string()), width))


class Bands:
    """Size bands: sets that can link are in the same band or in neighbouring ones."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.low, self.high = [1], []
        self._grow(1)

    def _grow(self, size: int) -> None:
        while len(self.high) < 2 or self.high[-2] < size:
            low = self.low[-1]
            self.high.append(max(low, -(-low * self.den // self.num) - 1))
            self.low.append(self.high[-1] + 1)

    def of(self, size: int) -> int:
        self._grow(size)
        return int(np.searchsorted(self.high, size))

    def difference(self, total: int) -> int:
        return total * (self.den - self.num) // (self.den + self.num)

    def blocks(self, band: int) -> int:
        """Blocks of the sketch that serves pairs within a band, or of a band and the next."""
        while len(self.high) < band + 2:
            self._grow(self.high[-1] + 1)
        return self.difference(self.high[band] + self.high[band + 1]) + 1


@_wrapping
def parity_sketch(members: np.ndarray, blocks: int) -> np.ndarray:
    """64 * blocks parity bits as words. Hamming distance never exceeds the symmetric difference."""
    bits = np.bincount((members % U(64 * blocks)).astype(np.int64), minlength=64 * blocks) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view(U)


def _blocks(members: np.ndarray, bands: Bands) -> Iterator[tuple[np.ndarray, ...]]:
    """For pairs within the set's own band, and with the band before: each block's key, sum and size, and each member's
    part of the sums with the places where the blocks' members begin. members are sorted, so that a block has neighbours."""
    own = bands.of(len(members))
    values = mix(members + _GOLD)
    sums = np.concatenate([np.zeros(1, U), np.cumsum(values)])
    for band in (own, own - 1):
        if band >= 0 and (blocks := bands.blocks(band)) >= 2:
            sizes = np.bincount(((members >> U(32)) * U(blocks) >> U(32)).astype(np.int64), minlength=blocks)
            ends = np.cumsum(sizes)
            words = sums[ends] - sums[ends - sizes]
            yield mix(words + mix(np.arange(blocks, dtype=U) + times(band, _P))), words, sizes, values, ends - sizes


def _parts(some: np.ndarray, words: np.ndarray, sizes: np.ndarray, values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For some blocks: the sum of the block after each, then that sum without each one of its members; and how many these are."""
    after = (some + 1) % len(words)
    counts = sizes[after] + 1
    parts = np.repeat(words[after], counts)
    place = np.arange(len(parts)) - np.repeat(np.cumsum(counts) - counts, counts)
    without = np.flatnonzero(place)
    parts[without] -= values[np.repeat(starts[after], counts)[without] + place[without] - 1]
    return parts, counts


@_wrapping
def block_keys(members: np.ndarray, bands: Bands) -> list[np.ndarray]:
    """The bucket keys of a set: one for each block, more for sparse blocks. Equal sets need no bucket."""
    out = []
    for tagged, words, sizes, values, starts in _blocks(members, bands):
        sparse = sizes < SPARSE
        out.append(tagged[~sparse])
        if sparse.any():
            parts, counts = _parts(np.flatnonzero(sparse), words, sizes, values, starts)
            out.append(mix(np.repeat(tagged[sparse], counts) + mix(parts + _GOLD)))
    return out


@_wrapping
def successors(members: np.ndarray, bands: Bands) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bucket keys of the blocks that are not sparse, and what the block after each may be: parts, so many for each key."""
    out = [(members[:0], members[:0], np.zeros(0, np.int64))]
    for tagged, words, sizes, values, starts in _blocks(members, bands):
        some = np.flatnonzero(sizes >= SPARSE)
        out.append((tagged[some], *_parts(some, words, sizes, values, starts)))
    return tuple(np.concatenate(x) for x in zip(*out))


def _texts(batches: Iterator[pa.RecordBatch]):
    for b in batches:
        yield b, b.column(b.schema.get_field_index("text"))


def _set_id(members: np.ndarray) -> tuple[int, int]:
    x = xxhash.xxh3_128_digest(members.tobytes())
    return int.from_bytes(x[:8], "little", signed=True), int.from_bytes(x[8:], "little", signed=True)


def set_ids(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_hash, n (set size), h1 and h2 (the set's id, 0 for the empty set), s0 .. s31 (a sketch of 2,048 bits)."""

    def run(batches):
        for b, texts in _texts(batches):
            n, ids, sketches = [], [], []
            for s in shingle_sets(texts, width):
                n.append(len(s))
                ids.append(_set_id(s) if len(s) else (0, 0))
                sketches.append(parity_sketch(s, SKETCH_WORDS))
            if n:
                h, k = np.array(ids, np.int64), np.array(sketches).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1]), *[pa.array(k[:, i]) for i in range(SKETCH_WORDS)]], ["doc_id", "text_hash", "n", "h1", "h2", *SKETCH])

    kinds = ", ".join(f"{c} long" for c in SKETCH)
    return docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(released(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_hash long, n long, h1 long, h2 long, {kinds}")


def block_rows(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(key, h1) for every block of every set; a task emits a set that it meets again only once while it remembers it."""

    def run(batches):
        bands, seen = Bands(num, den), set()
        keys, ids, sizes, held = [], [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.repeat(np.array(ids, np.int64), sizes))], ["key", "h1"])

        for _, texts in _texts(batches):
            for s in shingle_sets(texts, width):
                if not len(s):
                    continue
                h1, h2 = _set_id(s)
                if (h1, h2) in seen:
                    continue
                if len(seen) >= 50_000:
                    seen.clear()
                seen.add((h1, h2))
                found = block_keys(s, bands)
                if not found:
                    continue
                found = np.concatenate(found)
                keys.append(found)
                ids.append(h1)
                sizes.append(len(found))
                held += len(found)
                if held >= BATCH_ROWS:
                    yield out()
                    keys, ids, sizes, held = [], [], [], 0
        if held:
            yield out()

    return docs.mapInArrow(released(run), "key long, h1 long")


def shared_blocks(rows: DataFrame) -> DataFrame:
    """The distinct rows of keys that two sets or more have. Rows arrive sorted; only a batch and one row are held."""

    def run(batches):
        # a row is kept if its key equals that of the distinct row before or after it
        last_key, last_id, last_kept = None, None, True
        for b in batches:
            k, v = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(k):
                continue
            new = np.ones(len(k), bool)
            new[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
            new[0] = last_key is None or k[0] != last_key or v[0] != last_id
            k, v = k[new], v[new]
            if not len(k):
                continue
            keep = np.zeros(len(k), bool)
            same = k[1:] == k[:-1]
            keep[1:] |= same
            keep[:-1] |= same
            first = last_key is not None and k[0] == last_key
            keep[0] |= first
            head = ([last_key], [last_id]) if first and not last_kept else ([], [])
            last_key, last_id, last_kept = k[-1], v[-1], bool(keep[-1])
            ok, ov = np.concatenate([np.array(head[0], np.int64), k[keep]]), np.concatenate([np.array(head[1], np.int64), v[keep]])
            if len(ok):
                yield pa.RecordBatch.from_arrays([pa.array(ok), pa.array(ov)], ["key", "h1"])

    return rows.repartition("key").sortWithinPartitions("key", "h1").mapInArrow(released(run), "key long, h1 long")


def _filter_words(spark, values: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits over a column of hashes: constant size, built by a grouped bit_or."""
    slot = F.call_function("shiftrightunsigned", values[values.columns[0]], F.lit(64 - FILTER_BITS))
    words = values.select(slot.alias("slot")).groupBy(F.expr("slot div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(slot % 64)))").alias("bits")).toArrow()
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[words["word"].to_numpy()] = words["bits"].to_numpy()
    return bitmap


def _is_set(bitmap: np.ndarray, values: np.ndarray) -> np.ndarray:
    slots = (values.view(U) >> U(64 - FILTER_BITS)).astype(np.int64)
    return (bitmap[slots >> 6] >> (slots & 63)) & 1 > 0


def representatives(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int, rows, schema: str) -> DataFrame:
    """rows(h1, h2, set) for one document (or a few equal ones) of every class whose h1 is wanted; schema is that of rows.

    A bitmap of constant size keeps most other documents from being shingled; what it lets through by chance is left to
    the caller's joins by h1 and h2.
    """
    spark = docs.sparkSession
    bitmap = spark.sparkContext.broadcast(_filter_words(spark, classes.join(wanted, "h1", "left_semi").select("rep")))

    def run(batches):
        for b, texts in _texts(batches):
            hit = np.flatnonzero(_is_set(bitmap.value, b.column(0).to_numpy()))
            for at in range(0, len(hit), 500):
                found = [rows(*_set_id(s), s) for s in shingle_sets(texts.take(pa.array(hit[at : at + 500])), width) if len(s)]
                if found:
                    yield from pa.Table.from_batches(found).combine_chunks().to_batches()

    return docs.select(F.xxhash64("doc_id").alias("rep"), "text").mapInArrow(released(run), schema)


def member_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """h1, h2 and the set's members (packed) of every class whose h1 is wanted."""

    def row(h1, h2, s):
        return pa.RecordBatch.from_arrays([pa.array([h1], pa.int64()), pa.array([h2], pa.int64()), pa.array([s.tobytes()], pa.binary())], ["h1", "h2", "members"])

    found = representatives(docs, classes, wanted, width, row, "h1 long, h2 long, members binary")
    return found.join(wanted, "h1", "left_semi").dropDuplicates(["h1", "h2"])


def open_blocks(docs: DataFrame, classes: DataFrame, opened: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(key, h1, parts) of the blocks of opened rows that aren't sparse, and a few that a bitmap of constant size lets
    through by chance: most blocks of a set whose bucket is open are in none that is. parts: what the block after may be."""
    # both hashes are random bits, so that their exclusive or is one of the row
    bitmap = docs.sparkSession.sparkContext.broadcast(_filter_words(docs.sparkSession, opened.select(F.col("key").bitwiseXOR(F.col("h1")))))

    def row(h1, h2, s):
        keys, parts, counts = successors(s, Bands(num, den))
        keys = keys.view(np.int64)
        some = _is_set(bitmap.value, keys ^ np.int64(h1))
        lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(counts[some])]).astype(np.int32), pa.array(parts[np.repeat(some, counts)].view(np.int64)))
        return pa.RecordBatch.from_arrays([pa.array(keys[some]), pa.array(np.full(int(some.sum()), h1, np.int64)), lists], ["key", "h1", "parts"])

    return representatives(docs, classes, opened.select("h1").distinct(), width, row, "key long, h1 long, parts array<long>")


def finer_rows(docs: DataFrame, classes: DataFrame, opened: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(key, h1, label) in finer buckets, from rows (key, h1, label) in open ones: the key stands for two blocks, the old
    one and its successor, which two sets may have equal or one member apart. Sparse blocks' keys have their successor already."""
    blocks = open_blocks(docs, classes, opened, width, num, den)
    blocks = blocks.join(opened.select("key", "h1").distinct(), ["key", "h1"], "left_semi").distinct()
    parts = opened.join(blocks, ["key", "h1"], "left").withColumn("part", F.explode_outer("parts"))
    return parts.select(F.when(F.col("part").isNull(), F.col("key")).otherwise(F.xxhash64("key", "part")).alias("key"), "h1", "label").distinct()


def open_rows(rows: DataFrame) -> DataFrame:
    """The rows (key, h1, label) of keys that have two labels or more."""
    ends = rows.groupBy("key").agg(*[f(f"label.{c}").alias(f"{k}{c}") for c in ("h1", "h2") for f, k in ((F.min, "lo"), (F.max, "hi"))])
    return rows.join(ends.where("loh1 <> hih1 or loh2 <> hih2").select("key"), "key", "left_semi")


def own_sketch(members: np.ndarray) -> np.ndarray:
    """A parity sketch of four to eight bits a member; its size is a power of two, so that it folds to any smaller one."""
    return parity_sketch(members, 1 << max(0, len(members) // 16).bit_length())


def within_reach(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The (a, b) whose sketches in proportion to their sets allow a link. Where sets are long, the short sketches leave
    many pairs below the threshold, and a whole set weighs sixteen times its sketch."""

    def sketched(batches):
        for b in batches:
            found = [np.frombuffer(x.as_buffer(), U) for x in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) for x in found], pa.int64()), pa.array([own_sketch(x).tobytes() for x in found], pa.binary())], ["h1", "n", "bits"])

    def run(batches):
        for b in batches:
            keep = []
            for x, y, n in zip(b.column(2), b.column(3), b.column(4).to_pylist()):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                while len(x) != len(y):
                    if len(x) < len(y):
                        x, y = y, x
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                keep.append(int(np.bitwise_count(x ^ y).sum()) * (den + num) <= n * (den - num))
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    short = cut(sets.select("h1", "members").mapInArrow(released(sketched), "h1 long, n long, bits binary"), "sketches", batch=PAIRS)
    side = lambda c: short.select(F.col("h1").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "bits_a", "bits_b", (F.col("n_a") + F.col("n_b")).alias("n"))
    out = cut(both.mapInArrow(released(run), "a long, b long").distinct(), "reach")
    drop(short)
    return out


def verify(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) set ids -> a, a2, b, b2, linked, from the exact sets."""
    left = sets.select(F.col("h1").alias("a"), F.col("h2").alias("a2"), F.col("members").alias("sa"))
    right = sets.select(F.col("h1").alias("b"), F.col("h2").alias("b2"), F.col("members").alias("sb"))
    both = pairs.join(left, "a").join(right, "b").select("a", "a2", "b", "b2", "sa", "sb")

    def run(batches):
        for b in batches:
            inter, union = [], []
            for x, y in zip(b.column(4), b.column(5)):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                z = np.concatenate([x, y])
                z.sort()
                i = int((z[1:] == z[:-1]).sum())
                inter.append(i)
                union.append(len(z) - i)
            i, u = np.array(inter, np.int64), np.array(union, np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(den * i >= num * u)], ["a", "a2", "b", "b2", "linked"])

    return both.mapInArrow(released(run), "a long, a2 long, b long, b2 long, linked boolean")


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Least label of each node's component. nodes: h1, h2, label; edges: a, a2, b, b2. Labels travel along the links
    and along the labels' own nodes until nothing changes; every round is written to the shared folder. Two nodes may
    start with one label only if they are connected."""
    both = cut(edges.select("a", "a2", "b", "b2").union(edges.select("b", "b2", "a", "a2")).distinct(), "edges", release=False)
    labels = cut(nodes.join(both.select(F.col("a").alias("h1"), F.col("a2").alias("h2")).distinct(), ["h1", "h2"], "left_semi"), "labels", release=False)
    while True:
        come = both.join(labels, (both.a == labels.h1) & (both.a2 == labels.h2)).groupBy(F.col("b").alias("h1"), F.col("b2").alias("h2")).agg(F.min("label").alias("come"))
        new = labels.join(come, ["h1", "h2"], "left").select("h1", "h2", F.least("label", "come").alias("label"), F.col("label").alias("was"))
        # shortcut: the least label that any node with the same label has now
        jump = new.groupBy("was").agg(F.min("label").alias("jump"))
        new = new.join(jump, "was").select("h1", "h2", F.least("label", "jump").alias("label"), "was")
        last, new = labels, cut(new, "labels", release=False)
        drop(last)
        labels = new
        if new.where("label <> was").isEmpty():
            drop(both)
            return labels


def folded_sketches(classes: DataFrame, words: int = FOLDED) -> DataFrame:
    """h1, n, f0, f1 ...: the sketches folded to fewer words, which are parity sketches too."""
    fold = [reduce(lambda x, y: x.bitwiseXOR(y), [F.col(c) for c in SKETCH[i::words]]).alias(f"f{i}") for i in range(words)]
    return classes.select("h1", "n", *fold)


def by_sketch(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """pairs (a, b and any other columns) with candidate: sizes and Hamming distances allow a link.

    The folded sketches rule most pairs out; only what they leave is looked up in the whole sketches.
    """

    def looked_up(pairs, table, words):
        side = lambda name, p: table.select(F.col("h1").alias(name), F.col("n").alias(p + "n"), *[F.col(c).alias(p + c) for c in words])
        both = pairs.join(side("a", "x_"), "a").join(side("b", "y_"), "b")
        bits = sum((F.bit_count(F.col("x_" + c).bitwiseXOR(F.col("y_" + c))) for c in words), F.lit(0))
        sizes = den * F.least("x_n", "y_n") >= num * F.greatest("x_n", "y_n")
        return both.select(*pairs.columns, (sizes & (bits * (den + num) <= (F.col("x_n") + F.col("y_n")) * (den - num))).alias("candidate"))

    first = cut(looked_up(pairs, folded_sketches(classes), [f"f{i}" for i in range(FOLDED)]), "folded", release=False)
    second = looked_up(first.where("candidate").drop("candidate"), classes, SKETCH)
    return first.where("not candidate").unionByName(second)


def _from(nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """nodes with the labels that they have by now."""
    known = labels.select("h1", "h2", F.col("label").alias("known"))
    return nodes.join(known, ["h1", "h2"], "left").select("h1", "h2", F.least("label", "known").alias("label"))


def _linked(docs: DataFrame, classes: DataFrame, nodes: DataFrame, pairs: DataFrame, before: DataFrame | None, width: int, num: int, den: int) -> tuple[DataFrame, DataFrame]:
    """All links so far, with those among the pairs that their sets verify, and the components of all links."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("h1")).distinct()
    sets = cut(member_sets(docs, classes, wanted, width), "sets")
    links = verify(within_reach(pairs, sets, num, den), sets, num, den).where("linked").select("a", "a2", "b", "b2")
    if before is not None:
        links = links.union(before)
    links = cut(links, "links", batch=PAIRS)
    drop(sets)
    return links, components(nodes, links)


def ngram_jaccard_join(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """One row for each row of docs: doc_id, n_shingles, component_id, set_hash, component_hash, text_hash.

    Texts link when den * |intersection| >= num * |union| of their shingle sets; component_id is the smallest doc_id
    that links lead to, its own included. Null and wordless texts have the empty set and link with nothing; texts of
    fewer words than the width are one shingle; repeated rows each get a row; null ids sort last and stay null where a
    component has no other; other columns are ignored; an empty table gives an empty result. component_hash tells
    components apart also where ids are null or repeated: it is the least set_hash of a component's sets.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    ids = cut(set_ids(docs, width), "set-ids")
    classes = ids.where("n > 0").groupBy("h1", "h2").agg(F.min(F.xxhash64("doc_id")).alias("rep"), F.min("doc_id").alias("least_id"), F.min("n").alias("n"), *[F.min(c).alias(c) for c in SKETCH])
    classes = cut(classes, "classes")
    shared = cut(shared_blocks(block_rows(docs, width, num, den)), "shared")

    # the member that shares the most buckets is the pivot of its buckets: the original, where copies were edited
    weight = shared.groupBy("h1").agg(F.count("*").alias("weight"))
    member = cut(shared.join(weight, "h1"), "weighted")
    drop(shared)
    pivot = member.groupBy("key").agg(F.max(F.struct("weight", "h1")).alias("top"), F.count("*").alias("company")).select("key", F.col("top.h1").alias("pivot"), "company")
    placed = cut(member.join(pivot, "key").where("h1 <> pivot").select("key", "h1", "pivot", "company"), "placed")
    drop(member)
    company = placed.groupBy(F.col("h1").alias("a"), F.col("pivot").alias("b")).agg(F.count("*").alias("shared"))
    near = cut(by_sketch(company, classes, num, den).where("candidate").select("a", "b", "shared"), "near")
    # document ids may be null or repeated, so a class is labelled by its own set id
    nodes = classes.select("h1", "h2", F.struct("h1", "h2").alias("label"))
    # first every member with the pivot that it shares the most with, then the pairs that this has not connected
    best = near.groupBy("a").agg(F.max(F.struct("shared", "b")).alias("top")).select("a", F.col("top.b").alias("b"))
    checked, labels = _linked(docs, classes, nodes, cut(best, "best", release=False), None, width, num, den)
    ends = nodes.select("h1", F.col("label").alias("own")).join(labels.select("h1", "label"), "h1", "left").select("h1", F.coalesce("label", "own").alias("label"))
    side = lambda c: ends.select(F.col("h1").alias(c), F.col("label").alias(f"label_{c}"))
    apart = cut(near.select("a", "b").distinct().join(side("a"), "a").join(side("b"), "b").where("label_a <> label_b").select("a", "b"), "apart")
    if not apart.isEmpty():
        checked, labels = _linked(docs, classes, _from(nodes, labels), apart, checked, width, num, den)
    drop(apart)

    # what is left: pairs in buckets of three and more that are in different components and without their pivot
    at = placed.where("company > 2").select("key", "h1").union(placed.where("company > 2").select("key", F.col("pivot").alias("h1")).distinct())
    at = at.join(nodes.select("h1", F.col("label").alias("own")), "h1").join(labels.select("h1", "label"), "h1", "left").select("key", "h1", F.coalesce("label", "own").alias("label"))
    opened = cut(open_rows(at), "open")
    finer = cut(finer_rows(docs, classes, opened, width, num, den), "finer")
    drop(opened)
    folded = [f"f{i}" for i in range(FINER)]
    finest = cut(open_rows(finer).join(folded_sketches(classes, FINER), "h1"), "finest")
    drop(finer)
    x, y = finest.alias("x"), finest.alias("y")
    bits = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in folded), F.lit(0))
    within = (den * F.least("x.n", "y.n") >= num * F.greatest("x.n", "y.n")) & (bits * (den + num) <= (F.col("x.n") + F.col("y.n")) * (den - num))
    more = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.label") < F.col("y.label")) & within)
    more = more.select(F.least("x.h1", "y.h1").alias("a"), F.greatest("x.h1", "y.h1").alias("b")).distinct()
    more = cut(by_sketch(more, classes, num, den).where("candidate").select("a", "b"), "more")
    drop(finest)
    if not more.isEmpty():  # whole components move on from the labels that they have
        checked, labels = _linked(docs, classes, _from(nodes, labels), more, checked, width, num, den)
    drop(placed, near, checked, more)
    least = labels.join(classes.select("h1", "h2", "least_id"), ["h1", "h2"]).groupBy("label").agg(F.min("least_id").alias("linked_id"))
    final = labels.join(least, "label").select("h1", "h2", "label", "linked_id")
    out = ids.join(classes.select("h1", "h2", "least_id"), ["h1", "h2"], "left").join(final, ["h1", "h2"], "left")
    written = lambda a, b: F.concat_ws("", F.lpad(F.hex(a), 16, "0"), F.lpad(F.hex(b), 16, "0"))
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.when(F.col("label").isNull(), F.col("least_id")).otherwise(F.col("linked_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), written("h1", "h2").alias("set_hash"), written(F.coalesce("label.h1", "h1"), F.coalesce("label.h2", "h2")).alias("component_hash"), "text_hash")


def keep_one_of_each(docs: DataFrame, width: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """docs with one row of each component: the one whose doc_id is the least. Rows without words all stay.

    Only what goes is joined with the documents, by id and a hash of the text, so that a repeated id takes nothing else
    with it. Of rows of one component that share the least id (or have none) one stays. All columns stay, whatever their
    names.
    """
    found = cut(ngram_jaccard_join(docs, width, num, den), "components")
    own, other = fresh(docs, "id"), fresh(docs, "hash")
    marks = lambda rows: rows.select(F.col("doc_id").alias(own), F.col("text_hash").alias(other)).distinct()
    same = lambda d: d["doc_id"].eqNullSafe(F.col(own)) & (F.xxhash64(d["text"].cast("string")) == F.col(other))
    gone = marks(found.where("n_shingles > 0 and not doc_id <=> component_id"))
    kept = docs.join(gone.hint("shuffle_hash"), same(docs), "left_anti")
    stay = found.where("n_shingles > 0 and doc_id <=> component_id")
    if stay.groupBy("component_hash").count().where("count > 1").isEmpty():
        return kept
    first = stay.groupBy("component_hash").agg(F.min(F.struct("set_hash", "text_hash")).alias("first"))
    kept = kept.join(marks(stay.join(first, "component_hash").where("struct(set_hash, text_hash) <> first")), same(kept), "left_anti")
    wordless = marks(found.where("n_shingles = 0"))
    return kept.join(wordless, same(kept), "left_anti").dropDuplicates(["doc_id", "text"]).unionByName(docs.join(wordless, same(docs), "left_semi"))
