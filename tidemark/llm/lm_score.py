"""Language-model scoring by context-tree weighting.

A text is coded word by word: each word's bytes and a closing space, then an end symbol. The model predicts every byte
bit by bit. A context is the DEPTH bytes before it, reaching back to the word's start (where it is filled with spaces);
in each context of each depth there is a binary tree over the byte's bits, and each of its nodes has the counts of zeros
and ones seen in training. A node's weighted probability is half its own Krichevsky-Trofimov estimate and half the
product of its children's, the same node one byte deeper in the past; so a prediction mixes all depths with weights that
the training data chose.

With across_words a context is the DEPTH bytes before a byte in the whole text, whatever words they belong to, and only
the text's start is filled with spaces: (context, byte) is counted over whole texts, and a text's value is the sum over
its bytes, looked up in a table of the most frequent ones, of bounded size; only the others are joined. Words then serve
the base only.

Without it contexts stop at a word's start, and a word costs the same wherever it stands. The corpus is therefore gathered
as counts of distinct words, grown with the input, and everything else is computed once for each distinct word:

1. word counts, combined in each task before they are shuffled;
2. counts of (context, byte) from the distinct words;
3. the tree, dealt out by the last two context bytes; depths 0 and 1 have at most 256 and 65,536 nodes and are shared;
4. the log probability of every (context, byte) and from them of every word, in an equi-join;
5. texts look up their words: a table of the most frequent ones, of bounded size, is broadcast; the others are joined.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, released

DEPTH = 5
#: The most words whose values are broadcast to all tasks, and (context, byte) values that are; both are fixed sizes.
FREQUENT = 262_144
GRAM_LIMIT = 4_000_000
ALPHA = 0.1
END = 0x0A
#: Rows held before a task sends its counts on.
HELD = 400_000


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 10 == 0


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def words_of_column(texts: pa.Array) -> list[list[bytes]]:
    return [(t or b"").lower().split() for t in texts.cast(pa.large_binary()).to_pylist()]


def word_counts(docs: DataFrame) -> DataFrame:
    """word, c (count in training texts; 0 for words of held-out texts only), and the row of the end symbol."""

    def run(batches):
        train, other = Counter(), set()

        def out():
            words = [*train, *(w for w in other if w not in train)]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array([train[w] if w in train else 0 for w in words], pa.int64())], ["word", "c"])

        for b in batches:
            for d, words in zip(b.column(0).to_pylist(), words_of_column(b.column(1))):
                if held_out(d):
                    other.update(words)
                    other.add(b"\n")
                else:
                    train.update(words)
                    train[b"\n"] += 1
                if len(train) + len(other) > HELD:
                    yield out()
                    train, other = Counter(), set()
        if train or other:
            yield out()

    return docs.mapInArrow(released(run), "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def grams_of(word: bytes) -> list[int]:
    """The (context, byte) keys of a word: DEPTH context bytes, the oldest first, then the byte. The end symbol is a
    byte of its own at a word's start."""
    padded = b" " * DEPTH + (word + b" " if word != b"\n" else word)
    return [int.from_bytes(padded[i : i + DEPTH + 1], "big") for i in range(len(padded) - DEPTH)]


def gram_counts(words: DataFrame) -> DataFrame:
    """gram, c over training, from distinct words and their counts; grams of held-out words come with 0."""

    def run(batches):
        for b in batches:
            keys, weights = [], []
            for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                g = grams_of(w)
                keys += g
                weights += [c] * len(g)
            if keys:
                u, inverse = np.unique(np.array(keys, np.int64), return_inverse=True)
                yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(np.bincount(inverse, np.array(weights, np.float64)).astype(np.int64))], ["gram", "c"])

    return words.select("word", "c").mapInArrow(run, "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


#: Bytes of texts whose (context, byte) keys are made at once (a longer text by itself), and the most texts, in bits.
CODED = 1 << 21
TEXT_BITS = 15
#: Texts that are scored at once, beside the broadcast tables.
TEXTS = 500
#: Above all keys; ends a table in which some may be missing.
BEYOND = (1 << 63) - 1


def text_grams(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The (context, byte) keys of whole texts, given as their words, one text after another, and how many each has.
    Each word is closed by a space, the text by the end symbol; contexts reach back over words to the text's start."""
    coded = [b" " * DEPTH + b" ".join(words) + (b" \n" if words else b"\n") for words in texts]
    sizes = np.array([len(c) - DEPTH for c in coded], np.int64)
    data = b"".join(coded) + b"\0" * (7 - DEPTH)
    # the eight bytes from each place on, as one number; the spaces before a text are not coded
    keys = (np.ndarray(len(data) - 7, ">u8", data, strides=(1,)).astype(np.uint64) >> np.uint64(8 * (7 - DEPTH))).view(np.int64)
    ends = np.cumsum(sizes + DEPTH) - DEPTH
    return np.concatenate([keys[e - n : e] for e, n in zip(ends.tolist(), sizes.tolist())]), sizes


def _parts_of(texts: list[list[bytes]]):
    """(first, last) of runs of texts that together have some CODED bytes; not too many texts."""
    first = size = 0
    for i, words in enumerate(texts):
        size += sum(map(len, words)) + len(words)
        if size >= CODED or i + 1 - first == 1 << TEXT_BITS:
            yield first, i + 1
            first, size = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def text_gram_counts(docs: DataFrame) -> DataFrame:
    """gram, c over whole training texts; grams of held-out texts come with 0."""

    def run(batches):
        keys, counts, held_rows = [], [], 0
        for b in batches:
            ids, texts = b.column(0).to_pylist(), words_of_column(b.column(1))
            for lo, hi in _parts_of(texts):
                held = np.array([held_out(d) for d in ids[lo:hi]])
                grams, sizes = text_grams(texts[lo:hi])
                weighed = np.repeat(~held, sizes)
                for g, weight in ((grams[weighed], 1), (grams[~weighed], 0)):
                    u, c = np.unique(g, return_counts=True)
                    keys.append(u)
                    counts.append(c * weight)
                    held_rows += len(u)
                if held_rows > 4 * HELD:
                    keys, counts = [[x] for x in _summed(np.concatenate(keys), np.concatenate(counts))]
                    held_rows = len(keys[0])
                    if held_rows > 2 * HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(keys[0]), pa.array(counts[0])], ["gram", "c"])
                        keys, counts, held_rows = [], [], 0
        if held_rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _summed(np.concatenate(keys), np.concatenate(counts))], ["gram", "c"])

    return docs.mapInArrow(released(run), "gram long, c long").groupBy("gram").agg(F.sum("c").alias("c"))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts[order], first)


def text_values(keys: np.ndarray, sizes: np.ndarray, table: tuple[np.ndarray, np.ndarray], missed: list | None = None) -> np.ndarray:
    """The sum of each text's values, from the keys of a few texts; table has sorted keys and their values. Keys are sorted
    first, each with its text's number below it, so that each is looked up once and in order. Keys that the table, which
    then ends with BEYOND, doesn't have add nothing; missed gets them: the texts' numbers, the keys, and how often."""
    placed = keys << TEXT_BITS
    placed |= np.repeat(np.arange(len(sizes)), sizes)
    placed.sort()
    keys = placed >> TEXT_BITS
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    at = np.searchsorted(table[0], keys[first])
    found, far, times = table[1][at], table[0][at] != keys[first], np.diff(np.append(first, len(keys)))
    if missed is not None and far.any():
        found = np.where(far, 0.0, found)
        rest, m = np.unique(placed[np.repeat(far, times)], return_counts=True)
        missed.append((rest & (1 << TEXT_BITS) - 1, rest >> TEXT_BITS, m))
    return np.bincount(placed & (1 << TEXT_BITS) - 1, np.repeat(found, times), len(sizes))


_gamma = np.frompyfunc(math.lgamma, 1, 1)


def log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov block probability."""
    total = _gamma(zeros + 0.5) + _gamma(ones + 0.5) - _gamma(zeros + ones + 1.0)
    return total.astype(np.float64) - math.log(math.pi)


def bit_nodes(byte: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each byte and level: the node of its binary tree (1 to 255) and the bit taken there."""
    levels = np.arange(8)
    nodes = (1 << levels)[None, :] | (byte[:, None].astype(np.int64) >> (8 - levels)[None, :])
    return nodes, (byte[:, None].astype(np.int64) >> (7 - levels)[None, :]) & 1


class Level:
    """The nodes of one depth: sorted keys, zeros, ones, log weighted probability, and later the weight of its own estimate."""

    def __init__(self, context: np.ndarray, byte: np.ndarray, counts: np.ndarray):
        nodes, bits = bit_nodes(byte)
        key = (context[:, None].astype(np.int64) << 8 | nodes).ravel()
        self.keys, inverse = np.unique(key, return_inverse=True)
        weight = np.repeat(counts.astype(np.float64), 8)
        self.ones = np.bincount(inverse, weight * bits.ravel(), len(self.keys))
        self.zeros = np.bincount(inverse, weight * (1 - bits.ravel()), len(self.keys))
        self.own = log_kt(self.zeros, self.ones)
        self.mixed = self.own.copy()
        self.weight = np.ones(len(self.keys))

    def weigh(self, children: np.ndarray) -> None:
        """children: log product of the children's weighted probabilities."""
        self.mixed = np.logaddexp(self.own, children) - math.log(2)
        self.weight = np.exp(self.own - math.log(2) - self.mixed)

    def at(self, context: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.keys, (context[:, None].astype(np.int64) << 8 | nodes))

    def predict(self, at: np.ndarray, bits: np.ndarray) -> np.ndarray:
        own = np.where(bits == 1, self.ones[at], self.zeros[at])
        return (own + 0.5) / (self.zeros[at] + self.ones[at] + 1.0)


def _parents(child: Level, depth: int, parent: Level) -> np.ndarray:
    """The log product of the children of each node of parent."""
    context, node = child.keys >> 8, child.keys & 255
    up = (context & ((1 << 8 * depth) - 1)) << 8 | node
    return np.bincount(np.searchsorted(parent.keys, up), child.mixed, len(parent.keys))


def deep_part(gram: np.ndarray, counts: np.ndarray) -> tuple[list[Level], np.ndarray]:
    """Levels 2 to DEPTH over grams that share their last two context bytes, weighed from the deepest up."""
    byte, context = gram & 255, gram >> 8
    levels = [Level(context & ((1 << 8 * d) - 1), byte, counts) for d in range(2, DEPTH + 1)]
    for i in range(len(levels) - 2, -1, -1):
        levels[i].weigh(_parents(levels[i + 1], i + 2, levels[i]))
    return levels, byte


def gram_scores(grams: DataFrame) -> DataFrame:
    """gram, log10 probability of the byte in its context, and c, for every gram (those of held-out words too)."""
    spark = grams.sparkSession
    pair = F.expr("shiftright(gram, 8) & 65535")

    def tops(pdf: pd.DataFrame) -> pd.DataFrame:
        levels, _ = deep_part(pdf["gram"].to_numpy(), pdf["c"].to_numpy())
        top = levels[0]
        return pd.DataFrame({"key": top.keys, "mixed": top.mixed, "zeros": top.zeros, "ones": top.ones})

    keyed = grams.withColumn("pair", pair)
    # at most 65,536 contexts of two bytes with 255 nodes each; summed to those of one byte and of none before they are
    # collected: 65,536 rows at most
    two = keyed.groupBy("pair").applyInPandas(tops, "key long, mixed double, zeros double, ones double")
    one = two.groupBy(F.expr("(shiftright(key, 8) & 255) * 256 + (key & 255)").alias("key")).agg(F.sum("mixed").alias("below"), F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones")).toPandas().sort_values("key")
    first = Level(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    first.keys, first.zeros, first.ones = one["key"].to_numpy(np.int64), one["zeros"].to_numpy(), one["ones"].to_numpy()
    first.own = log_kt(first.zeros, first.ones)
    first.weigh(one["below"].to_numpy())
    root = Level(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    root.keys, inverse = np.unique(first.keys & 255, return_inverse=True)
    root.zeros, root.ones = np.bincount(inverse, first.zeros, len(root.keys)), np.bincount(inverse, first.ones, len(root.keys))
    root.own = log_kt(root.zeros, root.ones)
    root.weigh(np.bincount(inverse, first.mixed, len(root.keys)))
    shared = spark.sparkContext.broadcast((root, first))

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        gram = pdf["gram"].to_numpy()
        deep, byte = deep_part(gram, pdf["c"].to_numpy())
        nodes, bits = bit_nodes(byte)
        context = gram >> 8
        p = None
        for d in range(DEPTH, -1, -1):
            level = deep[d - 2] if d >= 2 else shared.value[d]
            at = level.at(context & ((1 << 8 * d) - 1), nodes)
            own = level.predict(at, bits)
            p = own if p is None else level.weight[at] * own + (1 - level.weight[at]) * p
        return pd.DataFrame({"gram": gram, "value": np.log10(p).sum(axis=1), "c": pdf["c"]})

    return keyed.groupBy("pair").applyInPandas(score, "gram long, value double, c long")


def base_score(total: int, distinct: int):
    return F.log10((F.col("c") + ALPHA) / F.lit(total + ALPHA * (distinct + 1)))


def word_scores(words: DataFrame, scores: DataFrame, total: int, distinct: int) -> DataFrame:
    """word, c, base, value: the log10 probabilities of a word under the base and under the model.

    (context, byte) values are broadcast where their number, counted here, is within GRAM_LIMIT; else words are joined
    with them.
    """
    base = base_score(total, distinct)
    if scores.count() > GRAM_LIMIT:
        keys = F.udf(lambda w: grams_of(bytes(w)), "array<long>")
        rows = words.select("word", "c", F.explode(keys("word")).alias("gram")).join(scores, "gram")
        return rows.groupBy("word").agg(F.first("c").alias("c"), F.sum("value").alias("value")).select("word", "c", base.alias("base"), "value")
    table = scores.toArrow().sort_by("gram")
    shared = words.sparkSession.sparkContext.broadcast((table["gram"].to_numpy(), table["value"].to_numpy()))

    def run(batches):
        keys, values = shared.value
        for b in batches:
            found = [grams_of(w) for w in b.column(0).to_pylist()]
            if found:
                sizes = np.array([len(g) for g in found])
                at = np.searchsorted(keys, np.array([g for x in found for g in x], np.int64))
                value = np.add.reduceat(values[at], np.concatenate([[0], np.cumsum(sizes)[:-1]]))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(value)], ["word", "c", "value"])

    return words.select("word", "c").mapInArrow(run, "word binary, c long, value double").select("word", "c", base.alias("base"), "value")


def score_texts(docs: DataFrame, across_words: bool = False) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte for each row of docs.

    across_words: contexts are of the whole text, not of a word.

    Null texts are empty: their one token is the end. A null id is the text "None". Repeated rows each get a row and each
    count in training. With no training text the base is uniform and every estimate is one half. An empty table gives
    an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    words = cut(word_counts(docs), "words")
    sums = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.when(F.col("c") > 0, 1)).alias("v")).first()
    grams = cut(text_gram_counts(docs) if across_words else gram_counts(words), "grams")
    scores = cut(gram_scores(grams), "gram-scores")
    if across_words:
        known = words.select("word", "c", base_score(sums.n, sums.v).alias("base"), F.lit(0.0).alias("value"))
    else:
        known = cut(word_scores(words, scores.select("gram", "value"), sums.n, sums.v), "word-scores")
    shared, far = None, None
    if across_words:
        least = least_frequent(scores, GRAM_LIMIT)
        values = scores.where(F.lit(False) if least is None else F.col("c") >= least).select("gram", "value").toArrow().sort_by("gram")
        if len(values) < scores.count():
            far = scores.where(F.lit(True) if least is None else F.col("c") < least).select("gram", F.col("value").alias("g_value"))
        shared = spark.sparkContext.broadcast((np.append(values["gram"].to_numpy(), BEYOND), np.append(values["value"].to_numpy(), 0.0)))
        del values
    least = least_frequent(words)
    top = known.where(F.lit(False) if least is None else F.col("c") >= least).toArrow()
    by_word = lambda c: dict(zip(top["word"].to_pylist(), top[c].to_pylist()))
    frequent = spark.sparkContext.broadcast((by_word("base"), None if across_words else by_word("value")))
    unknown = math.log10(ALPHA / (sums.n + ALPHA * (sums.v + 1)))

    def run(batches):
        from pyspark import TaskContext

        row, (bases, values) = (TaskContext.get().partitionId() << 40) + 1, frequent.value
        for b in batches:
            ids, texts = b.column(0), words_of_column(b.column(1))
            of_text = np.zeros(len(texts))
            for lo, hi in _parts_of(texts) if across_words else ():
                missed = []
                of_text[lo:hi] = text_values(*text_grams(texts[lo:hi]), shared.value, missed)
                for i, grams, m in missed:
                    yield _rows(len(grams), id_type, row=row + lo + i, m=m, gram=grams)
            for words in texts:
                words.append(b"\n")
            size = np.array([len(words) for words in texts], np.int64)
            of, every = np.repeat(np.arange(len(texts)), size), list(chain.from_iterable(texts))
            base = np.fromiter(map(bases.get, every, repeat(math.nan)), np.float64, len(every))
            rare = np.isnan(base)
            summed = lambda x: np.bincount(of, np.where(rare, 0.0, x), len(texts))
            if values is not None:
                of_text += summed(np.fromiter(map(values.get, every, repeat(math.nan)), np.float64, len(every)))
            # the base is above that of unknown words where a word is known; half the step to a count of one is rounding's
            n_known = summed(base > unknown + math.log10((1 + ALPHA) / ALPHA) / 2).astype(np.int64)
            n_bytes = np.bincount(of, np.fromiter(map(len, every), np.int64, len(every)) + 1, len(texts)).astype(np.int64) - 1
            held = np.array([held_out(d) for d in ids.to_pylist()], bool)
            if len(texts):
                yield _rows(len(texts), id_type, row=np.arange(row, row + len(texts)), doc_id=ids, held_out=held, n_tokens=size, n_known=n_known, base=summed(base), value=of_text, n_bytes=n_bytes)
            at = np.flatnonzero(rare)
            counted = Counter(zip((of[at] + row).tolist(), [every[i] for i in at.tolist()]))
            if counted:
                rows, words = zip(*counted)
                yield _rows(len(rows), id_type, row=rows, word=words, m=list(counted.values()))
            row += len(texts)

    parts = cut(docs.mapInArrow(released(run), f"row long, doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, base double, value double, n_bytes long, word binary, m long, gram long"), "parts", batch=TEXTS)
    rare = parts.where("word is not null").select("row", "word", "m").join(known, "word")
    rare = rare.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("r_known"), F.sum(F.col("m") * F.col("base")).alias("r_base"), F.sum(F.col("m") * F.col("value")).alias("r_value"))
    out = parts.where("word is null and gram is null").join(rare, "row", "left")
    score = F.col("value") + F.coalesce("r_value", F.lit(0.0))
    if far is not None:
        far = parts.where("gram is not null").select("row", "gram", "m").join(far, "gram")
        out = out.join(far.groupBy("row").agg(F.sum(F.col("m") * F.col("g_value")).alias("g_value")), "row", "left")
        score = score + F.coalesce("g_value", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("r_known", F.lit(0))).alias("n_known"), F.lit(sums.n).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("r_base", F.lit(0.0))).alias("base_score"), score.alias("score"), (-score * math.log2(10) / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"),
    )


def least_frequent(counted: DataFrame, limit: int | None = None) -> int | None:
    """The least count c of the most frequent rows, so that limit rows (FREQUENT words) at most have it; None if the first
    are too many. Counts are binned by their logarithm, which makes some hundred bins."""
    bins = counted.groupBy(F.floor(F.log2(F.col("c") + 1) * 16).alias("bin")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    least, n = None, 0
    for b in sorted(bins, key=lambda b: -b.bin):
        n += b.n
        if n > (FREQUENT if limit is None else limit):
            break
        least = b.least
    return least


def _rows(n: int, id_type, **columns) -> pa.RecordBatch:
    """n rows with these columns; the others are null."""
    kinds = {"row": pa.int64(), "doc_id": id_type, "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(), "base": pa.float64(), "value": pa.float64(), "n_bytes": pa.int64(), "word": pa.binary(), "m": pa.int64(), "gram": pa.int64()}
    arrays = [pa.nulls(n, kind) if (c := columns.get(name)) is None else c if isinstance(c, pa.Array) else pa.array(c, kind) for name, kind in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, list(kinds))
