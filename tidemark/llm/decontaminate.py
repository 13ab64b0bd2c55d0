"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document. A row is a shard of whole documents: their lengths, and for every term the sorted
list of its positions in the shard's token stream. Two documents of a shard are a gap apart, so that no phrase spans
both. A phrase is found by intersecting its terms' lists, each shifted back by the term's offset in the phrase, from the
rarest list on; a phrase whose rarest term is not in the shard costs one comparison. Proximity matches start from the
lists of the phrase's rarest terms and look for a span, the phrase's length and some slack, that holds its words in any
order; of every SPARE words of the phrase one may be missing.

The test set is read in blocks of bounded size; every block is searched in all shards.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut, fresh

#: Bytes of text in a shard (a longer document is a shard of its own), and of test items in a block.
SHARD_BYTES = 2_000_000
BLOCK_BYTES = 4_000_000
#: Words between two documents of a shard; more where a phrase and its slack are longer.
GAP = 64
#: Words that a proximity match of a whole window may have between its own (in proportion for shorter items), and one in
#: so many of its words that it may lack.
NEAR_SLACK = 3
SPARE = 8

#: Words are runs of anything but ASCII signs and controls; A-Z count as a-z.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


INDEX_SCHEMA = "shard string, doc_ids array<{id}>, lengths array<int>, terms array<binary>, ends array<int>, positions binary"


def gap_of(width: int, slack: int) -> int:
    return max(GAP, width + max(slack, 0))


def build_index(docs: DataFrame, terms: frozenset[bytes] | None = None, gap: int = GAP) -> DataFrame:
    """Shards of postings for docs(doc_id, text). With terms, only those terms' postings are stored (lengths count all words)."""
    kind = docs.schema["doc_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    id_type = to_arrow_type(kind)
    chosen = docs.sparkSession.sparkContext.broadcast(None if terms is None else {t: i for i, t in enumerate(sorted(terms))})

    def run(batches: Iterator[pa.RecordBatch]):
        known = chosen.value
        names = sorted(known) if known is not None else None
        ids, lengths, codes, own, size, serial = [], [], [], {}, 0, 0
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()

        def shard():
            starts = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64) + gap)])
            code = np.concatenate(codes) if codes else np.empty(0, np.int64)
            where = np.concatenate([np.arange(n) + s for n, s in zip(lengths, starts)]) if lengths else np.empty(0, np.int64)
            have = code >= 0
            code, where = code[have], where[have]
            order = np.argsort(code, kind="stable")
            code, where = code[order], where[order].astype(np.int32)
            used, first = np.unique(code, return_index=True)
            ends = np.append(first[1:], len(code))
            table = names if names is not None else list(own)
            return pa.RecordBatch.from_arrays([
                pa.array([f"{task}-{serial}"]), pa.array([ids], pa.list_(id_type)), pa.array([lengths], pa.list_(pa.int32())),
                pa.array([[table[i] for i in used]], pa.list_(pa.binary())), pa.array([ends.tolist()], pa.list_(pa.int32())), pa.array([where.tobytes()], pa.binary()),
            ], ["shard", "doc_ids", "lengths", "terms", "ends", "positions"])

        for b in batches:
            for d, t in zip(b.column(0), b.column(1)):
                words = words_of(t.as_py())
                if known is not None:
                    get = known.get
                    code = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
                else:
                    code = np.fromiter((own.setdefault(w, len(own)) for w in words), np.int64, len(words))
                ids.append(d.as_py())
                lengths.append(len(words))
                codes.append(code)
                size += 8 * len(words) + 100
                if size >= SHARD_BYTES:
                    yield shard()
                    ids, lengths, codes, own, size, serial = [], [], [], {}, 0, serial + 1
        if ids:
            yield shard()

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, INDEX_SCHEMA.format(id=kind.simpleString()))


class Windows:
    """The phrases of a block of test items: runs of width words; an item with fewer words is one phrase."""

    def __init__(self, items: list[tuple[object, str | None]], width: int):
        self.terms: dict[bytes, int] = {}
        phrases: dict[tuple[int, ...], set] = {}
        for item, text in items:
            code = [self.terms.setdefault(w, len(self.terms)) for w in words_of(text)]
            for at in range(max(1, len(code) - width + 1) if code else 0):
                phrases.setdefault(tuple(code[at : at + width]), set()).add(item)
        self.phrases = list(phrases)
        self.items = [sorted(phrases[p], key=str) for p in self.phrases]
        longest = max(map(len, self.phrases), default=1)
        # shorter phrases are padded with their own first term, which changes no minimum
        self.padded = np.array([p + (p[0],) * (longest - len(p)) for p in self.phrases], np.int64).reshape(len(self.phrases), longest)
        # where each of a phrase's terms stands first, and how many of its words a proximity match may lack
        self.leading = np.array([[t not in p[:k] for k, t in enumerate(p)] + [False] * (longest - len(p)) for p in self.phrases], bool).reshape(self.padded.shape)
        self.spare = np.array([len(p) // SPARE for p in self.phrases], np.int64)


def _lists(row: dict, terms: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each term's list in the shard's positions."""
    first, last = np.zeros(len(terms) + 1, np.int64), np.zeros(len(terms) + 1, np.int64)
    begin = 0
    for t, end in zip(row["terms"], row["ends"]):
        if (i := terms.get(t)) is not None:
            first[i], last[i] = begin, end
        begin = end
    return first, last, np.frombuffer(row["positions"], np.int32)


def phrase_starts(phrase: tuple[int, ...], first, last, positions) -> np.ndarray:
    """Where the phrase occurs: shifted lists intersected from the rarest term on."""
    order = sorted(range(len(phrase)), key=lambda k: last[phrase[k]] - first[phrase[k]])
    found = None
    for k in order:
        own = positions[first[phrase[k]] : last[phrase[k]]] - k
        if found is None:
            found = own
        else:
            at = np.searchsorted(own, found)
            at[at == len(own)] = 0
            found = found[own[at] == found] if len(own) else found[:0]
        if not len(found):
            break
    return found


def near_starts(phrase: tuple[int, ...], first, last, positions, span: int) -> np.ndarray:
    """Occurrences of one of the phrase's rarest terms that may be in a proximity match: all but the spare terms stand
    less than span words away. A match has at least one of the spare + 1 rarest terms."""
    terms, spare, out = sorted(set(phrase), key=lambda t: last[t] - first[t]), len(phrase) // SPARE, []
    for rare in terms[: spare + 1]:
        found = positions[first[rare] : last[rare]]
        missed = np.zeros(len(found), np.int64)
        for t in terms:
            if not len(found):
                break
            own = positions[first[t] : last[t]]
            if t != rare and len(own):
                lo = np.searchsorted(own, found - (span - 1))
                missed = missed + ((lo == len(own)) | (own[np.minimum(lo, len(own) - 1)] > found + (span - 1)))
            elif t != rare:
                missed = missed + 1
            found, missed = found[missed <= spare], missed[missed <= spare]
        out.append(found)
    return np.concatenate(out)


def is_near(phrase: tuple[int, ...], first, last, positions, span: int, at: int) -> bool:
    """Whether some span around a place holds the phrase's words, each as often as the phrase, but for the spare ones."""
    need = Counter(phrase)
    around = []
    for t in need:
        own = positions[first[t] : last[t]]
        around += [(int(x), t) for x in own[np.searchsorted(own, at - span + 1) : np.searchsorted(own, at + span)]]
    around.sort()
    have, lo, held = Counter(), 0, 0
    for x, t in around:
        have[t] += 1
        held += have[t] <= need[t]
        while around[lo][0] <= x - span:
            t = around[lo][1]
            held -= have[t] <= need[t]
            have[t] -= 1
            lo += 1
        if held >= len(phrase) - len(phrase) // SPARE:
            return True
    return False


def search(index: DataFrame, items: list[tuple[object, str | None]], width: int, slack: int = -1, gap: int = GAP) -> DataFrame:
    """For every indexed document: shard, ordinal, doc_id, n_words, spans (start, end of hit words), items.

    slack < 0: exact phrases only; else near holds the items with a proximity match, exact ones among them. gap is the
    index's and at least gap_of(width, slack).
    """
    windows = index.sparkSession.sparkContext.broadcast(Windows(items, width))
    id_type = index.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]):
        w: Windows = windows.value
        for b in batches:
            for row in b.to_pylist():
                first, last, positions = _lists(row, w.terms)
                lengths = np.array(row["lengths"], np.int64)
                starts = np.concatenate([[0], np.cumsum(lengths + gap)])[: len(lengths)]
                hits: list[list] = [[] for _ in row["doc_ids"]]
                items_hit: list[set] = [set() for _ in row["doc_ids"]]
                near_hit: list[set] = [set() for _ in row["doc_ids"]]
                counts = last - first
                for p in np.flatnonzero(counts[w.padded].min(axis=1)) if len(w.phrases) else ():
                    phrase = w.phrases[p]
                    for s in phrase_starts(phrase, first, last, positions):
                        d = int(np.searchsorted(starts, s, "right")) - 1
                        hits[d].append((int(s - starts[d]), int(s - starts[d]) + len(phrase)))
                        items_hit[d].update(w.items[p])
                        if slack >= 0:
                            near_hit[d].update(w.items[p])
                absent = ((counts[w.padded] == 0) & w.leading).sum(axis=1) if slack >= 0 and len(w.phrases) else None
                for p in np.flatnonzero(absent <= w.spare) if absent is not None else ():
                    phrase = w.phrases[p]
                    span = len(phrase) + slack * len(phrase) // width
                    for s in near_starts(phrase, first, last, positions, span):
                        d = int(np.searchsorted(starts, s, "right")) - 1
                        if not near_hit[d].issuperset(w.items[p]) and is_near(phrase, first, last, positions, span, int(s)):
                            near_hit[d].update(w.items[p])
                spans = [_merge(h) for h in hits]
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["shard"]] * len(lengths)), pa.array(range(len(lengths)), pa.int32()), pa.array(row["doc_ids"], b.column(1).type.value_type), pa.array(lengths),
                    pa.array([[{"start": x, "end": y} for x, y in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                    pa.array([sorted(map(str, s)) for s in items_hit], pa.list_(pa.string())), pa.array([sorted(map(str, s)) for s in near_hit], pa.list_(pa.string())),
                ], ["shard", "ordinal", "doc_id", "n_words", "spans", "items", "near"])

    return index.mapInArrow(run, f"shard string, ordinal int, doc_id {id_type}, n_words long, spans array<struct<start:int,end:int>>, items array<string>, near array<string>")


def _merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _blocks(benchmark: DataFrame):
    """The test set in blocks of bounded size, streamed through the driver one partition at a time."""
    block, size = [], 0
    for r in benchmark.select("item_id", F.col("text").cast("string").alias("text")).toLocalIterator():
        if r.text is None:
            continue
        block.append((r.item_id, r.text))
        size += len(r.text)
        if size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, slack: int = -1) -> DataFrame:
    """One row for each row of docs: doc_id, n_words, n_hit, n_items, items (sorted as strings), spans, near.

    A document word inside an occurrence of a test window is hit. Null and wordless texts have no words and no hits;
    repeated items and documents count each for themselves; an empty test set leaves all clean; extra columns are ignored.
    near has the items with a proximity match (see search), exact ones among them; with slack < 0 it is empty.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    blocks, gap = _blocks(benchmark), gap_of(width, slack)
    block = next(blocks, [])
    following = next(blocks, None)
    if following is None:  # one block: only postings that some test term reads are stored
        index = cut(build_index(docs, frozenset(t for _, x in block for t in words_of(x)), gap), "index")
        found = search(index, block, width, slack, gap)
    else:
        index = cut(build_index(docs, gap=gap), "index")
        parts = search(index, block, width, slack, gap)
        while following is not None:
            parts, following = parts.union(search(index, following, width, slack, gap)), next(blocks, None)
        merged = parts.groupBy("shard", "ordinal").agg(
            F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("near")))).alias("near"),
        )
        covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")), lambda a, s: F.struct((a["n"] + F.greatest(s["end"] - F.greatest(s["start"], a["to"]), F.lit(0))).alias("n"), F.greatest(a["to"], s["end"]).alias("to")))["n"]
        return merged.select("doc_id", "n_words", covered.cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans", "near")
    n_hit = F.aggregate("spans", F.lit(0), lambda a, s: a + s["end"] - s["start"]).cast("long")
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), "items", "spans", "near")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = 10, slack: int = NEAR_SLACK) -> DataFrame:
    """The rows of docs without a hit word and without a proximity match (slack < 0: without a hit word), all columns.

    Rows are told apart by id and a hash of the text: a repeated id takes nothing else with it. All columns stay, whatever
    their names.
    """
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.hex(F.xxhash64(F.col("text").cast("string"))))
    found = find_contamination(docs.select(key.alias("doc_id"), "text"), benchmark, width, slack)
    own = fresh(docs, "key")
    dirty = cut(found.where("n_hit > 0 or size(near) > 0").select(F.col("doc_id").alias(own)).distinct(), "dirty")
    return docs.join(dirty.hint("shuffle_hash"), key == F.col(own), "left_anti")
