"""Token counts by a map-side two-tier lookup.

Tier one is a compact hash table of the lengths of frequent pre-tokens, broadcast to all tasks: the vocabulary's own
entries that the pre-split keeps whole, which are the strings that merges were made for in the vocabulary's own corpus.
(Frequency is not measured anew: that would shuffle pre-tokens.) Its size is bounded by the vocabulary. Tier two walks the
misses through the tokenization automaton and keeps their lengths in a cache of bounded size in each worker. Nothing is
shuffled, least of all pre-tokens. A task looks up each distinct pre-token of a slice of texts once and adds lengths up
along the slice.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import Tokenizer, _read, compiled_of, in_units, slices
from tidemark.llm.common import released

#: Pre-tokens in a worker's cache; at its bound it starts afresh.
CACHED = 200_000


def frequent_lengths(tok: Tokenizer) -> dict[str, int]:
    """Pre-token -> tokens, for the vocabulary's entries that are pre-tokens themselves."""
    texts = []
    for label in tok.automaton.labels:
        try:
            text = bytes(tok.byte_of[c] for c in label).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if tok.units(text) == [text] and tok.pieces(text) == [text]:
            texts.append(text)
    return dict(zip(texts, tok.paths(texts)[1].tolist()))


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit for each row of docs.

    Null texts are empty: no bytes, no tokens. Strings of special tokens inside a text count as one token each, as the
    library counts them by default. Repeated rows each get a row; other columns are ignored; an empty table gives an
    empty result.
    """
    compiled = compiled_of(_read(tokenizer_path))
    shared = docs.sparkSession.sparkContext.broadcast((compiled, frequent_lengths(Tokenizer(compiled))))
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        compiled, lengths = shared.value
        tok = Tokenizer(compiled)
        cache: dict[str, int] = {}
        for b in batches:
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            n = [np.empty(0, np.int64)]
            for _, texts in slices(b.column(1)):
                distinct, places, bounds = in_units(tok, texts)
                missed = [u for u in distinct if u not in lengths and u not in cache]
                found = dict(zip(missed, tok.paths(missed)[1].tolist()))
                each = np.array([lengths.get(u) or cache.get(u) or found[u] for u in distinct], np.int64)
                if len(cache) + len(found) > CACHED:
                    cache.clear()
                cache.update(list(found.items())[:CACHED])
                n.append(np.diff(np.concatenate([[0], np.cumsum(each[places])])[bounds]))
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(np.concatenate(n))], ["doc_id", "n_bytes", "n_tokens"])

    out = docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(released(run), f"doc_id {kind.simpleString()}, n_bytes long, n_tokens long")
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
