"""BPE by a tokenization automaton.

compile_merges applies the merges one after another to an automaton over tokens that begins with every letter allowed
after every letter. A merge (u, v) -> w is a gadget: the new label w may follow whatever u may follow and be followed by
whatever v may be followed by, and from then on v can't follow u. A state is a set of labels that may come next. Labels
that lead to equal states share a row, labels that are allowed in the same states share a column; a gadget splits the row
of u and the column of v off where they are shared. What results is deterministic: a bit table of states by columns, the
state that each label leads to, and each label's column.

A pre-split word has exactly one path whose labels spell it, and so has every beginning of it. Words are walked by tables
alone, many at once: from each place, in order, a trie gives the labels that begin there, the bit table says which of them
the state there allows, and each of those is the last label of the place where it ends. Words beyond WALKED bytes are
walked one by one: the longest allowed label first, a place that no path leads on from is never entered again. Decoding
emits the labels along the arcs.

The driver compiles a file once and broadcasts the tables (their size is bounded by the vocabulary: some 50 MB for 50,000
labels). Texts are taken in slices; a slice's distinct units are walked together, and Arrow gathers what they become.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import released

#: Letters of texts that a task takes at once (a longer text by itself).
SLICE_CHARS = 2_000_000
#: The longest words, in bytes, that are walked together, and how many.
WALKED = 40
TOGETHER = 50_000


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write each byte as: printable Latin-1 bytes as themselves, the others as
    the letters from 256 on, in order."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


@dataclass(frozen=True)
class Tables:
    """A compiled automaton: labels with their ids, the state (row) each leads to, its column, the transitions; and the
    labels' trie over bytes: the next node of each inner node (0: none), and the label that ends at a node, inside of a
    word and at its end (-1: none)."""

    labels: list[str]
    ids: np.ndarray
    state: np.ndarray
    column: np.ndarray
    bits: np.ndarray
    stride: int
    suffix: str
    following: np.ndarray
    inside: np.ndarray
    at_end: np.ndarray


def byte_trie(labels: list[str], suffix: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The trie of labels written in byte letters. Nodes with children come first."""
    byte_of = {c: b for b, c in enumerate(byte_letters())}
    children: list[dict[int, int]] = [{}]
    ends: list[tuple[int, int, bool]] = []
    for i, label in enumerate(labels):
        last = bool(suffix) and label.endswith(suffix) and len(label) > len(suffix)
        node = 0
        for c in label[: -len(suffix)] if last else label:
            below = children[node]
            b = byte_of[c]
            if b not in below:
                below[b] = len(children)
                children.append({})
            node = below[b]
        ends.append((node, i, last))
    order = sorted(range(len(children)), key=lambda n: not children[n])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    following = np.zeros((sum(map(bool, children)), 256), np.int32)
    for n, below in enumerate(children):
        for b, child in below.items():
            following[place[n], b] = place[child]
    inside, at_end = np.full(len(children), -1, np.int32), np.full(len(children), -1, np.int32)
    for node, i, last in ends:
        if last or not suffix:
            at_end[place[node]] = i
        if not last:
            inside[place[node]] = i
    return following.ravel(), inside, at_end


class _Shared:
    """Which rows (or columns) labels have, and how many labels have each."""

    def __init__(self, letters: int, labels: int):
        self.of, self.users, self.n = np.zeros(labels, np.int32), [letters], 1

    def put(self, label: int, at: int) -> None:
        self.of[label] = at
        self.users[at] += 1

    def split(self, label: int) -> tuple[int, int] | None:
        """Give a label one of its own; None where it has that already, else the old and the new one."""
        old = int(self.of[label])
        if self.users[old] == 1:
            return None
        self.users[old] -= 1
        self.users.append(1)
        self.of[label] = self.n
        self.n += 1
        return old, self.n - 1


def compile_merges(vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = "") -> Tables:
    """The automaton after one gadget for each merge, in order. A merge whose labels never follow each other when its turn
    comes makes no label; a label that two merges make is refused."""
    bare = lambda t: t.removesuffix(suffix) if suffix and len(t) > len(suffix) else t
    labels = [t for t in vocab if len(bare(t)) == 1]
    code = {t: i for i, t in enumerate(labels)}
    rows, columns = _Shared(len(labels), len(labels) + len(merges)), _Shared(len(labels), len(labels) + len(merges))
    bits = np.full((1024, 128), 255, np.uint8)
    for u, v in merges:
        w = u + v
        if w in code or w not in vocab:
            raise ValueError(f"merge of {u!r} and {v!r}: the label is made twice or has no id")
        if u not in code or v not in code:
            continue
        a, b, c = code[u], code[v], len(labels)
        if not bits[rows.of[a], columns.of[b] >> 3] >> (columns.of[b] & 7) & 1:
            continue
        code[w] = c
        labels.append(w)
        rows.put(c, int(rows.of[b]))  # before v is barred: aa may be followed by a where a may not
        if (new := rows.split(a)) is not None:
            if rows.n > len(bits):
                bits = np.concatenate([bits, np.zeros_like(bits)])
            bits[new[1]] = bits[new[0]]
        if (new := columns.split(b)) is not None:
            if columns.n > 8 * bits.shape[1]:
                bits = np.concatenate([bits, np.zeros_like(bits)], axis=1)
            (old, own), part = new, bits[: rows.n]
            bit = part[:, old >> 3] >> (old & 7) & 1
            part[:, own >> 3] = part[:, own >> 3] & (255 ^ 1 << (own & 7)) | bit << (own & 7)
        r, k = int(rows.of[a]), int(columns.of[b])
        bits[r, k >> 3] &= 255 ^ 1 << (k & 7)
        columns.put(c, int(columns.of[a]))  # after v is barred: a may not be followed by aa where a may not by a
    stride = (columns.n + 7) // 8
    n = len(labels)
    return Tables(labels, np.array([vocab[t] for t in labels], np.int32), rows.of[:n], columns.of[:n], np.ascontiguousarray(bits[: rows.n, :stride]).ravel(), stride, suffix, *byte_trie(labels, suffix))


class Automaton:
    """Walks words by compiled tables."""

    def __init__(self, tables: Tables):
        self.tables, self.labels = tables, tables.labels
        self.row = tables.state.astype(np.int64) * tables.stride
        self.cell = (tables.column >> 3).astype(np.int64)
        self.mask = (1 << (tables.column & 7)).astype(np.uint8)
        self.letters = byte_letters()
        self.size = np.array([len(t.removesuffix(tables.suffix)) if tables.suffix and len(t) > len(tables.suffix) else len(t) for t in tables.labels], np.int64)

    @cached_property
    def code(self) -> dict[str, int]:
        return {t: i for i, t in enumerate(self.labels)}

    def walk(self, word: bytes) -> list[int]:
        """The labels along one word's path, as places in labels."""
        word = "".join([self.letters[b] for b in word])
        whole = word + self.tables.suffix
        get, bits, row, cell, mask = self.code.get, self.tables.bits, self.row, self.cell, self.mask
        longest = int(self.size.max())
        n, begin, state = len(word), 0, -1
        end = min(n, longest)
        path: list[tuple[int, int, int, int]] = []  # label, its place and end, the state before it
        dead: set[int] = set()
        while begin < n:
            while end > begin:
                if end not in dead:
                    t = get(word[begin:end] if end < n else whole[begin:])
                    if t is not None and (state < 0 or bits[state + cell[t]] & mask[t]):
                        break
                end -= 1
            else:
                if not path:
                    raise ValueError(f"no path spells {word!r}")
                dead.add(begin)
                _, begin, end, state = path.pop()
                end -= 1
                continue
            path.append((t, begin, end, state))
            begin, state = end, int(row[t])
            end = min(n, begin + longest)
        return [x[0] for x in path]

    def _walk_short(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(labels of all words in order, how many each word has) of words of WALKED bytes at most."""
        t, inner = self.tables, len(self.tables.following) // 256
        last = np.full((len(size), int(size.max(initial=0)) + 1), -1, np.int32)
        for place in range(last.shape[1] - 1):
            own = np.flatnonzero((size > place) & (last[:, place] >= 0)) if place else np.flatnonzero(size > 0)
            state = self.row[last[own, place]] if place else None
            node, end = np.zeros(len(own), np.int64), place
            while len(own):
                node = t.following[node * 256 + data[start[own] + end]].astype(np.int64)
                end += 1
                done = size[own] == end
                label = np.where(done, t.at_end[node], t.inside[node])
                allowed = (node > 0) & (label >= 0)
                if place:
                    allowed[allowed] = t.bits[state[allowed] + self.cell[label[allowed]]] & self.mask[label[allowed]] > 0
                last[own[allowed], end] = label[allowed]
                on = ~done & (node > 0) & (node < inner)
                own, node = own[on], node[on]
                if place:
                    state = state[on]
        words, labels, rounds = [], [], []
        own = np.flatnonzero(size > 0)
        at = size[own]
        while len(own):
            label = last[own, at]
            if (label < 0).any():
                raise ValueError("no path spells a word")
            words.append(own)
            labels.append(label)
            rounds.append(at)
            at = at - self.size[label]
            on = at > 0
            own, at = own[on], at[on]
        if not words:
            return np.empty(0, np.int32), np.zeros(len(size), np.int64)
        word, label, at = np.concatenate(words), np.concatenate(labels), np.concatenate(rounds)
        return label[np.argsort(word * (WALKED + 1) + at, kind="stable")], np.bincount(word, minlength=len(size))

    def walk_all(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(labels of all words in order, how many each word has); empty words have none."""
        words = words.cast(pa.large_binary())
        bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)
        labels, counts = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for at in range(0, len(words), TOGETHER):
            start, size = bounds[at : at + TOGETHER + 1][:-1], np.diff(bounds[at : at + TOGETHER + 1])
            long = np.flatnonzero(size > WALKED)
            found, n = self._walk_short(data, start, np.where(size > WALKED, 0, size))
            if len(long):
                paths = [self.walk(data[start[i] : start[i] + size[i]].tobytes()) for i in long]
                found = np.insert(found, np.repeat(np.cumsum(n)[long], [len(p) for p in paths]), np.concatenate(paths))
                n[long] = [len(p) for p in paths]
            labels.append(found)
            counts.append(n)
        return np.concatenate(labels), np.concatenate(counts)


#: White space as Unicode has it, written out: str.isspace() also takes four separators that tokenizers keep.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(rf"[^{WHITE}]+")
_UNIT = re.compile(rf" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]")
#: Fixed value: how byte-level tokenizers split a text when their file names no other pattern.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _pattern(text: str):
    return regex.compile(text.replace(r"[^\s", rf"[^{WHITE}").replace(r"\s", rf"[{WHITE}]").replace(r"\S", rf"[^{WHITE}]"))


@dataclass(frozen=True)
class Compiled:
    """A tokenizer file: its automaton, special tokens, pre-split pattern, and whether texts are lowered and bytes joined."""

    tables: Tables
    special: dict[str, int]
    split: str
    lower: bool
    joined: bool


def _fields(part: dict, **wanted) -> bool:
    return all(part.get(k) == v for k, v in wanted.items())


def compile_file(content: bytes) -> Compiled:
    """Read are the two forms that such files take here: no normalizer with the byte-level split, and NFC, white space
    and lower case with a split pattern of its own, whose words carry an end mark. Anything else is refused."""
    spec = json.loads(content)
    model, normalizer, pre, decoder = spec["model"], spec["normalizer"], spec["pre_tokenizer"], spec["decoder"]
    plain = all(not model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
    if not plain or any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
        raise ValueError("the model or its added tokens have options that aren't read")
    if normalizer is not None:
        steps = [s["type"] for s in normalizer.get("normalizers", [])]
        if steps != ["NFC", "Replace", "Lowercase"] or not _fields(normalizer["normalizers"][1], pattern={"Regex": r"\s+"}, content=" "):
            raise ValueError("only NFC, white space and lower case are read as a normalizer")
    level = pre["pretokenizers"][-1] if pre["type"] == "Sequence" else pre
    own = pre["pretokenizers"][0] if pre["type"] == "Sequence" and len(pre["pretokenizers"]) == 2 else None
    if level["type"] != "ByteLevel" or level["add_prefix_space"] or level["use_regex"] != (own is None) or own is not None and not _fields(own, type="Split", behavior="Removed", invert=True):
        raise ValueError("only the byte-level split, or a pattern of its own before it, is read")
    if (own is None) != (normalizer is None) or decoder is not None and decoder["type"] != "ByteLevel":
        raise ValueError("this combination of normalizer, split and decoder isn't read")
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ", 1)) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    return Compiled(compile_merges(model["vocab"], merges, model.get("end_of_word_suffix") or ""), special, own["pattern"]["Regex"] if own else BYTE_LEVEL, normalizer is not None, decoder is not None)


class Tokenizer:
    """A byte-level BPE tokenizer over a compiled file: its special tokens, normalizer, pre-split and automaton."""

    def __init__(self, source: bytes | Compiled):
        c = compile_file(source) if isinstance(source, bytes) else source
        self.compiled, self.special, self.lower = c, c.special, c.lower
        self.automaton = Automaton(c.tables)
        self.split = _pattern(c.split)
        self.by_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.letters = byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}
        self.names, self.ids = [*c.tables.labels, *self.special], np.concatenate([c.tables.ids, np.array(list(self.special.values()), np.int32)])
        self.place = {t: len(c.tables.labels) + i for i, t in enumerate(self.special)}

    @cached_property
    def label_of(self) -> dict[int, str]:
        return dict(zip(self.ids.tolist(), self.names))

    def pieces(self, unit: str) -> list[str]:
        """The pre-split words of a unit (a run without inner white space, or of white space)."""
        if unit.isalpha() or unit[0] == " " and unit[1:].isalpha():
            return [unit]
        if unit[-1] in ".,;:!?" and (unit[:-1].isalpha() or unit[0] == " " and unit[1:-1].isalpha()):
            return [unit[:-1], unit[-1]]
        return self.split.findall(unit)

    def units(self, text: str) -> list[str]:
        """The units of an ordinary text, normalized. What is composed or lowered never reaches over white space, so a
        text is normalized at once."""
        if not self.lower:
            return _UNIT.findall(text)
        if not text.isascii():  # letters are lowered one by one, so a final sigma is like any other
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        return _CHUNK.findall(text.lower())

    def marked(self, text: str) -> list[str]:
        """The units of a text; a special token is a unit with a line feed before it, which no other unit has."""
        if self.by_special is None or not any(map(text.__contains__, self.special)):
            return self.units(text)
        out: list[str] = []
        for i, part in enumerate(self.by_special.split(text)):
            out += ["\n" + part] if i % 2 else self.units(part)
        return out

    def paths(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(labels of all units in order, how many each unit has); special tokens come after the automaton's labels."""
        pieces, counts, special = [], [], []
        for u in units:
            if u[0] == "\n" and u[1:] in self.special:
                special.append((len(pieces), u[1:]))
                pieces.append("")
                counts.append(1)
            else:
                p = self.pieces(u)
                pieces += p
                counts.append(len(p))
        found, n = self.automaton.walk_all(pa.array(pieces, pa.large_string()))
        if special:
            at = [i for i, _ in special]
            found = np.insert(found, np.cumsum(n)[at], [self.place[t] for _, t in special])
            n[at] = 1
        upto = np.concatenate([[0], np.cumsum(n)])
        return found, np.diff(upto[np.concatenate([[0], np.cumsum(np.array(counts, np.int64))])])

    def text(self, letters: str) -> str:
        """Joined labels of a file with a byte-level decoder as text."""
        byte_of = self.byte_of
        return bytes([byte_of[c] for c in letters]).decode("utf-8", "replace")

    def decode(self, ids) -> str:
        labels = [self.label_of[i] for i in ids]
        return self.text("".join(labels)) if self.compiled.joined else " ".join(labels)

    def encode(self, text: str) -> tuple[list[int], list[str]]:
        """The ids and labels of one text."""
        path = self.paths(self.marked(text))[0]
        return self.ids[path].tolist(), [self.names[t] for t in path]


_compiled: dict[bytes, Compiled] = {}


def compiled_of(content: bytes) -> Compiled:
    """The driver keeps what it compiled last."""
    key = hashlib.sha256(content).digest()
    if key not in _compiled:
        found = compile_file(content)
        _compiled.clear()
        _compiled[key] = found
    return _compiled[key]


def _read(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def slices(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first place, texts) of runs of texts of about SLICE_CHARS letters; null texts are empty."""
    at, held, size = 0, [], 0
    for t in texts:
        held.append(t.as_py() or "")
        size += len(held[-1])
        if size >= SLICE_CHARS:
            yield at, held
            at, held, size = at + len(held), [], 0
    if held:
        yield at, held


def in_units(tok: Tokenizer, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct units of some texts, the places in them of all units in order, and where each text's units begin."""
    units, bounds = [], [0]
    for t in texts:
        units += tok.marked(t)
        bounds.append(len(units))
    coded = pa.array(units, pa.string()).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.array(bounds)


def encode_texts(docs: DataFrame, tokenizer_path: str, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids (array; without keep_ids ids_text: decimal, one space between), decoded.

    The file is read and compiled by the driver and broadcast; a vocabulary file has a fixed size. Null texts are empty
    and have no tokens. Texts are encoded whole, long ones too; repeated rows each get a row; other columns are ignored;
    an empty table gives an empty result.
    """
    tables = docs.sparkSession.sparkContext.broadcast(compiled_of(_read(tokenizer_path)))
    kind = docs.schema["doc_id"].dataType

    def run(batches):
        tok = Tokenizer(tables.value)
        numbers, labels = pa.array(list(map(str, tok.ids.tolist())), pa.string()), pa.array(tok.names, pa.string())
        for b in batches:
            for first, texts in slices(b.column(1)):
                distinct, places, bounds = in_units(tok, texts)
                found, size = tok.paths(distinct)
                upto = np.concatenate([[0], np.cumsum(size[places])])[bounds]
                path = pa.LargeListArray.from_arrays(np.concatenate([[0], np.cumsum(size)]), pa.array(found, pa.int32())).take(pa.array(places)).flatten()
                upto = upto.astype(np.int32)
                joined = lambda of, by: pc.binary_join(pa.ListArray.from_arrays(upto, of.take(path)), by)  # noqa: B023, E731
                if tok.compiled.joined:
                    decoded = pa.array([tok.text(x.as_py()) for x in joined(labels, "")], pa.string())
                else:
                    decoded = joined(labels, " ")
                ids = pa.ListArray.from_arrays(upto, pa.array(tok.ids).take(path)) if keep_ids else joined(numbers, " ")
                yield pa.RecordBatch.from_arrays([b.column(0).slice(first, len(texts)), pa.array(np.diff(upto).astype(np.int64)), ids, decoded], ["doc_id", "n_tokens", "ids" if keep_ids else "ids_text", "decoded"])

    ids = "ids array<int>" if keep_ids else "ids_text string"
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(released(run), f"doc_id {kind.simpleString()}, n_tokens long, {ids}, decoded string")


def decode_ids(tokens: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, decoded from doc_id and ids: the arcs' labels; null ids are none. Files that name a byte-level decoder
    have their labels' bytes joined (what is no UTF-8 becomes U+FFFD), others one space between labels."""
    tables = tokens.sparkSession.sparkContext.broadcast(compiled_of(_read(tokenizer_path)))
    kind = tokens.schema["doc_id"].dataType

    def run(batches):
        tok = Tokenizer(tables.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([tok.decode(x.as_py() or ()) for x in b.column(1)], pa.string())], ["doc_id", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(released(run), f"doc_id {kind.simpleString()}, decoded string")
