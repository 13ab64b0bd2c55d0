"""The training-data operators against brute force, and their edge cases."""

import hashlib
import html
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bpe, chat_format, decontaminate, html_extract, lm_score, ngram_join, quality_rules, queries, secret_scan, token_counts, url_filter
from tidemark.llm.queries import QUERIES, tokenizer_path
from tidemark.llm.sql import ORACLE_SQL
from tests.parity import assert_equal, views

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empties, a long text, ties, repeated rows and extra columns with clashing names."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "One  TWO"), (6, "word " * 5000), (6, "word " * 5000), (None, "a b c d e f"), (7, "a b c d e f"), (8, "Ünï çødé 日本語 \u0000 x")]
    df = spark.createDataFrame(rows, DOCS)
    names = ["n_shingles", "component_id", "n", "h1", "key", "label", "row", "word", "spans", "n_words", "ids", "verdict", "kept", "lang", "source", "n_chars", "__row", "__id", "__hash", "__key"]
    return df.select("*", *[F.lit(1).alias(c) for c in names])


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    assert_equal(spark, views(FOLDER), FOLDER, QUERIES[name], ORACLE_SQL[name])


# 1


def jaccard_components(texts, width=4, num=85):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set())
    label = list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def test_ngram_join_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    texts = []
    for n in (1, 3, 4, 5, 9, 10, 12, 30, 60, 200):
        base = [f"w{x}" for x in rng.integers(0, 10_000, n)]
        for _ in range(8):
            w = list(base)
            for _ in range(int(rng.integers(0, max(1, n // 20) + 1))):
                w[int(rng.integers(0, n))] = f"w{rng.integers(0, 10_000)}"
            texts.append(" ".join(w).upper() if rng.random() < 0.3 else " ".join(w))
    order = rng.permutation(len(texts))
    texts = [texts[i] for i in order]
    sizes, labels = jaccard_components(texts)
    got = ngram_join.ngram_jaccard_join(spark.createDataFrame(list(enumerate(texts)), DOCS))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == [(i, sizes[i], labels[i]) for i in range(len(texts))]


def test_sketches_bound_the_difference_and_share_a_block():
    rng, bands = np.random.default_rng(0), ngram_join.Bands(85, 100)
    for _ in range(400):
        a = np.unique(rng.integers(0, 1 << 64, int(rng.integers(2, 400)), np.uint64))
        k = int(rng.integers(0, len(a) // 9 + 1))
        b = np.unique(np.concatenate([a[k:], rng.integers(0, 1 << 64, int(rng.integers(0, len(a) // 9 + 1)), np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        apart = len(a) + len(b) - 2 * both
        x, y = ngram_join.parity_sketch(a, 32), ngram_join.parity_sketch(b, 32)
        assert int(np.bitwise_count(x ^ y).sum()) <= apart
        p, q = sorted((ngram_join.own_sketch(a), ngram_join.own_sketch(b)), key=len)
        while len(q) > len(p):
            q = q[: len(q) // 2] ^ q[len(q) // 2 :]
        assert int(np.bitwise_count(p ^ q).sum()) <= apart
        if apart and 100 * both >= 85 * (len(a) + len(b) - both):
            assert np.intersect1d(np.concatenate(ngram_join.block_keys(a, bands)), np.concatenate(ngram_join.block_keys(b, bands))).size


def test_shingle_sets_of_slices():
    texts = pa.array(["a b c d e", None, "", "A B C D E", "x", "  a  b\tc\nd e "])
    sets = list(ngram_join.shingle_sets(texts, 4))
    assert [len(s) for s in sets] == [2, 0, 0, 2, 1, 2]
    assert (sets[0] == sets[3]).all() and (sets[0] == sets[5]).all()
    assert [len(s) for s in ngram_join.shingle_sets(texts.slice(3, 2), 4)] == [2, 1]


def test_ngram_join_edges(spark, odd):
    got = ngram_join.ngram_jaccard_join(odd).collect()
    assert len(got) == odd.count()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append((r.n_shingles, r.component_id))
    assert by[1] == [(0, 1)] and by[2] == [(0, 2)] and by[3] == [(0, 3)]
    assert by[4] == [(1, 4)] and by[5] == [(1, 4)] and by[6] == [(1, 6), (1, 6)]
    assert by[None] == [(3, 7)] and by[7] == [(3, 7)]
    assert ngram_join.ngram_jaccard_join(odd.limit(0)).count() == 0


def test_one_of_each_stays(spark, odd):
    kept = ngram_join.keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == [1, 2, 3, 4, 6, 7, 8]


def test_null_and_repeated_ids_do_not_join_components(spark):
    def near(name, *changed):
        w = [f"{name}{i}" for i in range(120)]
        for i in changed:
            w[i] = f"other{i}"
        return " ".join(w)

    # two components whose only link would be the label of null ids, and one of null ids alone
    rows = [(None, near("a")), (3, near("a", 50)), (None, near("b")), (7, near("b", 60)), (None, near("c")), (None, near("c", 50)), (9, near("d")), (9, near("e")), (4, near("d", 40)), (5, near("e", 40))]
    docs = spark.createDataFrame(rows, DOCS)
    got = {r.text: r.component_id for r in ngram_join.ngram_jaccard_join(docs).join(docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")), "text_hash").select("text", "component_id").collect()}
    assert [got[t] for _, t in rows] == [3, 3, 7, 7, None, None, 4, 5, 4, 5]
    kept = sorted((str(r.doc_id), r.text[:1]) for r in ngram_join.keep_one_of_each(docs).collect())
    assert kept == [("3", "a"), ("4", "d"), ("5", "e"), ("7", "b"), ("None", "c")]


def test_classes_with_one_id_link_in_the_second_round(spark):
    """Each text links with its neighbour only: links between members that are no pivot are needed, all under one id."""
    base = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(8):
        w = list(base)
        for j in range(k):
            w[20 * j + 10] = w[20 * j + 15] = f"v{j}"
        texts.append(" ".join(w))
    _, labels = jaccard_components(texts)
    assert len(set(labels)) == 1
    for ids in ([5] * 8, [None] * 8):
        docs = spark.createDataFrame(list(zip(ids, texts)), DOCS)
        assert ngram_join.ngram_jaccard_join(docs).select("component_hash").distinct().count() == 1
        assert ngram_join.keep_one_of_each(docs).count() == 1


# 2


def brute_hits(text, items, width):
    words = decontaminate.words_of(text)
    hit, found = set(), set()
    for item, t in items:
        w = decontaminate.words_of(t)
        for at in range(max(1, len(w) - width + 1) if w else 0):
            p = w[at : at + width]
            for i in range(len(words) - len(p) + 1):
                if words[i : i + len(p)] == p:
                    hit.update(range(i, i + len(p)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [10**9, 200])
def test_decontamination_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 3000)
    rng = np.random.default_rng(6)
    vocabulary = [f"t{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary, int(n)))) for i, n in enumerate((3, 5, 12, 20, 1))] + [(90, None), (91, "  "), (92, "t1 t1 t1 t1 t1 t1")]
    texts = [None, "", "T1, t2! t3"]
    for _ in range(40):
        w = list(rng.choice(vocabulary, int(rng.integers(0, 60))))
        if rng.random() < 0.6:
            w[5:5] = (items[int(rng.integers(0, 5))][1] or "").upper().split()
        texts.append(", ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit, sorted(r["items"])) for r in decontaminate.find_contamination(docs, bench, 5).collect()}
    assert got == {i: brute_hits(t, items, 5) for i, t in enumerate(texts)}


def test_proximity_and_edges(spark, odd):
    bench = spark.createDataFrame([("q", "alpha beta gamma")], "item_id string, text string")
    docs = spark.createDataFrame([(1, "gamma x beta y alpha"), (2, "alpha beta gamma"), (3, "alpha x x x x x x x x x x beta gamma")], DOCS)
    got = {r.doc_id: (list(r["items"]), list(r.near)) for r in decontaminate.find_contamination(docs, bench, 3, slack=3).collect()}
    assert got == {1: ([], ["q"]), 2: (["q"], ["q"]), 3: ([], [])}
    assert decontaminate.find_contamination(odd, bench).count() == odd.count()
    assert decontaminate.find_contamination(odd, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontaminate.find_contamination(odd.limit(0), bench).count() == 0
    kept = decontaminate.decontaminate(odd, spark.createDataFrame([(1, "one two")], "item_id int, text string"))
    assert kept.columns == odd.columns and kept.count() == odd.count() - 2


def test_altered_passages_are_near_and_leave_the_pipeline(spark):
    """A word put in, left out or swapped in every run of ten words."""
    passage = [f"w{i}" for i in range(40)]
    put_in = [x for i, w in enumerate(passage) for x in ([w, "x"] if i % 9 == 4 else [w])]
    left_out = [w for i, w in enumerate(passage) if i % 9 != 4]
    swapped = list(passage)
    for i in range(4, 39, 6):
        swapped[i], swapped[i + 1] = swapped[i + 1], swapped[i]
    apart = [x for w in passage for x in (w, "x", "y")]
    other = [f"v{i}" if i % 4 == 0 else w for i, w in enumerate(passage)]
    docs = spark.createDataFrame(list(enumerate(" ".join(w) for w in (passage, put_in, left_out, swapped, apart, other))), DOCS)
    bench = spark.createDataFrame([("q", " ".join(passage)), ("r", "w3 w3 w3 w3 w3 w3 w3 w3 w3 w3")], "item_id string, text string")
    got = {r.doc_id: (r.n_hit > 0, list(r.near)) for r in decontaminate.find_contamination(docs, bench, slack=decontaminate.NEAR_SLACK).collect()}
    assert got == {0: (True, ["q"]), 1: (False, ["q"]), 2: (False, ["q"]), 3: (False, ["q"]), 4: (False, []), 5: (False, [])}
    assert sorted(r.doc_id for r in decontaminate.decontaminate(docs, bench).collect()) == [4, 5]
    wide = decontaminate.find_contamination(docs, bench, slack=80).collect()
    assert {r.doc_id: list(r.near) for r in wide}[4] == ["q"]


# 3


def brute_base(text):
    text = text or ""
    out = []
    for m in re.finditer(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.IGNORECASE | re.ASCII):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, "hex", m.end()))
    return [(s, k, e) for s, _, k, e in sorted(out)]


def test_base_spans_equal_brute_force(docs):
    rng = np.random.default_rng(7)
    parts = ["password", "Api_Key", "apikey", "token", "=", ":", " ", '"', "'", "abcdef", "0123456789abcdef01234567", "AKIA", "ABCDEFGH12345678", "é", "\n", "x", "secret=token:abcdef", "\u017f", "\u212a"]
    texts = ["".join(rng.choice(parts, 30)) for _ in range(3000)] + [d.text for d in docs]
    for t in texts:
        assert [x for x in secret_scan.scan(t) if x[1] != "literal"] == brute_base(t)


def test_lexing_and_constants():
    def found(text):
        return {text[s:e] for s, e, _ in secret_scan.literal_spans(text)}

    assert found('base = "k9Xw-77aZ"\ndb_password = base\n') == {"k9Xw-77aZ"}
    assert found('a = "k9Xw"\nclient_secret = a + "77aZ-q1"\n') == {"k9Xw", "77aZ-q1"}
    assert found("{'privateKey': 'MIIEvQ77aZ'}") == {"MIIEvQ77aZ"}
    assert found('title = "k9Xw-77aZ"\n') == set()
    assert found('password = "changeme"\npassword = "two words here"\n') == set()
    assert found("token count: 5 and the key = value") == set()
    assert found('x = "k9Xw-77aZ"\nx = other()\npassphrase = x\n') == set()
    assert found('x = "k9Xw-77aZ"\nif x == other:\n    passphrase = x\n') == {"k9Xw-77aZ"}
    assert secret_scan.name_score("dbPassword") == 1.0 and secret_scan.name_score("monkey") == 0


def test_lexing_of_configuration_types_and_subscripts():
    def found(text):
        return {text[s:e] for s, e, _ in secret_scan.literal_spans(text)}

    key = "Xk29fj3kdQ81"
    for text in (
        f"DB_PWD={key}\n", f"export DB_PWD={key} # main\r\n", f"credentials: {key}\n", f"  - credentials: {key}", f"passphrase={key}", f"[db]\npwd = {key}\n", f"A={key}\nDB_PWD=${{A}}\n",
        f'password: str = "{key}"', f'let apiKey: &str = "{key}";', f'const apiKey: Map<string, string[]> = "{key}"', f"private static x(passphrase: string = '{key}')", f'var pwd string = "{key}"', f'char passphrase[32] = "{key}";',
        f'cfg["auth_token"] = "{key}"', f"$cfg['db']['pwd'] = '{key}';", f'{{"credentials":\n\n    "{key}"}}', f'passphrase = (\n    "{key}"\n)', f'passphrase =\\\n    "{key}"',
    ):
        assert found(text) == {key}, text
        assert key not in secret_scan.redact_text(text)
    assert found("[db]\npwd = swordfish\n") == found("pwd: swordfish\n") == found("DB_PWD=swordfish") == {"swordfish"}
    for text in ("pwd = swordfish\n", "  pwd=swordfish,\n", "pwd=getpass.getpass()\n", "DB_PWD=$PWD\n", "Some text on keys: it goes on\n", "pwd: &anchor\n", "token_count: 1000000\n", f"title: {key}\n", f'title: str = "{key}"', f'cfg["title"] = "{key}"'):
        assert found(text) == set(), text


def test_long_lines_take_linear_time():
    import time

    for line in ("token " + "a'b\\ " * 200_000, "token=" + "a=b," * 200_000, "token x=" + "a+" * 200_000, "token " + "a[" * 200_000, 'token="' + "é" * 500_000, "token=1\n" + "a=\n" * 100_000):
        start = time.process_time()
        secret_scan.scan(line)
        assert time.process_time() - start < 30


def test_secret_edges(spark, odd):
    assert secret_scan.find_secrets(odd).where("size(spans) = 0").count() == odd.count()
    d = spark.createDataFrame([(1, "é token = 'abcdef0123456789abcdef0123' end", 5)], DOCS + ", n int")
    out = secret_scan.redact_secrets(d)
    assert out.columns == d.columns and out.first().text == "é [SECRET]' end"
    assert secret_scan.redact_secrets(odd).columns == odd.columns
    assert secret_scan.find_secrets(odd.limit(0)).count() == 0


# 4


def test_url_rules(spark):
    urls = ["http://WWW.Example.com/en/1?x#y", "https://a.example.com/en/", "http://example.com/en", "http://notexample.com/en/", "http://x.net/fr/a", "http://x.net/de/", "http://com/", "nothing", None, "ftp://h.com?/x", "http://x.com#/", "x://a.b://c/d", "://net/es/q"]
    pages = spark.createDataFrame([(i % 12, u, "z") for i, u in enumerate(urls)], "page_id int, url string, rule string")
    rules = spark.createDataFrame(queries.RULES, "host string, path string, action string")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(pages, rules).collect()}
    for u in urls:
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate({c: c + 32 for c in range(65, 91)}), m[2]) if m else ("", "")
        fit = [(h + p, a) for h, p, a in queries.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, key=lambda x: len(x[0]), default=(None, "allow"))
        assert got[u] == (host, path, *best), u
    assert url_filter.filter_urls(pages, rules).count() == len(urls)
    assert url_filter.filter_urls(pages, rules.limit(0)).where("verdict = 'allow' and rule is null").count() == len(urls)
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    exact = spark.createDataFrame([("x.net", "/fr/a", "block"), ("net", "/", "allow")], "host string, path string, action string")
    assert {r.url: r.rule for r in url_filter.filter_urls(pages, exact).collect()}["http://x.net/fr/a"] == "x.net/fr/a"


# 5


def test_chat_round_trip(spark):
    rng = np.random.default_rng(8)
    bits = ["### ", "Assistant", ": ", "</turn>", "\n", "&amp;", "&", "<", "#", "\\", "é", "&#35;", "&lt;"]
    rows = []
    for c in range(30):
        for t in range(int(rng.integers(1, 6))):
            role = ["user", "assistant", "system", None, "odd: role&#58;#"][int(rng.integers(0, 5))]
            rows.append((c, t, role, None if rng.random() < 0.1 else "".join(rng.choice(bits, int(rng.integers(0, 8)))), 1))
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted int")
    out = chat_format.format_conversations(turns)
    back = out.select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t"))
    losses = {}
    for r in sorted(chat_format.expand(out).collect(), key=lambda r: r.example or 0):
        assert (r.formatted is None) == bool(r.example)
        if r.example is not None:
            losses.setdefault(r.conv_id, []).append(r.target)
    for r in back.collect():
        own = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: x[1])
        assert [(t.role, t.text) for t in r.t] == [(x[2] or "", x[3] or "") for x in own]
        assert losses.get(r.conv_id, []) == [x[3] or "" for x in own if x[2] == "assistant"]
    sizes = {(r.conv_id, r.example): r.context_chars for r in chat_format.expand(out).collect()}
    for r in chat_format.examples(out).collect():
        assert len(r.context) == sizes[r.conv_id, r.example]
        assert r.context.endswith("### assistant: ") and r.context.count("### assistant: ") == r.example + 1
    assert chat_format.expand(chat_format.format_conversations(turns.limit(0))).count() == 0
    tied = spark.createDataFrame([(1, 0, "b", "x"), (1, 0, "a", "y"), (1, None, "c", "z"), (None, 0, "assistant", "n")], "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [t.text for t in r.t] for r in chat_format.format_conversations(tied).select("conv_id", chat_format.read_turns(F.col("formatted")).alias("t")).collect()}
    assert got == {1: ["z", "y", "x"], None: ["n"]}


def test_chat_query_is_native(spark):
    plan = QUERIES["op5_chat_formatting"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# 6 and 7


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_bpe_equals_the_library(docs, name):
    from tokenizers import Tokenizer

    lib, own = Tokenizer.from_file(tokenizer_path(name)), bpe.Tokenizer(open(tokenizer_path(name), "rb").read())
    rng = np.random.default_rng(9)
    letters = list("aaabcdefst  \n\t'’.,!?Σςéßİ1٣²½\x1c\x85　́日本語😀") + ["<|endoftext|>", "'ll", "the", "ing"]
    texts = ["", " ", "\n\n", "a<|endoftext|>b", "<|startoftext|>", "a" * 300] + ["".join(rng.choice(letters, int(rng.integers(0, 40)))) for _ in range(1500)] + [d.text for d in docs]
    for t in texts:
        e = lib.encode(t, add_special_tokens=False)
        ids, labels = own.encode(t)
        assert ids == e.ids, t[:80]
        if own.lower:
            assert " ".join(labels) == lib.decode(e.ids, skip_special_tokens=False)


def merged(word, merges, suffix=""):
    """BPE as it is defined: the first merge in the list that some neighbours allow, the leftmost place first."""
    rank = {m: i for i, m in reversed(list(enumerate(merges)))}
    parts = [*word[:-1], word[-1] + suffix]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: rank.get((parts[i], parts[i + 1]), len(merges)))
        if (parts[best], parts[best + 1]) not in rank:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


def test_automaton_equals_merging():
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "b"), ("ab", "bb"), ("aa", "aa")]
    cases = [(merges, "")]
    rng = np.random.default_rng(12)
    for suffix in ("", "$$"):
        for _ in range(6):  # merges as training makes them: of parts that some word has next to each other
            words, made = ["".join(rng.choice(list("abc"), int(rng.integers(2, 9)))) for _ in range(30)], []
            for _ in range(14):
                pairs = Counter(p for w in words for x in [merged(w, made, suffix)] for p in zip(x, x[1:]))
                fresh = [p for p in sorted(pairs) if "".join(p) not in {"".join(m) for m in made}]
                if fresh:
                    made.append(max(fresh, key=lambda p: pairs[p]))
            cases.append((made, suffix))
    for merges, suffix in cases:
        vocab = {t: i for i, t in enumerate([*"abc", *(c + suffix for c in "abc" if suffix), *("".join(m) for m in merges)])}
        auto = bpe.Automaton(bpe.compile_merges(vocab, merges, suffix))
        words = ["".join("abc"[x // 3**k % 3] for k in range(n)) for n in range(1, 7) for x in range(3**n)] + ["ab" * 40, "a" * 99, "", "aab" * 30]
        found, n = auto.walk_all(pa.array(words))
        at = 0
        for w, k in zip(words, n):
            labels = [auto.labels[t] for t in found[at : at + k]]
            at += k
            assert labels == (merged(w, merges, suffix) if w else []), (w, merges, suffix)
            assert labels == [auto.labels[t] for t in auto.walk(w.encode())]


def test_files_of_another_form_are_refused():
    import json

    content = json.loads(open(tokenizer_path("byte_bpe_50k.json"), "rb").read())
    content["model"]["vocab"] = {t: i for t, i in content["model"]["vocab"].items() if len(t) == 1}
    content["model"]["merges"] = []
    bpe.compile_file(json.dumps(content).encode())
    for change in ({"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": {"type": "Whitespace"}}, {"model": {**content["model"], "byte_fallback": True}}):
        with pytest.raises(ValueError):
            bpe.compile_file(json.dumps({**content, **change}).encode())
    with pytest.raises(ValueError):
        bpe.compile_merges({"a": 0, "b": 1, "c": 2, "ab": 3, "bc": 4, "abc": 5}, [("a", "b"), ("b", "c"), ("ab", "c"), ("a", "bc")])
    with pytest.raises(ValueError):
        bpe.Automaton(bpe.compile_merges({"a": 0}, [])).walk_all(pa.array(["ab"]))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_round_trip_and_slices(spark, monkeypatch, docs, name):
    from tokenizers import Tokenizer

    monkeypatch.setattr(bpe, "SLICE_CHARS", 500)
    lib = Tokenizer.from_file(tokenizer_path(name))
    texts = ["<|endoftext|>", " <|endoftext|> <|ENDOFTEXT|>", "x" * 5000, None, ""] + [d.text for d in docs[:20]]
    d = spark.createDataFrame(list(enumerate(texts)), DOCS).coalesce(1)
    out = bpe.encode_texts(d, tokenizer_path(name))
    back = {r.doc_id: r.decoded for r in bpe.decode_ids(out, tokenizer_path(name)).collect()}
    written = {r.doc_id: r.ids_text for r in bpe.encode_texts(d, tokenizer_path(name), keep_ids=False).collect()}
    for r in out.collect():
        ids = lib.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids) and written[r.doc_id] == " ".join(map(str, ids))
        assert r.decoded == back[r.doc_id] == lib.decode(ids, skip_special_tokens=False)


def test_encoding_edges(spark, odd):
    out = bpe.encode_texts(odd, tokenizer_path("word_bpe_49k.json"))
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == odd.count() and rows[1].n_tokens == 0 and list(rows[1].ids) == [] and rows[6].n_tokens == 5000
    assert {r.doc_id: r.decoded for r in bpe.decode_ids(out, tokenizer_path("word_bpe_49k.json")).collect()}[8] == rows[8].decoded
    n = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.count_tokens(odd, tokenizer_path("byte_bpe_50k.json")).collect()}
    assert n[1] == n[2] == (0, 0, False) and n[6][2] is True
    assert bpe.encode_texts(odd.limit(0), tokenizer_path("word_bpe_49k.json")).count() == 0


def test_counts_equal_the_library(spark, docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    got = {r.doc_id: (r.n_bytes, r.n_tokens) for r in QUERIES["op7_token_counts"](spark, FOLDER).collect()}
    assert got == {d.doc_id: (len(d.text.encode()), len(lib.encode(d.text, add_special_tokens=False).ids)) for d in docs}


def test_encoding_query_equals_the_library(spark, docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for d in docs:
        ids = lib.encode(d.text, add_special_tokens=False).ids
        want[d.doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op6_bpe_encoding"](spark, FOLDER).collect()} == want


# 8


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    many = Counter(windows)
    inside = {j for i, w in enumerate(windows) if many[w] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, r = len(words), len(inside)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), r, n < 20 or 100 * r > 30 * n


def test_quality_equals_brute_force(spark, odd, docs):
    rng = np.random.default_rng(10)
    texts = [" ".join(rng.choice(["the", "a", "b|", "c\n", "é"], int(n))) for n in rng.integers(0, 80, 60)] + [r.text for r in odd.select("text").collect()] + [d.text for d in docs]
    d = spark.createDataFrame(list(enumerate(texts)), DOCS)
    m = "verdict.measures."
    got = quality_rules.judge(d, ["doc_id"]).select("doc_id", *[m + c for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], "verdict.base_failed", "verdict.kept")
    for r in got.collect():
        assert tuple(r)[1:7] == brute_quality(texts[r.doc_id]), texts[r.doc_id][:50]
        assert not (r.base_failed and r.kept)
    assert quality_rules.keep_good(odd).columns == odd.columns
    assert quality_rules.keep_good(odd.limit(0)).count() == 0


def test_labelled_good_documents_stay(spark):
    folder = "/root/testdata/sf0.01"
    j = QUERIES["op8_quality_rules"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("not base_failed")
    assert j.where("quality = 1 and not kept").count() == 0
    assert j.where("quality = 0 and not kept").count() > 0.9 * j.where("quality = 0").count()


# 9


def brute_ctw(train_words, words, depth=lm_score.DEPTH):
    """Context-tree weighting of whole words by recursion over every node."""
    counts = {}
    for w, c in train_words.items():
        for g in lm_score.grams_of(w):
            byte, context = g & 255, g >> 8
            for d in range(depth + 1):
                for level in range(8):
                    node = (1 << level) | (byte >> (8 - level))
                    x = counts.setdefault((d, context & ((1 << 8 * d) - 1), node), [0, 0])
                    x[(byte >> (7 - level)) & 1] += c
    children = {}
    for d, c, n in counts:
        if d:
            children.setdefault((d - 1, c & ((1 << 8 * (d - 1)) - 1), n), []).append((d, c, n))
    mixed = {}

    def kt(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    def weigh(key):
        if key not in mixed:
            own = kt(*counts[key])
            mixed[key] = own if key[0] == depth else np.logaddexp(own, sum(map(weigh, children.get(key, [])))) - math.log(2)
        return mixed[key]

    def predict(d, context, node, bit):
        key = (d, context & ((1 << 8 * d) - 1), node)
        if key not in counts:
            return 0.5
        z, o = counts[key]
        own = ((o if bit else z) + 0.5) / (z + o + 1)
        if d == depth:
            return own
        w = math.exp(kt(z, o) - math.log(2) - weigh(key))
        return w * own + (1 - w) * predict(d + 1, context, node, bit)

    out = {}
    for w in words:
        total = 0.0
        for g in lm_score.grams_of(w):
            for level in range(8):
                total += math.log10(predict(0, g >> 8, (1 << level) | ((g & 255) >> (8 - level)), (g >> (7 - level)) & 1))
        out[w] = total
    return out


@pytest.mark.parametrize("frequent", [3, 65_536])
def test_scores_equal_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_score, "FREQUENT", frequent)
    rng = np.random.default_rng(11)
    texts = [None, "", "a"] + [" ".join("".join(rng.choice(list("abcé"), int(rng.integers(1, 5)))) for _ in range(int(rng.integers(0, 25)))) for _ in range(40)]
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    tokens = [[*(t or "").encode().lower().split(), b"\n"] for t in texts]
    train = Counter(w for t, h in zip(tokens, held) if not h for w in t)
    n, v = sum(train.values()), len(train)
    ctw = brute_ctw({**train, **{w: 0 for t in tokens for w in t if w not in train}}, {w for t in tokens for w in t})
    got = {r.doc_id: r for r in lm_score.score_texts(spark.createDataFrame(list(enumerate(texts)), DOCS)).collect()}
    for i, t in enumerate(tokens):
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), sum(w in train for w in t), n)
        assert r.base_score == pytest.approx(sum(math.log10((train[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t), abs=1e-9)
        assert r.score == pytest.approx(sum(ctw[w] for w in t), abs=1e-7)


def test_model_beats_the_base_on_held_out_texts(spark):
    r = QUERIES["op9_lm_scoring"](spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b"), F.avg("bits_per_byte").alias("x")).first()
    assert r.x < 4
    assert r.s > 2 * r.b


def test_a_byte_is_a_distribution(spark):
    words = spark.createDataFrame([(w.encode(), 3) for w in ("ab", "abc", "b")], "word binary, c long")
    every = spark.createDataFrame([((int.from_bytes(b"    a", "big") << 8) | x, 0) for x in range(256)], "gram long, c long")
    grams = lm_score.gram_counts(words).unionByName(every).groupBy("gram").agg(F.sum("c").alias("c"))
    p = [10**r.value for r in lm_score.gram_scores(grams).where(F.col("gram").bitwiseAND(F.lit(~255)) == (int.from_bytes(b"    a", "big") << 8)).collect()]
    assert len(p) == 256 and sum(p) == pytest.approx(1, abs=1e-9)


def test_score_edges(spark, odd):
    assert lm_score.score_texts(odd).count() == odd.count()
    assert lm_score.score_texts(odd.limit(0)).count() == 0


def test_words_beyond_the_broadcast(spark, monkeypatch):
    d = spark.createDataFrame([(i, f"alpha beta{i} gamma") for i in range(12)], DOCS)
    a = {r.doc_id: r.score for r in lm_score.score_texts(d).collect()}
    monkeypatch.setattr(lm_score, "GRAM_LIMIT", 0)
    b = {r.doc_id: r.score for r in lm_score.score_texts(d).collect()}
    assert a == pytest.approx(b)


# 10


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li></ul></nav><div class="cookie-notice">We use cookies, really.</div>
<div class="ad">Buy now, and cheap, and a lot of it.</div><!-- ad --><article><header><h1>Head &amp; line</h1></header><p><b>First   one.<br><p>Second <i>para</i>graph, with&nbsp;words.</p>
<form>Mail <input></form><ul><li>item<li>other</ul><aside>See also</aside><section class="comments"><p>Great article, I read it twice and then again!</p></section></article>
<div id="sidebar"><p>Some other text that stands at the side of it.</p></div><footer>&copy; me</footer></body></html>"""


def test_extraction():
    assert html_extract.extract(PAGE) == "Head & line\nFirst one.\nSecond paragraph, with words.\nitem\nother"
    plain = "<body><div><a href=x>one</a> <a href=y>two</a></div><div><p>" + "Long text here. " * 9 + "</p><p>" + "More of it. " * 9 + "</p></div></body>"
    assert html_extract.extract(plain) == ("Long text here. " * 9).strip() + "\n" + ("More of it. " * 9).strip()
    for x in (None, "", "   ", "<p></p>", "<!-- only", "<script>x"):
        assert html_extract.extract(x) == ""
    assert html_extract.extract("just text &lt;b&gt;") == "just text <b>"
    assert html_extract.extract("<div>" * 20000 + "deep") == "deep"


def test_extraction_of_the_given_pages(spark):
    for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        article = re.search(r"(?s)<article>(.*)</article>", r.html)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>|</?i>", "", b))).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert html_extract.extract(r.html) == "\n".join(b for b in blocks if b)


def test_extraction_edges(spark):
    pages = spark.createDataFrame([(1, None, None, 3), (1, None, None, 3), (2, "u", PAGE, 4)], "page_id long, url string, html string, text int")
    got = html_extract.extract_pages(pages)
    assert sorted((r.page_id, r.n_chars) for r in got.collect()) == [(1, 0), (1, 0), (2, len(html_extract.extract(PAGE)))]
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


def test_density_chooses_beside_articles_of_others():
    text = "<div id=story><h1>Head</h1><p>" + "Long text here, and more of it. " * 9 + "</p><p>" + "Other text there, even more of it. " * 9 + "</p></div>"
    want = "Head\n" + ("Long text here, and more of it. " * 9).strip() + "\n" + ("Other text there, even more of it. " * 9).strip()
    comments = "<article class='comment-body'><p>" + "I read this with delight. " * 8 + "</p></article>"
    teasers = "<article><h3><a href=x>Teaser</a></h3><p><a href=x>Read on.</a></p></article>" * 3
    assert html_extract.extract(f"<body>{text}{comments * 4}</body>") == want
    assert html_extract.extract(f"<body>{text}<div class=comments><ol><li><article><p>{'Nothing of this is true. ' * 90}</p></article></li></ol></div></body>") == want
    assert html_extract.extract(f"<body>{text}{teasers}</body>") == want
    assert html_extract.extract(f"<body><div class=has-sidebar><article class='post tag-comment'>{text}{comments}</article></div>{teasers}</body>") == want


def test_broken_markup_loses_no_text():
    assert html_extract.extract("<p>x <![CDATA[hello world") == "x hello world"
    assert html_extract.extract("<p>x <![CDATA[a &amp; b]]> y</p>") == "x a &amp; b y"
    assert html_extract.extract("<p>a &am<b>p;</b> b &lt; c</p>") == "a &amp; b < c"
    assert html_extract.extract("<p>one <a href=\"x>two</a> three</p><p>four</p>") == "one two three\nfour"
    assert html_extract.extract("<p>one < two <a <b") == "one < two <a <b"


@pytest.mark.parametrize("page", ["<a " * 300_000, '<a ">' * 100_000, "<b>" * 50_000 + "</i>" * 50_000, "<b>" * 30_000 + "<li>x" * 3_000, "<" * 300_000, "<p>" + "x" * 1_000_000])
def test_long_broken_pages_take_linear_time(page):
    import time

    start = time.process_time()
    html_extract.extract(page)
    assert time.process_time() - start < 30
