"""Chosen-path join, bit-sliced search and run detection against brute force and
on the hard cases: nulls, empty and very long texts, ties, repeated rows, empty
tables, clashing column names."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shardwise.llm import bytewords, chosen_path, periodic_runs, queries, signature_search
from tests.conftest import SF001
from tests.llm.test_text_operators import docs_df, word_list

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- words by bytes --------------------------------------------------------

@pytest.mark.parametrize(("table", "pattern", "fold"), [(bytewords.PLAIN, BLANK, False), (bytewords.FOLDED, BLANK, True), (bytewords.TERMS, TERM, True)])
def test_byte_words_are_those_of_the_pattern(table, pattern, fold):
    texts = ["Ab  c\td", None, "", "É é x\x85y", "a\x0bb\x0cc\x1cd", "ab-C_d{e}0 9\x7f", "東京 İ ß", "x", "end ", " begin", "A", "a"]
    w = bytewords.words(bytewords.binary(pa.array(texts)), table)
    expected = [pattern.findall((t or "").translate(LOWER) if fold else (t or "")) for t in texts]
    assert np.diff(w.bounds).tolist() == [len(x) for x in expected]
    named = dict(zip([x for xs in expected for x in xs], w.hashes.tolist(), strict=True))
    assert len(set(named.values())) == len(named)
    assert [named[x] for xs in expected for x in xs] == w.hashes.tolist()
    part = bytewords.binary(pa.array(texts)).slice(3, 4)  # an array that is a slice of another
    assert bytewords.words(part, table).hashes.tolist() == [named[x] for xs in expected[3:7] for x in xs]


# --- chosen-path join --------------------------------------------------------

def shingles(text, n=4):
    w = BLANK.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_components(texts, percent=80):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and 100 * shared >= percent * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [len(s) for s in sets], [find(i) for i in range(len(texts))]


def check_components(spark, texts, **options):
    got = sorted(tuple(r) for r in chosen_path.join(docs_df(spark, texts), **options).collect())
    size, component = brute_components(texts, options.get("percent", 80))
    assert got == [(i, size[i], component[i], component[i] == i) for i in range(len(texts))]


def near_copies(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.integers(0, most + 1)):
            w[rng.integers(len(w))] = f"x{rng.integers(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize(("limit", "depth", "block"), [(32, 5, 256), (2, 3, 4), (3, 1, 8)])
def test_components_equal_brute_force(spark, limit, depth, block):
    rng = np.random.default_rng(limit)
    texts = []
    for _ in range(12):
        texts += near_copies(rng, word_list(rng, int(rng.integers(30, 120))), int(rng.integers(1, 9)), 4)
    passage = " ".join(word_list(rng, 25))  # shared by many texts that are no copies
    texts += [f"{' '.join(word_list(rng, 40))} {passage} {' '.join(word_list(rng, 10))}" for _ in range(40)]
    texts += near_copies(rng, word_list(rng, 80), 60, 3)
    check_components(spark, [texts[i] for i in rng.permutation(len(texts))], limit=limit, depth=depth, block=block)


def test_chains_link_through_the_middle(spark):
    rng = np.random.default_rng(8)
    words, chain = word_list(rng, 60), []
    for i in range(25):
        chain.append(" ".join(words))
        words[i * 2] = f"new{i}"
    check_components(spark, chain, limit=4, block=8)
    check_components(spark, chain, percent=95)


def test_join_of_hard_rows(spark):
    rng = np.random.default_rng(3)
    base = " ".join(word_list(rng, 60))
    long = " ".join(word_list(rng, 30_000))
    texts = [None, "", " \n ", "one", "ONE", "two words", "two\twords", base, base.upper(), base + " more", long, long + " end", "a b c", "b c a"]
    check_components(spark, texts)
    clash = docs_df(spark, [base, base + " x", None, base], [5, None, 7, 5]).withColumns({c: F.lit(1) for c in ("node", "label", "cid", "_mark", "k1")})
    got = sorted(chosen_path.join(clash).collect(), key=str)
    assert [(r["doc_id"], r["component_id"], r["kept"]) for r in got] == [(5, 5, True), (5, 5, True), (7, 7, True), (None, 5, False)]
    assert chosen_path.join(docs_df(spark, [])).count() == 0
    with pytest.raises(ValueError, match="threshold"):
        chosen_path.join(clash, percent=40)


def test_plan_reaches_the_recall():
    for share, depth in ((0.8, 5), (0.8, 1), (0.6, 3)):
        roots = chosen_path.plan(share, 0.9999, depth)
        rng, lost = np.random.default_rng(1), 0
        most = math.ceil(1 / share)
        extra = 1 / share - most + 1
        for _ in range(3000):  # the branching process itself
            alive = rng.binomial(sum(roots), share)
            for _ in range(depth - 1):
                alive = rng.binomial(alive * (most - 1) + rng.binomial(alive, extra), share)
            lost += alive == 0
        assert lost <= 4
    bar = chosen_path.sketch_bar(0.8, 96)
    assert sum(math.comb(96, i) * 0.8**i * 0.2 ** (96 - i) for i in range(bar, 97)) > 0.9999


def test_pairs_of_units():
    side = np.array([2, 2, 2, 0, 0, 1, 1, 1, 2, 0, 1], dtype=np.int64)
    starts = np.array([0, 3, 8, 9, 11])
    got = sorted((int(x), int(y)) for a, b in chosen_path._pairs(side, starts) for x, y in zip(a, b, strict=True))
    assert got == sorted([(0, 1), (0, 2), (1, 2)] + [(i, j) for i in (3, 4) for j in (5, 6, 7)] + [(9, 10)])


def test_no_tree_leaves_a_large_group_to_one_unit(spark):
    """400 near copies under limits of 8 and blocks of 16: done by the pivots."""
    rng = np.random.default_rng(11)
    texts = near_copies(rng, word_list(rng, 100), 400, 2)
    got = chosen_path.join(docs_df(spark, texts), limit=8, block=16).collect()
    assert {r["component_id"] for r in got} == {0} and sum(r["kept"] for r in got) == 1


# --- bit-sliced search -------------------------------------------------------

def brute_search(docs, items, k=10):
    """docs: (id, text); the contract's integers in plain Python."""
    terms = [(i, Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in docs]
    held = [(i, c) for i, c in terms if c]
    n_docs, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        scores = []
        for i, c in held:
            m = 100 - 75 + (75 * sum(c.values()) * n_docs) // length
            s = sum(r * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, r in asked.items() if t in c)
            if s > 0:
                scores.append((-s, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def items_df(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize(("first", "block_terms"), [(20, 200_000), (10, 40)])
def test_search_equals_brute_force(spark, first, block_terms):
    rng = np.random.default_rng(5)
    docs = [(i, " ".join(f"t{int(x)}" for x in rng.zipf(1.3, int(rng.integers(1, 120))) % 300)) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "!!! ..."), (1003, "Solo SOLO solo " * 50), (1004, " ".join(f"u{i}" for i in range(30_000)))]
    items = [(i, " ".join(f"t{int(x)}" for x in rng.zipf(1.4, int(rng.integers(1, 25))) % 300)) for i in range(30)]
    items += [(100, None), (101, ""), (102, "solo"), (103, "unknown words"), (104, "u1 u2 u29999 t1 t1 t1")]
    got = signature_search.search(docs_df(spark, [t for _, t in docs], [i for i, _ in docs]), items_df(spark, items), first=first, block_terms=block_terms)
    assert sorted(tuple(r) for r in got.select("item_id", "rank", "doc_id", "score").collect()) == brute_search(docs, items)


def test_bounds_are_never_below_the_scores(spark):
    """Upper bounds of every document from the bitmaps alone, and few of them
    high enough to need an exact score."""
    rng = np.random.default_rng(6)
    docs = [(i, " ".join(f"t{int(x)}" for x in rng.zipf(1.2, 80) % 2000)) for i in range(600)]
    index = signature_search.build(docs_df(spark, [t for _, t in docs])).collect()
    counts = [Counter(TERM.findall(t)) for _, t in docs]
    terms = sorted({t for c in counts for t in c})[:200] + ["absent", "missing"]
    hashes = bytewords.words(bytewords.binary(pa.array(terms)), bytewords.TERMS).hashes
    assert sorted(i for b in index for i in b["ids"]) == list(range(600))
    over = 0
    for b in index:
        tf = signature_search.frequencies(b.asDict(), hashes)
        true = np.array([[counts[i][t] for i in b["ids"]] for t in terms])
        assert (tf >= true).all()
        over += int(((tf > 0) & (true == 0)).sum())
    assert over < 0.01 * len(terms) * 600


def test_search_of_hard_tables(spark):
    docs = docs_df(spark, ["same words", "same words", "same words", "other", None], [7, 7, None, 2, 3]).withColumns({c: F.lit(1) for c in ("query", "bound", "rank", "id", "score")})
    items = items_df(spark, [(1, "words"), (1, "words"), (None, "other")])
    got = sorted((tuple(r) for r in signature_search.search(docs, items).select("item_id", "rank", "doc_id").collect()), key=str)
    assert got == sorted([(1, 1, 7), (1, 2, 7), (1, 3, None)] * 2 + [(None, 1, 2)], key=str)
    assert signature_search.search(docs.limit(0), items).count() == 0 == signature_search.search(docs, items.limit(0)).count()
    assert signature_search.search(docs_df(spark, [None, "..."]), items).count() == 0


# --- runs ------------------------------------------------------------------

def brute_runs(words, least=24, times=3):
    """Every period in turn; periods that are multiples of a found one at the
    same place are not the smallest."""
    found, at = [], {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(least, times * q) and not any(q % d == 0 for d in at.get((i, j + q), [])):
                found.append((i, j + q - i, q))
                at.setdefault((i, j + q), []).append(q)
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_words(rng):
    size, n, out = int(rng.choice([1, 2, 2, 3, 5, 50])), int(rng.integers(0, 200)), []
    while len(out) < n:
        unit = [f"w{rng.integers(size)}" for _ in range(rng.integers(1, 15))]
        out += (unit * int(rng.integers(1, 9)))[: int(rng.integers(1, 90))] if rng.random() < 0.6 else unit
    return out


@pytest.mark.parametrize("least", [24, 3])
def test_runs_equal_brute_force(spark, least):
    rng = np.random.default_rng(least)
    texts = [periodic_words(rng) for _ in range(150)]
    a, b = ["a"], ["a", "b"]
    while len(b) < 300:  # a word with very many runs, and one without any cube
        a, b = b, b + a
    texts += [b, [str(bin(i).count("1") % 2) for i in range(512)], ["x"] * 700, (["x"] * 100 + ["y"]) * 4, ["p", "q"] * 11 + ["p"], ["p", "q"] * 12]
    got = {r["doc_id"]: r for r in periodic_runs.find(docs_df(spark, [" \t".join(t) for t in texts]), least=least).collect()}
    for i, words in enumerate(texts):
        runs = brute_runs(words, least)
        assert [tuple(r) for r in got[i]["runs"]] == runs and got[i]["n_words"] == len(words)
        assert got[i]["collapsed"] == collapsed(words, runs)


def test_runs_of_hard_rows(spark):
    texts = [None, "", " \n\t", "a " * 23, "a " * 24, "é b " * 30, "A a " * 20, "a " * 24]
    df = docs_df(spark, texts, [1, 2, 3, 4, 5, 6, None, 5]).withColumns({c: F.lit(1) for c in ("runs", "n_words", "collapsed", "_found")})
    got = sorted((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periodic_runs.find(df).collect())
    assert got == [(0, 40, [(0, 40, 2)], "A a"), (1, 0, [], ""), (2, 0, [], ""), (3, 0, [], ""), (4, 23, [], " ".join("a" * 23)), (5, 24, [(0, 24, 1)], "a"), (5, 24, [(0, 24, 1)], "a"), (6, 30, [(0, 30, 1)], "é b")]
    assert periodic_runs.find(docs_df(spark, [])).count() == 0


def test_long_repetitive_texts_take_about_linear_time():
    import time

    n = 300_000
    fib = [np.array([1]), np.array([1, 2])]
    while len(fib[-1]) < n:
        fib.append(np.concatenate([fib[-1], fib[-2]]))
    block = np.full(n // 2, 7)
    for words in (np.full(n, 7), np.concatenate([block, [8], block]), np.arange(n) % 1000, fib[-1]):
        at = time.process_time()
        periodic_runs.runs_of(periodic_runs.mix(words.astype(np.uint64)), np.array([0, len(words)]))
        assert time.process_time() - at < 20


def test_run_query_equals_its_contract(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = queries.QUERIES["op13_periodic_runs"](spark, SF001).collect()
    assert len(rows) == len(docs)
    changed = 0
    for r in rows:
        words = BLANK.findall(docs[r["doc_id"]])
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        if n > 2500:
            continue
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        runs = brute_runs(words)
        best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]), default=(None,) * 3)
        digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
        assert tuple(r)[1:] == (len(runs), *best, 1000 * best[1] // best[2] if runs else None, digest("".join(f"{s},{m},{q}\n" for s, m, q in runs)), digest(collapsed(words, runs)))
    assert changed > 5
