"""Ranked search, merge-type pieces and periodic runs against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import periods, pieces, ranked
from millrace.llm.queries import QUERIES, tokenizer

pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, term int, item string, rank string, score string, n string, times string"
LONG = "word " * 30_000 + "x" * 50_000
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (6, "Same text hEre"), (6, "Same text hEre"),
    (7, "same other text"), (None, "no id here"), (2**53 + 1, "İΣ ▁▁ <unk> \x00 straße 12a-b"), (8, "a b " * 9 + "c"), (10, "q " * 5),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(*r, 1, "x", "y", "z", "u", "v") for r in ODD], SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- ranked search ----------------------------------------------------------------------


def rank_plainly(docs, items, k):
    """Every item against every document."""
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    held = [(doc_id, Counter(cut(text))) for doc_id, text in docs]
    held = [(doc_id, c) for doc_id, c in held if c]
    n, terms = len(held), sum(sum(c.values()) for _, c in held)
    out = []
    for item_id, text in items:
        scores = Counter()
        for t in set(cut(text)):
            df = sum(t in c for _, c in held)
            weight = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
            for i, (_, c) in enumerate(held):
                if c[t]:
                    m = 10 + 90 * sum(c.values()) * n // terms
                    scores[i] += weight * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
        best = sorted((-s, held[i][0] is None, held[i][0] or 0) for i, s in scores.items() if s > 0)[:k]
        out += [(item_id, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(best)]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.mark.parametrize("piece", [40, 1_000_000])
def test_search_is_whole_and_exact(spark, monkeypatch, piece):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    docs = [(i % 70 if i % 9 else None, " ".join(words[min(int(rng.expovariate(0.12)), 59)] for _ in range(rng.randint(0, 30)))) for i in range(120)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 9)))) for i in range(25)] + [(3, None), (4, docs[5][1])]
    monkeypatch.setattr(ranked, "PIECE", piece)
    got = ranked.search_documents(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string"), 4
    )
    assert found(got) == rank_plainly(docs, items, 4)


def test_items_in_blocks(spark, monkeypatch):
    docs, items = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    want = rank_plainly([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()], 10)
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 9)
    assert found(ranked.search_documents(docs, items, 10)) == want == found(QUERIES["op11_ranked"](spark, SF))


def test_no_new_accumulators_when_they_cannot_win():
    """After the rare term, the frequent one updates survivors only."""
    n = 50
    terms = np.array([0, *[1] * n])
    sizes = np.array([2, *[1] * (n - 1)])
    order = np.array([0, *range(1, n + 1)])
    totals = ranked.Totals(n, n + 1, np.array([1, n - 1]))
    piece = ranked.Piece(np.arange(n), sizes, terms[order], np.ones(n + 1, np.int64), np.ones(n, np.int64), totals, totals.weights())
    where, scores = piece.search(np.array([0, 1]), 1, 0)
    assert where.tolist() == [0] and scores[0] == piece.adds[piece.starts[0]] + piece.adds[piece.starts[1]]
    assert not piece.scores.any()


def test_search_edge_tables(spark, odd, empty):
    items = odd.select(F.col("doc_id").alias("item_id"), "text", "term", "score", "rank", "item")
    got = ranked.search_documents(odd, items, 3)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert found(got) == rank_plainly([tuple(r)[:2] for r in ODD], ODD, 3)
    same = [r for r in found(got) if r[0] == 6]
    assert [r[2] for r in same] == [6, 6, 6, 6, 7, 7]  # two equal items, two equal documents
    assert ranked.search_documents(empty, items, 3).count() == 0
    assert ranked.search_documents(odd, items.limit(0), 3).count() == 0


def test_one_item_of_a_third_of_all_rows_is_split(spark, monkeypatch):
    monkeypatch.setattr(ranked, "BLOCK_ITEMS", 10)
    items = spark.createDataFrame([(1, "alpha beta")] * 40, "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha"), (2, "gamma"), (3, "beta gamma")], "doc_id long, text string")
    sizes = []
    plain = ranked.best_by_task
    monkeypatch.setattr(ranked, "best_by_task", lambda index, items, *a: sizes.append(len(items)) or plain(index, items, *a))
    assert ranked.search_documents(docs, items, 10).count() == 80
    assert sum(sizes) == 40 and max(sizes) < 30


# --- pieces -----------------------------------------------------------------------------


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(" ▁\n\tabethoñ<>0x日😀İ\x00"), max_size=150) | st.text(max_size=60))
def test_pieces_equal_the_library(text):
    import sentencepiece

    coder = pieces.merger(tokenizer("piece_bpe_32k.model"))
    library = coder.model
    assert isinstance(library, sentencepiece.SentencePieceProcessor)
    text = text.encode(errors="replace").decode()
    want = library.encode(text)
    assert coder.encode([text]) == [[*want, library.eos_id()]]
    if text:
        assert pieces.unpacked([coder.alone("▁" + text.replace(" ", "▁"))]) == want


def test_pieces_of_documents(spark, model):
    texts = {r["doc_id"]: r["text"] or "" for r in documents(spark).collect()}
    for row in pieces.encode_pieces(documents(spark), tokenizer("piece_bpe_32k.model"), ids=True).collect():
        want = model.encode(texts[row["doc_id"]], add_eos=True)
        assert row["ids"] == want and row["n_tokens"] == len(want) and row["decoded"] == model.decode(want)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(model.decode(want).encode()).hexdigest()


def test_pieces_forget_and_learn_again(monkeypatch, model):
    monkeypatch.setattr(pieces, "REMEMBERED", 5)
    coder = pieces.Merger(tokenizer("piece_bpe_32k.model"))
    for text in ("one two three", "four five six seven eight nine", "one " + "x" * 200, "one two", LONG):
        assert coder.encode([text, text]) == [model.encode(text, add_eos=True)] * 2
        assert len(coder.known) <= 5


def test_a_difference_from_the_library_raises(monkeypatch):
    coder = pieces.Merger(tokenizer("piece_bpe_32k.model"))
    monkeypatch.setattr(coder, "ids_of", lambda segments: [np.array([5], "<u4").tobytes()] * len(segments))
    with pytest.raises(AssertionError):
        coder.encode(["hello there"])


# --- runs -------------------------------------------------------------------------------


def plain_lyndon(c):
    return [next((j for j in range(i + 1, len(c)) if c[j:] < c[i:]), len(c)) - i for i in range(len(c))]


def plain_runs(c):
    out = set()
    for q in range(1, len(c) // 4 + 1):
        i = 0
        while i + q < len(c):
            j = i
            while j + q < len(c) and c[j] == c[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(6, 4 * q) and not any(c[i : i + size - d] == c[i + d : i + size] for d in range(1, q)):
                out.add((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


sequences = st.lists(st.integers(0, 3), max_size=12) | st.tuples(
    st.lists(st.integers(0, 2), max_size=5), st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 7), st.lists(st.integers(0, 2), max_size=6)
).map(lambda x: [*x[0], *x[1] * x[2], *x[3]])


@settings(max_examples=400, deadline=None)
@given(sequences)
def test_lyndon_lengths_under_both_orders(c):
    assert periods.lyndon_lengths(np.array(c, np.int64)) == plain_lyndon(c)
    assert periods.lyndon_lengths(-np.array(c, np.int64)) == plain_lyndon([-x for x in c])


@settings(max_examples=400, deadline=None)
@given(st.lists(sequences, min_size=1, max_size=3))
def test_runs(parts):
    ends = np.cumsum([len(p) for p in parts])
    starts = ends - [len(p) for p in parts]
    got = periods.find_runs(np.array(sum(parts, []), np.int64), starts, ends).tolist()
    assert [tuple(r) for r in got] == [(s + a, n, q) for a, p in zip(starts.tolist(), parts) for s, n, q in plain_runs(p)]


def plain_row(doc_id, text, change=True):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if change and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else words[i] for i in range(n)]
    runs = plain_runs(words)
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    told = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
    return (doc_id, len(runs), *top, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


def test_runs_of_documents(spark):
    rows = documents(spark).collect()
    short = [r for r in rows if len((r["text"] or "").split()) < 400]
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periods"](spark, SF).collect()}
    assert len(got) == len(rows)
    changed = 0
    for r in short:
        assert got[r["doc_id"]] == plain_row(r["doc_id"], r["text"])
        changed += got[r["doc_id"]][1] > 0
    assert changed > 5


def test_overlapping_runs_and_ties(spark):
    texts = ["a a a a a a b b b b b b", "x y x y x y x y x x x x x x", "a b c " * 4, "a b c a b c a b c a b", "a a a a a", "a b " * 4]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in periods.periodic_runs(docs, text=True).collect()}
    for i, t in enumerate(texts):
        assert tuple(got[i])[:8] == plain_row(i, t, False)
    assert (got[0]["start"], got[0]["n_runs"], got[0]["text"]) == (0, 2, "a b")
    assert [got[i]["n_runs"] for i in (2, 3, 4, 5)] == [1, 0, 0, 1]


@pytest.mark.parametrize("op", ["pieces", "periods"])
def test_edge_tables(spark, odd, empty, op):
    fn = {"pieces": lambda d: pieces.encode_pieces(d, tokenizer("piece_bpe_32k.model")), "periods": lambda d: periods.periodic_runs(d, periods.recur)}[op]
    rows = fn(odd).collect()
    assert sorted((str(r["doc_id"]) for r in rows)) == sorted(str(d) for d, _ in ODD)
    assert fn(empty).count() == 0
    if op == "pieces":
        assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    else:
        assert {r["n_runs"] for r in rows if r["doc_id"] in (1, 2, 3)} == {0}
        assert [tuple(r) for r in rows if r["doc_id"] == 8] == [plain_row(8, dict(ODD)[8])]
        assert all(r["runs_sha256"] and r["collapsed_sha256"] for r in rows)
