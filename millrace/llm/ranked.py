"""Ranked lexical search, term at a time with limited accumulators.

Two jobs for every block of items (stated queries). The first reads all texts
once and keeps, for each document, how often it has the block's terms: a forward index,
written to the shared folder. Its totals give the weights of the terms. The second
scores that index in pieces of ``PIECE`` postings: for each item, terms come rarest
first, a posting adds to the accumulator of its document, and as soon as the best
that the remaining terms can add lies below the k-th score so far, no document gets a
new accumulator; those that have one are updated to the end, so their scores are exact.
The best k of earlier pieces of the task count for the k-th score.
A task sends at most k rows an item, which are ranked in two steps.

Documents without a term (null and empty texts too) are in no total and no ranking.
Very long texts are read whole. Equal scores rank by ascending doc_id, null last;
repeated rows are documents of their own, rows of one doc_id in any order among
themselves. An item without terms, or of which no document scores above 0, has no
rows; items of equal item_id are ranked each by itself. Empty tables give no rows.
Only doc_id, text, item_id and text are read, so other columns may have any name."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.runtime import materialise

#: Terms and items of one block of items (in the mean; a block is never less than one
#: item): what the driver and every task hold of the items.
BLOCK_TERMS, BLOCK_ITEMS = 100_000, 10_000
#: Postings and documents that are scored at once.
PIECE, PIECE_DOCS = 1_000_000, 20_000
#: A document's length counts for so many per cent, in units of the mean length.
LENGTH_SHARE = 90
NULL_ID = 2**63 - 1
#: Every byte that is in no term becomes a blank, A to Z become small letters.
LETTERS = bytes(
    b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    """Maximal runs of ASCII letters, digits and characters beyond ASCII."""
    return text.translate(LETTERS).split() if text else []


@dataclass
class Totals:
    """What the weights are made of: documents with a term, terms of all
    documents, and for each term of the block the documents that hold it."""

    docs: int
    terms: int
    holding: np.ndarray

    def weights(self) -> np.ndarray:
        top = 2 * self.docs + 2
        return np.array([math.floor(1000 * math.log(top / (2 * n + 1))) for n in self.holding.tolist()], np.int64)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: by descending score, then ascending id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


class Piece:
    """Postings of some documents, by term, with what each adds to a score."""

    def __init__(self, doc_ids: np.ndarray, sizes: np.ndarray, terms: np.ndarray, times: np.ndarray, doc_terms: np.ndarray, totals: Totals, weights: np.ndarray):
        self.ids = doc_ids
        doc = np.repeat(np.arange(len(doc_ids)), sizes)
        long = 100 - LENGTH_SHARE + (LENGTH_SHARE * doc_terms * totals.docs) // max(totals.terms, 1)
        adds = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 8 * long[doc]))
        order = np.argsort(terms, kind="stable")
        self.doc, self.adds, terms = doc[order], adds[order], terms[order]
        self.starts = np.searchsorted(terms, np.arange(len(weights) + 1))
        some = self.starts[1:] > self.starts[:-1]
        self.most = np.zeros(len(weights), np.int64)
        if len(terms):
            self.most[some] = np.maximum.reduceat(self.adds, self.starts[:-1][some])
        self.scores = np.zeros(len(doc_ids), np.int64)

    def search(self, item: np.ndarray, k: int, beaten: int) -> tuple[np.ndarray, np.ndarray]:
        """Best k documents (places, scores) for terms that come rarest first.
        ``beaten``: a score that k documents elsewhere reach already."""
        scores = self.scores
        item = item[self.starts[item + 1] > self.starts[item]]
        left = np.cumsum(self.most[item][::-1])[::-1].tolist()
        seen: list[np.ndarray] = []
        open_ = True
        have = np.zeros(0, np.int64)
        for t, rest in zip(item.tolist(), left):
            docs, adds = self.doc[self.starts[t] : self.starts[t + 1]], self.adds[self.starts[t] : self.starts[t + 1]]
            if open_:
                if len(seen) and len(have) + sum(len(x) for x in seen) >= k:
                    have = np.unique(np.concatenate([have, *seen]))
                    seen = []
                kth = beaten
                if len(have) >= k:
                    now = scores[have]
                    kth = max(kth, int(np.partition(now, len(now) - k)[len(now) - k]))
                if rest < kth:  # a document of the remaining terms alone cannot come in
                    open_ = False
                    have = np.unique(np.concatenate([have, *seen]))
                    seen = []
            if open_:
                scores[docs] += adds
                seen.append(docs)
            else:
                live = scores[docs] > 0
                scores[docs[live]] += adds[live]
        have = np.unique(np.concatenate([have, *seen]))
        found = scores[have]
        scores[have] = 0
        above = found > 0
        have, found = have[above], found[above]
        pick = best_of(found, self.ids[have], k)
        return have[pick], found[pick]


def forward_index(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (terms of the document), terms and times: which terms of the
    vocabulary it has, and how often. Documents without any term are left out."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])

    def run(batches):
        look = vocabulary.get
        for batch in batches:
            ids, counts, terms, times = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms_of(text.as_py())
                if words:
                    found = Counter(map(look, words))
                    found.pop(None, None)
                    ids.append(doc_id)
                    counts.append(len(words))
                    terms.append(list(found))
                    times.append(list(found.values()))
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((ids, counts, terms, times), schema)], schema=schema)

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"))
    return plain.mapInArrow(run, "doc_id long, n long, terms array<int>, times array<int>")


def totals_of(index: DataFrame, size: int) -> Totals:
    """Sums over the index. What comes to the driver is one number a term of the
    block."""
    sums = index.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = index.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n")).toArrow()
    holding = np.zeros(size, np.int64)
    holding[counts.column("term").to_numpy()] = counts.column("n").to_numpy()
    return Totals(sums[0], sums[1], holding)


def best_by_task(index: DataFrame, items: list[np.ndarray], totals: Totals, k: int) -> DataFrame:
    """item (place in ``items``), doc_id, score: the best k of every task."""
    weights = totals.weights()
    # rarest first; terms that weigh nothing add nothing
    ordered = [i[np.lexsort((i, -weights[i]))] for i in items]
    ordered = [i[weights[i] > 0] for i in ordered]
    schema = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])

    def pieces(batches):
        held, postings, docs = [], 0, 0
        for batch in batches:
            # a batch may hold more than a piece: cut it by its own postings
            sizes = np.cumsum(np.asarray(batch.column("terms").value_lengths(), np.int64)) if batch.num_rows else np.zeros(0, np.int64)
            at = 0
            while at < batch.num_rows:
                base = sizes[at - 1] if at else 0
                upto = max(at + 1, int(np.searchsorted(sizes, base + PIECE - postings, side="right")))
                upto = min(upto, at + PIECE_DOCS - docs, batch.num_rows)
                held.append(batch.slice(at, upto - at))
                postings, docs, at = postings + int(sizes[upto - 1] - base), docs + upto - at, upto
                if postings >= PIECE or docs >= PIECE_DOCS or at < batch.num_rows:
                    yield pa.Table.from_batches(held).combine_chunks()
                    held, postings, docs = [], 0, 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks()

    def run(batches):
        best_ids = [np.zeros(0, np.int64)] * len(ordered)
        best_scores = list(best_ids)
        for table in pieces(batches):
            if not table.num_rows:
                continue
            terms = table.column("terms").combine_chunks()
            ids = table.column("doc_id").fill_null(NULL_ID).to_numpy()
            piece = Piece(
                ids,
                np.asarray(terms.value_lengths(), np.int64),
                np.asarray(terms.flatten(), np.int64),
                np.asarray(table.column("times").combine_chunks().flatten(), np.int64),
                table.column("n").to_numpy(),
                totals,
                weights,
            )
            for j, item in enumerate(ordered):
                beaten = int(best_scores[j][-1]) if len(best_scores[j]) == k else 0
                where, found = piece.search(item, k, beaten)
                if len(where):
                    all_ids, all_scores = np.concatenate([best_ids[j], ids[where]]), np.concatenate([best_scores[j], found])
                    pick = best_of(all_scores, all_ids, k)
                    best_ids[j], best_scores[j] = all_ids[pick], all_scores[pick]
        found = np.concatenate([np.zeros(0, np.int64), *best_ids])
        columns = [
            pa.array(np.repeat(np.arange(len(ordered)), [len(x) for x in best_ids]), pa.int32()),
            pa.array(found, pa.int64(), mask=found == NULL_ID),
            pa.array(np.concatenate([np.zeros(0, np.int64), *best_scores]), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return index.mapInArrow(run, "item int, doc_id long, score long")


def ranked(found: DataFrame, k: int, fan_in: int = 64) -> DataFrame:
    """The best k of each item, first among ``fan_in`` tasks, then of all, so that
    no task sees all rows of an item."""
    by = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.expr(f"spark_partition_id() div {int(fan_in)}")
    some = found.withColumn("_part", part)
    place = F.row_number().over(Window.partitionBy("item", "_part").orderBy(*by))
    some = some.withColumn("rank", place).where(F.col("rank") <= k).drop("rank", "_part")
    place = F.row_number().over(Window.partitionBy("item").orderBy(*by))
    return some.withColumn("rank", place).where(F.col("rank") <= k)


def search_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k best documents of each item
    with a score above 0."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    named = items.select("item_id", F.col("text").cast("binary").alias("text"), F.monotonically_increasing_id().alias("_row"))
    named = materialise(named, "items")
    # items are told by their place in a block; equal rows have a place, and a block, each
    size = named.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("c")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-size["c"] // (8 * BLOCK_TERMS)))
    named = named.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        rows = named.where(F.col("_block") == b).select("item_id", "text").toLocalIterator()
        vocabulary: dict[bytes, int] = {}
        ids, coded = [], []
        for row in rows:
            terms = dict.fromkeys(terms_of(bytes(row["text"]) if row["text"] is not None else None))
            if terms:
                ids.append(row["item_id"])
                coded.append(np.array([vocabulary.setdefault(t, len(vocabulary)) for t in terms], np.int64))
        if not ids:
            continue
        index = materialise(forward_index(docs, vocabulary), "forward-index")
        found = best_by_task(index, coded, totals_of(index, len(vocabulary)), k)
        names = spark.createDataFrame(list(enumerate(ids)), f"item int, item_id {kind.simpleString()}")
        # at most BLOCK_ITEMS names, k rows each
        part = ranked(materialise(found, "best-by-task"), k).join(F.broadcast(names), "item").drop("item")
        part = part.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return out
