"""Exact substring dedup by difference-cover anchors.

A window of ``length`` words repeats if its word sequence also starts anywhere
else. Residues of a difference cover modulo a period p hold, for any two
positions, an offset below p that brings both onto covered residues. So hashes
of shorter windows (``length - p + 1`` words) at covered positions only are
enough: two equal windows share an anchor that is aligned in both. Anchors seen
twice are then extended: every window of full length that holds one is compared
by a 128-bit hash.

Hashes travel packed: a task sends each of its distinct hashes once per batch
of documents, grouped into buckets by their top bits. So a passage that a third
of all documents share costs a bucket one entry per batch, and a bucket
answers each batch with those of its hashes that repeat. Documents meet their
answers in batches of bounded text; the text itself is shuffled once, and once
more only where a document has a candidate.

Null text has no words, and stays null. A document of fewer than ``length``
words loses nothing. Repeated rows are documents of their own, so each makes
the other a repeat. All columns are kept, but for those of the names of the
results, which these replace. An empty table gives an empty one."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.runtime import materialise

LENGTH = 35
#: Perfect difference covers, by period.
COVERS = {7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (3, 6, 7, 12, 14)}
#: Characters of text in a batch, and anchors in a bucket, on average.
BATCH_CHARS = 6_000_000
BUCKET_HASHES = 1_000_000
#: Distinct words that a task remembers.
REMEMBERED = 300_000

EMPTY = np.zeros(0, "u8")


def cover_for(length: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves anchors of a third of the window or more."""
    fits = [p for p in COVERS if p - 1 <= length * 2 // 3]
    return (max(fits), COVERS[max(fits)]) if fits else (1, (0,))


class WordHashes:
    """Words of texts as rows of a table of two 64-bit hashes."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.clear()

    def clear(self):
        self.known.clear()
        self.one, self.two = np.zeros(1024, "u8"), np.zeros(1024, "u8")

    def ids(self, words: list[bytes]) -> np.ndarray:
        import xxhash

        known = self.known
        new = [w for w in set(words) if w not in known]
        at = len(known)
        if at + len(new) > len(self.one):
            size = 2 * (at + len(new))
            self.one, self.two = (np.concatenate([x[:at], np.zeros(size - at, "u8")]) for x in (self.one, self.two))
        for k, w in enumerate(new, at):
            known[w] = k
            digest = xxhash.xxh3_128_intdigest(w)
            self.one[k], self.two[k] = digest & 0xFFFFFFFFFFFFFFFF, digest >> 64
        return np.fromiter(map(known.__getitem__, words), "i4", len(words))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(max(n, 1), np.uint64(base), "u8")
    out[0] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over all 64 (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Rolling:
    """Hashes of windows of a word sequence, from prefix sums."""

    def __init__(self):
        self.up = [powers(b, 1) for b in BASES]
        self.down = [powers(pow(b, -1, 1 << 64), 1) for b in BASES]

    def windows(self, hashes: np.ndarray, width: int, which: int) -> np.ndarray:
        n = len(hashes)
        if n < width:
            return EMPTY
        if len(self.up[which]) < n:
            self.up[which] = powers(BASES[which], 2 * n)
            self.down[which] = powers(pow(BASES[which], -1, 1 << 64), 2 * n)
        sums = np.zeros(n + 1, "u8")
        np.cumsum(hashes * self.up[which][:n], out=sums[1:])
        return mixed((sums[width:] - sums[:-width]) * self.down[which][: n - width + 1])


class Texts:
    """Anchors and windows of one document after another."""

    def __init__(self, length: int):
        self.length = length
        self.period, residues = cover_for(length)
        self.width = length - self.period + 1
        self.covered = np.isin(np.arange(self.period), residues)
        self.words, self.rolling = WordHashes(), Rolling()

    def hashes(self, text) -> tuple[list[bytes], np.ndarray]:
        words = text.encode().split() if text else []  # bytes split at exactly \\x20 and \\x09-\\x0D
        if len(self.words.known) > REMEMBERED:
            self.words.clear()
        return words, self.words.ids(words)

    def anchors(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes, of documents that hold a whole window."""
        if len(ids) < self.length:
            return np.zeros(0, "i8"), EMPTY
        at = np.flatnonzero(np.resize(self.covered, len(ids) - self.width + 1))
        return at, self.rolling.windows(self.words.one[ids], self.width, 0)[at]

    def starts(self, n: int, anchors: np.ndarray) -> np.ndarray:
        """Starts of all windows in n words that hold one of the anchors."""
        edge = np.zeros(n + 1, "i8")
        np.add.at(edge, np.maximum(anchors - self.period + 1, 0), 1)
        np.add.at(edge, np.minimum(anchors, n - self.length) + 1, -1)
        return np.flatnonzero(np.cumsum(edge[: n - self.length + 1]) > 0)

    def full(self, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """128-bit hashes of full windows, as pairs."""
        both = [self.rolling.windows(h[ids], self.length, k)[starts] for k, h in enumerate((self.words.one, self.words.two))]
        return np.stack(both, axis=1)


def packed(batch: int, keys: np.ndarray, buckets: int):
    """Rows (bucket, batch, once, more): sorted hashes (n, words) that the
    batch has once, and those that it has more than once."""
    if not len(keys):
        return
    keys = keys.reshape(len(keys), -1)
    order = np.lexsort(keys.T[::-1])
    keys = keys[order]
    first = np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)]
    counts = np.diff(np.r_[np.flatnonzero(first), len(keys)])
    keys = keys[first]
    # the top 32 bits, spread over the buckets in order
    bucket = ((keys[:, 0] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    for a, b in zip(cuts, [*cuts[1:], len(keys)]):
        once = counts[a:b] == 1
        yield int(bucket[a]), batch, keys[a:b][once].tobytes(), keys[a:b][~once].tobytes()


def keys_of(blobs, words: int) -> np.ndarray:
    """Hashes of many blobs, as rows of ``words`` 64-bit parts."""
    return np.frombuffer(b"".join(blobs), "u8").reshape(-1, words)


class KeySet:
    """A set of hashes that is sorted once and then looked up."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys[np.lexsort(keys.T[::-1])]
        lead = self.keys[:, 0]
        runs = np.diff(np.r_[np.flatnonzero(np.r_[True, lead[1:] != lead[:-1]]), len(lead)]) if len(lead) else [0]
        self.longest = int(max(runs))  # rows of one first part: 1, but for a collision

    def has(self, keys: np.ndarray) -> np.ndarray:
        hit = np.zeros(len(keys), bool)
        if len(self.keys):
            at = np.searchsorted(self.keys[:, 0], keys[:, 0])
            for step in range(self.longest):
                there = np.minimum(at + step, len(self.keys) - 1)
                hit |= (self.keys[there] == keys).all(axis=1)
        return hit


def repeats(sent: DataFrame, words: int) -> DataFrame:
    """For (bucket, batch, once, more) the hashes of each batch that occur at
    least twice anywhere: batch, blob (of first parts: a batch looks up its own
    windows only, in which 64 bits tell them apart)."""

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        blobs = [*frame["once"], *frame["more"]]
        sizes = np.array([len(x) // (8 * words) for x in blobs])
        keys = keys_of(blobs, words)
        if not len(keys):
            return pd.DataFrame({"batch": [], "blob": []})
        weight = np.repeat(np.r_[np.ones(len(frame), "i8"), np.full(len(frame), 2)], sizes)
        order = np.lexsort(keys.T[::-1])
        there = keys[order]
        first = np.r_[True, (there[1:] != there[:-1]).any(axis=1)]
        starts = np.flatnonzero(first)
        times = np.add.reduceat(weight[order], starts)
        twice = np.zeros(len(keys), bool)
        twice[order] = (times > 1)[np.cumsum(first) - 1]
        ends = np.r_[0, np.cumsum(sizes)]
        n, out = len(frame), []
        for k, batch in enumerate(frame["batch"]):
            parts = [keys[a:b][twice[a:b]] for a, b in ((ends[k], ends[k + 1]), (ends[n + k], ends[n + k + 1]))]
            if len(parts[0]) + len(parts[1]):
                out.append((batch, np.concatenate(parts)[:, 0].tobytes()))
        return pd.DataFrame(out, columns=["batch", "blob"])

    return sent.groupBy("bucket").applyInPandas(answer, "batch long, blob binary")


def spans_kept(text: str, gone: np.ndarray) -> str:
    """The text without the words marked gone; each goes with the blanks after it."""
    raw, out, last = text.encode(), [], 0
    for drop, word in zip(gone, re.finditer(rb"[^\x20\x09-\x0d]+[\x20\x09-\x0d]*", raw)):
        if drop:
            out.append(raw[last : word.start()])
            last = word.end()
    out.append(raw[last:])
    return b"".join(out).decode()


SENT = "bucket int, batch long, once binary, more binary"


def digest(text: str | None, gone: np.ndarray | None) -> str:
    words = text.encode().split() if text else []
    kept = words if gone is None else [w for w, x in zip(words, gone) if not x]
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def remove_repeats(docs: DataFrame, length: int = LENGTH, digests: bool = True, new_text: bool = True) -> DataFrame:
    """``docs`` (with a column text) plus n_words and n_removed; with
    ``digests`` kept_sha256 of the kept words joined by one space; with
    ``new_text`` the text without the removed words, else no text. Other
    columns travel as Arrow under names of their own, so no value changes."""
    docs = docs.drop("n_words", "n_removed", "kept_sha256")
    size = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    batches = max(1, -(-size // BATCH_CHARS))
    buckets = max(1, size // (20 * BUCKET_HASHES))
    fields = [f for f in docs.schema.fields if f.name != "text"]
    carried = [f"_c{k}" for k in range(len(fields))]
    keyed = docs.select(*[F.col(f"`{f.name}`").alias(c) for f, c in zip(fields, carried)], "text")
    keyed = keyed.withColumn("_batch", F.pmod(F.xxhash64(*carried[:1], "text"), F.lit(batches)))

    def anchors(frames):
        texts = Texts(length)
        for frame in frames:
            held: dict[int, list[np.ndarray]] = {}
            for batch, text in zip(frame["_batch"], frame["text"]):
                held.setdefault(batch, []).append(texts.anchors(texts.hashes(text)[1])[1])
            out = [row for batch, keys in held.items() for row in packed(batch, np.concatenate(keys), buckets)]
            yield pd.DataFrame(out, columns=["bucket", "batch", "once", "more"])

    found = repeats(keyed.select("_batch", "text").mapInPandas(anchors, SENT), 1)

    result = T.StructType([T.StructField(c, f.dataType) for f, c in zip(fields, carried)])
    if new_text:
        result.add("text", "string")
    result.add("n_words", "long").add("n_removed", "long")
    if digests:
        result.add("kept_sha256", "string")

    def results(rows: pa.Table, texts: list, n_words, gone: list) -> dict[str, pa.Array]:
        out = {c: rows[c] for c in carried}
        if new_text:
            new = [t if g is None or not g.any() else spans_kept(t, g) for t, g in zip(texts, gone)]
            out["text"] = pa.array(new, "string")
        out["n_words"] = pa.array(n_words, "int64")
        out["n_removed"] = pa.array([0 if g is None else int(g.sum()) for g in gone], "int64")
        if digests:
            out["kept_sha256"] = pa.array([digest(t, g) for t, g in zip(texts, gone)], "string")
        return out

    # a row is a finished document, a candidate (_starts and _raw too), or hashes (bucket, once, more)
    middle = T.StructType([*result.fields, *T.StructType.fromDDL("_batch long, _starts binary, _raw string").fields])
    middle = T.StructType([*middle.fields, *T.StructType.fromDDL("bucket int, once binary, more binary").fields])

    def extend(rows: pa.Table, answers: pa.Table) -> pa.Table:
        texts, twice = Texts(length), KeySet(keys_of(answers["blob"].to_pylist(), 1))
        raw, starts, n_words, full = rows["text"].to_pylist(), [], [], []
        for text in raw:
            words, ids = texts.hashes(text)
            n_words.append(len(words))
            at, hashes = texts.anchors(ids)
            at = at[twice.has(hashes[:, None])]
            starts.append(texts.starts(len(words), at) if len(at) else None)
            if len(at):
                full.append(texts.full(ids, starts[-1]))
        # what a candidate has in the end is not known yet
        shown = [t if s is None else None for t, s in zip(raw, starts)]
        out = results(rows, shown, n_words, [None] * len(raw))
        out["_batch"] = rows["_batch"]
        out["_starts"] = pa.array([None if s is None else s.astype("<i8").tobytes() for s in starts], "binary")
        out["_raw"] = pa.array([None if s is None else t for s, t in zip(starts, raw)], "string")
        for name, kind in (("bucket", "int32"), ("once", "binary"), ("more", "binary")):
            out[name] = pa.nulls(len(raw), kind)
        documents = pa.table(out)
        if not full:
            return documents
        sent = list(zip(*packed(rows["_batch"][0].as_py(), np.concatenate(full), buckets)))
        own = dict(zip(("bucket", "_batch", "once", "more"), sent))
        hashes = [
            pa.array(own[f.name], f.type) if f.name in own else pa.nulls(len(sent[0]), f.type) for f in documents.schema
        ]
        return pa.concat_tables([documents, pa.Table.from_arrays(hashes, schema=documents.schema)])

    def own_names(rows: DataFrame) -> DataFrame:
        told = dict(zip(carried, (f.name for f in fields)))
        return rows.select(*[F.col(c).alias(told.get(c, c)) for c in result.names])

    met = keyed.groupBy("_batch").cogroup(found.withColumnRenamed("batch", "_batch").groupBy("_batch"))
    middle_rows = materialise(met.applyInArrow(extend, middle), "substrings", texts=True)
    done = own_names(middle_rows.where("bucket is null and _starts is null"))
    candidates = middle_rows.where("_starts is not null").select(*carried, "n_words", "_batch", "_starts", "_raw")
    sent = middle_rows.where("bucket is not null").select("bucket", F.col("_batch").alias("batch"), "once", "more")
    if candidates.isEmpty():
        return done
    verdicts = repeats(sent, 2).withColumnRenamed("batch", "_batch")

    def decide(rows: pa.Table, answers: pa.Table) -> pa.Table:
        texts, twice = Texts(length), KeySet(keys_of(answers["blob"].to_pylist(), 1))
        raw, gone = rows["_raw"].to_pylist(), []
        for text, blob in zip(raw, rows["_starts"].to_pylist()):
            starts = np.frombuffer(blob, "<i8")
            words, ids = texts.hashes(text)
            hit = starts[twice.has(texts.full(ids, starts)[:, :1])]
            edge = np.zeros(len(words) + 1, "i8")
            np.add.at(edge, hit, 1)
            np.add.at(edge, hit + length, -1)
            gone.append(np.cumsum(edge[:-1]) > 0)
        return pa.table(results(rows, raw, rows["n_words"].to_pylist(), gone))

    ended = candidates.groupBy("_batch").cogroup(verdicts.groupBy("_batch")).applyInArrow(decide, result)
    return done.unionByName(own_names(ended))
