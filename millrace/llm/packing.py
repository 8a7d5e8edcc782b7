"""Best-fit packing by swap-based local search.

Texts become token ids, ids are cut into pieces of at most ``limit`` ids, and
pieces share sequences of that length. Pieces are dealt into groups of about
``group_pieces`` by a stored number, so no group grows with the data. A group
is packed best fit first; then documents move, or are exchanged one for one or
two for one, between underfull bins as long as the squared fill grows, until
bins empty. Bins that stay loose are dealt into new groups and packed again,
while that saves bins.

Null text is an empty text: one piece that holds the end id alone. An empty
table gives no rows. Repeated rows are packed one by one. A text longer than
``limit`` gives full pieces, which have a sequence of their own."""

from __future__ import annotations

import json
import re
import zlib
from bisect import insort
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.bpe import FIRST_LETTER, bpe_model
from millrace.llm.common import map_exact, slices
from millrace.runtime import materialise

LIMIT = 2048
GROUP_PIECES = 20_000
#: Bins filled less than this are packed again with those of other groups.
LOOSE = 0.9
#: Words whose ids are remembered by a task.
REMEMBERED = 200_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Pre-tokens of lower-case Latin-1 text: letters, contractions, single digits, other runs.
LATIN = "[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|'s|'t|'re|'ve|'m|'ll|'d|[0-9\xb2\xb3\xb9\xbc-\xbe]|[^ \t-\r\x85\xa0a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+"


def printable_bytes() -> dict[str, int]:
    """The byte behind each character of a byte-level vocabulary: printable
    Latin-1 stands for itself, the others follow from U+0100 on in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class WordIds:
    """Token ids of texts, as little-endian bytes, equal to the tokenizer's.

    Latin-1 text: its pre-tokens are cut here and encoded by a sentencepiece
    model of the same merges (score: minus the merge's rank, the last byte of a
    word has letters of its own). That gives the same merges if every token,
    encoded by the merges before its own, ends as the pair of its merge; tests
    check it for the vocabulary in use. Other text goes to the tokenizer by
    chunks between blanks, which no token spans. Both are remembered."""

    chunks = staticmethod(re.compile(r"[^ \t\n\r]+").findall)
    latin = staticmethod(re.compile(LATIN).findall)

    def __init__(self, tokenizer_path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece

        self.path, self._tokenizer = tokenizer_path, None
        with open(tokenizer_path, encoding="utf-8") as file:
            spec = json.load(file)
        model, self.specials = spec["model"], [t["content"] for t in spec.get("added_tokens", [])]
        byte_of, end = printable_bytes(), model["end_of_word_suffix"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        rank = {a + b: -float(n) for n, (a, b) in enumerate(merges)}
        pieces, ids = [], []
        for token, i in sorted(model["vocab"].items(), key=lambda x: x[1]):
            body, last = (token[: -len(end)], 256) if token.endswith(end) and token != end else (token, 0)
            if token in self.specials or not body or any(c not in byte_of for c in body):
                continue
            if len(body) > 1 and token not in rank:
                continue
            letters = [chr(FIRST_LETTER + byte_of[c]) for c in body]
            letters[-1] = chr(ord(letters[-1]) + last)
            pieces.append(("".join(letters), rank.get(token, -float(len(merges)))))
            ids.append(i)
        self.letters = [chr(FIRST_LETTER + b) for b in range(256)]
        self.last = [chr(FIRST_LETTER + 256 + b) for b in range(256)]
        self.ids = np.array(ids, "<u4")
        self.model = sentencepiece.SentencePieceProcessor(model_proto=bpe_model(pieces))
        self.words: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}

    @property
    def tokenizer(self):
        if self._tokenizer is None:
            from tokenizers import Tokenizer

            self._tokenizer = Tokenizer.from_file(self.path)
        return self._tokenizer

    def _new(self, words: list[list[str]], known: dict[str, bytes]) -> list[str]:
        have = set().union(*words)
        new = [w for w in have if w not in known]
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list(have)
        return new

    def _latin(self, texts: list[str]) -> list[bytes]:
        cut = [self.latin(t.lower()) for t in texts]
        letters, last, known = self.letters, self.last, self.words
        new = self._new(cut, known)
        raw = [w.encode() for w in new]
        coded = self.model.encode(["".join([letters[b] for b in r[:-1]]) + last[r[-1]] for r in raw], num_threads=1) if raw else []
        flat = self.ids[np.fromiter((i for x in coded for i in x), "i8")].tobytes()
        at = 0
        for w, x in zip(new, coded):
            known[w] = flat[at : (at := at + 4 * len(x))]
        return [b"".join([known[w] for w in words]) for words in cut]

    def _other(self, texts: list[str]) -> list[bytes]:
        cut = [self.chunks(t) for t in texts]
        new = self._new(cut, self.others)
        for at in range(0, len(new), 2000):
            part = new[at : at + 2000]
            for w, got in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False)):
                self.others[w] = np.array(got.ids, "<u4").tobytes()
        return [b"".join([self.others[w] for w in words]) for words in cut]

    def _plain(self, text: str) -> bool:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(s in text for s in self.specials)

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [self._plain(t) for t in texts]
        latin = iter(self._latin([t for t, p in zip(texts, plain) if p]))
        other = iter(self._other([t for t, p in zip(texts, plain) if not p]))
        return [next(latin) if p else next(other) for p in plain]


def token_pieces(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT, end_id: int = 0) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 for every piece of every text."""
    end = end_id.to_bytes(4, "little")

    def encode(batches):
        word_ids = WordIds(tokenizer_path)
        for batch in batches:
            out = []
            encoded = (ids + end for run in slices(batch["text"]) for ids in word_ids.encode(run))
            for doc_id, ids in zip(batch["doc_id"], encoded):
                for piece, at in enumerate(range(0, len(ids), 4 * limit)):
                    part = ids[at : at + 4 * limit]
                    out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield frame.astype({"doc_id": "Int64"})

    return map_exact(docs.select("doc_id", "text"), encode, PIECES)


class Bins:
    """Bins of one group: item sizes, free space, and bins by free space."""

    def __init__(self, sizes: np.ndarray, limit: int):
        self.sizes, self.limit = [int(x) for x in sizes], limit
        self.items: list[list[int]] = []
        self.free: list[int] = []
        self.by_free: list[list[int]] = [[] for _ in range(limit + 1)]
        self.mask = 0  # bit f is set where by_free[f] has a bin

    def put(self, b: int, free: int) -> None:
        self.free[b] = free
        insort(self.by_free[free], b)
        self.mask |= 1 << free

    def take(self, b: int) -> None:
        same = self.by_free[self.free[b]]
        same.remove(b)
        if not same:
            self.mask &= ~(1 << self.free[b])

    def tightest(self, size: int) -> int | None:
        """The bin with the least free space that is enough."""
        rest = self.mask >> size
        return self.by_free[size + (rest & -rest).bit_length() - 1][0] if rest else None

    def fill(self) -> None:
        """Best fit, largest first."""
        for i in sorted(range(len(self.sizes)), key=lambda i: -self.sizes[i]):
            size = self.sizes[i]
            b = self.tightest(size)
            if b is None:
                b = len(self.items)
                self.items.append([i])
                self.free.append(0)
                self.put(b, self.limit - size)
            else:
                self.take(b)
                self.items[b].append(i)
                self.put(b, self.free[b] - size)

    def give(self, source: int, outs: list[int], b: int, back: list[int]) -> None:
        """Items ``outs`` of ``source`` against items ``back`` of bin ``b``."""
        gain = sum(self.sizes[i] for i in outs) - sum(self.sizes[i] for i in back)
        self.take(b)
        self.items[b] = [i for i in self.items[b] if i not in back] + outs
        self.put(b, self.free[b] - gain)
        self.items[source] = [i for i in self.items[source] if i not in outs] + back
        self.free[source] += gain

    def empty_one(self, source: int) -> bool:
        """Moves and exchanges that make other bins fuller and ``source``
        emptier; every step raises the sum of squared fills, because it goes
        from the emptiest bin to one that ends up fuller than both were."""
        self.take(source)
        while self.items[source]:
            if not self._step(source):
                self.put(source, self.free[source])
                return False
        self.free[source] = self.limit
        return True

    def pairs(self, items: list[int]) -> list[list[int]]:
        """One pair of items for every sum of two sizes."""
        by_size: dict[int, list[int]] = {}
        for i in items:
            by_size.setdefault(self.sizes[i], []).append(i)
        sizes, out = sorted(by_size, reverse=True), {}
        for n, x in enumerate(sizes):
            if len(by_size[x]) > 1:
                out.setdefault(2 * x, by_size[x][:2])
            for y in sizes[n + 1 :]:
                out.setdefault(x + y, [by_size[x][0], by_size[y][0]])
        return list(out.values())

    def _step(self, source: int) -> bool:
        mine = sorted(self.items[source], key=lambda i: -self.sizes[i])
        for i in mine:
            b = self.tightest(self.sizes[i])
            if b is not None:
                self.give(source, [i], b, [])
                return True
        bins = [b for f in range(1, self.limit + 1) if self.mask >> f & 1 for b in self.by_free[f]]
        if not bins:
            return False
        owner = np.array([b for b in bins for _ in self.items[b]])
        item = np.array([i for b in bins for i in self.items[b]])
        size = np.array([self.sizes[i] for i in item])
        room = size + np.array(self.free)[owner]
        rest = self.limit - self.free[source]
        for out in [[i] for i in mine] + self.pairs(mine):  # one for one, two for one
            x = sum(self.sizes[i] for i in out)
            left = room - x
            # the other bin must end up fuller than this one was before
            ok = (size < x) & (left >= 0) & (self.limit - left > rest)
            if ok.any():
                k = int(np.flatnonzero(ok)[np.argmin(left[ok])])
                self.give(source, out, int(owner[k]), [int(item[k])])
                return True
        pairs = ((b, *p) for b in bins for p in self.pairs(self.items[b]))
        while block := list(islice(pairs, 100_000)):
            two = np.array([self.sizes[i] + self.sizes[j] for _, i, j in block])
            room = two + np.array([self.free[b] for b, _, _ in block])
            for i in mine:  # one for two
                left = room - self.sizes[i]
                ok = (two < self.sizes[i]) & (left >= 0) & (self.limit - left > rest)
                if ok.any():
                    k = int(np.flatnonzero(ok)[np.argmin(left[ok])])
                    b, p, q = block[k]
                    self.give(source, [i], b, [p, q])
                    return True
        return False

    def search(self, patience: int = 20) -> None:
        """Empties bins from the emptiest on; ends at the least number that
        the sizes allow, or when ``patience`` bins in a row stay."""
        used = sum(1 for x in self.items if x)
        least = -(-sum(self.sizes) // self.limit)
        kept: set[int] = set()
        while used > least and len(kept) < patience:
            source = next(
                (b for f in range(self.limit, 0, -1) if self.mask >> f & 1 for b in self.by_free[f] if b not in kept and self.items[b]),
                None,
            )
            if source is None:
                break
            if self.empty_one(source):
                used -= 1
                kept.clear()
            else:
                kept.add(source)


def pack_sizes(sizes, limit: int = LIMIT) -> np.ndarray:
    """The bin of each item, numbered from 0."""
    bins = Bins(np.asarray(sizes, "i8"), limit)
    bins.fill()
    bins.search()
    out = np.zeros(len(sizes), "i8")
    for n, items in enumerate(x for x in bins.items if x):
        out[items] = n
    return out


def pack(pieces: DataFrame, limit: int = LIMIT, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to ``pieces`` (any columns, with length)."""
    own = [f"`{c}`" for c in pieces.columns]
    pieces = materialise(pieces.withColumn("_uid", F.monotonically_increasing_id()), "pieces")
    full = pieces.where(F.col("length") == limit).select(*own, F.col("_uid").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    parts, level = [full], 1
    rest = pieces.where(F.col("length") < limit)
    before = None
    while True:
        n = rest.count()
        if not n:
            break
        groups = -(-n // group_pieces)
        schema = rest.select(*own, "_uid").schema.add("_bin", "long").add("offset", "long").add("_fill", "long")

        def pack_group(table: pa.Table) -> pa.Table:
            table = table.drop_columns("_group").sort_by("_uid")
            bins = pack_sizes(table["length"].to_numpy(), limit)
            order = np.argsort(bins, kind="stable")
            table, bins = table.take(order), bins[order]
            length, uid = table["length"].to_numpy(), table["_uid"].to_numpy()
            first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]])
            spread = lambda x: np.repeat(x, np.diff(np.r_[first, len(bins)]))
            start = np.cumsum(length) - length
            # a bin is named by its smallest piece number, which no other bin has
            more = {"_bin": spread(uid[first]), "offset": start - spread(start[first]), "_fill": spread(np.add.reduceat(length, first))}
            for name, values in more.items():
                table = table.append_column(name, pa.array(values, "int64"))
            return table

        dealt = rest.select(*own, "_uid", F.pmod(F.xxhash64("_uid", F.lit(level)), F.lit(groups)).alias("_group"))
        packed = materialise(dealt.groupBy("_group").applyInArrow(pack_group, schema), "packed")
        done = packed.select(*own, F.col("_bin").alias("sequence_id"), "offset", "_fill")
        loose = packed.where(F.col("_fill") < LOOSE * limit)
        bins = packed.select("_bin").distinct().count() if groups > 1 else 0
        if groups == 1 or (before is not None and bins >= before):
            parts.append(done.drop("_fill"))
            break
        parts.append(done.where(F.col("_fill") >= LOOSE * limit).drop("_fill"))
        rest, level = loose.select(*own, "_uid"), level + 1
        before = loose.select("_bin").distinct().count()
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, tokenizer_path: str, limit: int = LIMIT) -> DataFrame:
    """Every piece with its sequence_id and offset."""
    return pack(token_pieces(docs, tokenizer_path, limit), limit)
