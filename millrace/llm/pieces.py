"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

No piece of such a vocabulary has a blank sign behind another character, so no
merge crosses the place before a run of blank signs: a text is cut there, and
every segment is merged by itself. A segment starts as single characters; its
agenda holds the scores of all adjacent pairs that make a piece, the best one (the
leftmost of equals) is merged, and the pairs beside it are scored anew, until the
agenda is empty. The agendas of all new segments of a batch advance together, one
merge each; segments of more than ``WIDE`` characters have a heap each. Characters
that are no piece become their bytes.

New segments of every Arrow batch are also encoded by the sentencepiece library, and
a difference raises. Ids are decoded by the library.

Null text is an empty text: the end id alone. Very long texts are whole, a segment
of any length too. Equal scores go to the leftmost pair, as in the library. Repeated
rows give repeated results, an empty table none. Only doc_id and text are read, so
other columns may have any name; a null doc_id stays null."""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from millrace.llm.common import map_exact, slices

BLANK = "▁"
#: Segments whose ids are remembered by a worker, and the longest of them.
REMEMBERED, LONGEST = 600_000, 64
#: Agendas of up to so many characters advance together, in tables of these widths.
WIDTHS = (8, 16, 32, 64)
WIDE = WIDTHS[-1]
NEVER = np.int32(2**31 - 1)
#: Model kind of the protocol: merges.
BPE = 2
#: How ids are packed.
ID = np.dtype("<u4")


def model_fields(data: bytes, wanted: tuple[int, ...]) -> dict[int, object]:
    """The last value of each wanted field of a protocol buffer message."""
    found, at = {}, 0

    def number():
        nonlocal at
        n = shift = 0
        while True:
            n |= (data[at] & 127) << shift
            shift, at = shift + 7, at + 1
            if data[at - 1] < 128:
                return n

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            value = number()
        else:
            size = number() if kind == 2 else {1: 8, 5: 4}[kind]
            value, at = data[at : at + size], at + size
        if key >> 3 in wanted:
            found[key >> 3] = value
    return found


class Merger:
    """Ids of segments by the merges of one model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = model_fields(model.serialized_model_proto(), (2, 3))
        kind = model_fields(spec[2], (3,)).get(3)
        norm = model_fields(spec.get(3, b""), (2, 3, 4, 5))
        if kind != BPE or norm.get(2) or (norm.get(3, 1), norm.get(4, 1), norm.get(5, 1)) != (1, 0, 1):
            raise ValueError("the model must be of the merge type, with identity normalisation and a blank before the text")
        size = model.get_piece_size()
        self.bytes = {}
        pieces = {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif model.is_unused(i):
                raise ValueError("unused pieces are not supported")
            elif not (model.is_control(i) or model.is_unknown(i)):
                pieces[piece] = i
                if re.search(f"[^{BLANK}]{BLANK}", piece):
                    raise ValueError("a piece has a blank inside")
        if len(self.bytes) != 256:
            raise ValueError("the model must fall back on bytes")
        self.size, self.end = size, model.eos_id()
        symbols = dict(pieces)
        for char in sorted({c for piece in pieces for c in piece}):
            symbols.setdefault(char, size + len(symbols))
        self.symbols, self.pieces = symbols, pieces
        #: a symbol that is in no pair: unknown characters and the borders
        self.other = max([size, *symbols.values()]) + 1
        self.of_char = np.full(0x110000, self.other, np.int32)
        for text, symbol in symbols.items():
            if len(text) == 1:
                self.of_char[ord(text)] = symbol
        scores = {i: model.get_score(i) for i in pieces.values()}
        place = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {i: place[s] for i, s in scores.items()}
        pairs = [
            (symbols[p[:cut]] * (self.other + 1) + symbols[p[cut:]], self.rank[i], i)
            for p, i in pieces.items()
            for cut in range(1, len(p))
            if p[:cut] in symbols and p[cut:] in symbols
        ]
        keys, ranks, made = (np.array(x, np.int64) for x in zip(*sorted(pairs)))
        self.keys = np.append(keys, np.int64(2**62))
        self.ranks, self.made = np.append(ranks, NEVER).astype(np.int32), np.append(made, 0).astype(np.int32)
        self.names = [str(i) for i in range(size)]
        #: segment without its first blank sign: its packed ids
        self.known: dict[str, bytes] = {}

    def score(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and symbol of the piece that each pair makes; ``NEVER`` if none."""
        key = left.astype(np.int64) * (self.other + 1) + right
        at = np.searchsorted(self.keys, key)
        hit = self.keys[at] == key
        return np.where(hit, self.ranks[at], NEVER), self.made[at]

    def together(self, points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int) -> list[bytes]:
        """Packed ids of segments of at most ``width`` characters: one row each, with a
        border column on either side; every step merges the best pair of every row."""
        rows, wide = len(starts), width + 2
        inside = np.arange(width) < lengths[:, None]
        chars = np.zeros((rows, wide), np.uint32)
        chars[:, 1:-1][inside] = points[(starts[:, None] + np.arange(width))[inside]]
        symbol = np.full((rows, wide), self.other, np.int32)
        symbol[:, 1:-1][inside] = self.of_char[chars[:, 1:-1][inside]]
        agenda, made = np.full((rows, wide), NEVER), np.zeros((rows, wide), np.int32)
        first = np.zeros((rows, wide), bool)
        first[:, 1:-2] = inside[:, 1:]
        at = np.flatnonzero(first)
        symbols, scores, makes = symbol.ravel(), agenda.ravel(), made.ravel()
        scores[at], makes[at] = self.score(symbols[at], symbols[at + 1])
        alive = np.zeros(rows * wide, bool)
        alive.reshape(rows, wide)[:, 1:-1] = inside
        after = np.arange(rows * wide) + 1
        before = after - 2
        live = np.arange(rows)
        while True:
            at = agenda[live].argmin(axis=1) + live * wide
            some = scores[at] != NEVER
            live, at = live[some], at[some]
            if not len(live):
                break
            gone = after[at]
            right, left = after[gone], before[at]
            symbols[at] = makes[at]
            alive[gone], scores[gone] = False, NEVER
            after[at], before[right] = right, at
            scores[at], makes[at] = self.score(symbols[at], symbols[right])
            scores[left], makes[left] = self.score(symbols[left], symbols[at])
        packed = symbols[alive].astype(ID).tobytes()
        ends = (np.cumsum(alive.reshape(rows, wide).sum(axis=1)) * ID.itemsize).tolist()
        out = [packed[a:b] for a, b in zip([0, *ends], ends)]
        alive = alive.reshape(rows, wide)
        for r in np.flatnonzero(((symbol >= self.size) & alive).any(axis=1)).tolist():
            ids = []
            for s, c in zip(symbol[r][alive[r]].tolist(), chars[r][alive[r]].tolist()):
                ids.extend([s] if s < self.size else [self.bytes[b] for b in chr(c).encode(errors="surrogatepass")])
            out[r] = np.array(ids, ID).tobytes()
        return out

    def alone(self, segment: str) -> bytes:
        """Packed ids of one long segment by a heap of (rank, place); an entry whose two symbols
        have changed since is passed over."""
        n = len(segment)
        text, after, before = list(segment), list(range(1, n + 1)), list(range(-1, n - 1))
        pieces, rank, heap = self.pieces, self.rank, []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else n
            if j < n and (made := pieces.get(text[i] + text[j])) is not None:
                heapq.heappush(heap, (rank[made], i, j, len(text[i]), len(text[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, a, b = heapq.heappop(heap)
            if len(text[i]) != a or len(text[j]) != b or after[i] != j:
                continue
            text[i] += text[j]
            text[j] = ""
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(i)
            offer(before[i])
        out = []
        for t in text:
            if t:
                out.extend([pieces[t]] if t in pieces else [self.bytes[b] for b in t.encode(errors="surrogatepass")])
        return np.array(out, ID).tobytes()

    def ids_of(self, segments: list[str]) -> list[bytes]:
        """Packed ids of segments, each with its first blank sign."""
        lengths = np.array([len(s) for s in segments], np.int64)
        points = np.frombuffer("".join(segments).encode("utf-32-le", errors="surrogatepass"), np.uint32)
        starts = np.cumsum(lengths) - lengths
        out: list = [None] * len(segments)
        least = 0
        for width in WIDTHS:
            which = np.flatnonzero((lengths > least) & (lengths <= width))
            least = width
            if len(which):
                for k, ids in zip(which.tolist(), self.together(points, starts[which], lengths[which], width)):
                    out[k] = ids
        for k in np.flatnonzero((lengths == 0) | (lengths > WIDE)).tolist():
            out[k] = self.alone(segments[k])
        return out

    def learn(self, new: list[str]) -> dict[str, bytes]:
        """Packed ids of new segments (without their first blank sign), checked
        against the library, which puts that sign before any text but an empty one."""
        found = self.ids_of([BLANK + s for s in new])
        full = [k for k, s in enumerate(new) if s]
        theirs = self.model.encode([new[k] for k in full], num_threads=1)
        ours = [found[k] for k in full]
        if [len(x) for x in theirs] != [len(x) // ID.itemsize for x in ours] or list(chain.from_iterable(theirs)) != unpacked(ours):
            raise AssertionError("ids differ from the sentencepiece library")
        return dict(zip(new, found))

    def cut(self, text: str) -> list[str]:
        """Segments of a text, each without its first blank sign. A blank before
        another one goes with it."""
        if not text:
            return []
        if "  " not in text and BLANK not in text and text[0] != " ":
            return text.split(" ")
        signs = BLANK + text.replace(" ", BLANK)
        return [s[1:] for s in re.findall(f"{BLANK}+[^{BLANK}]*", signs)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, the end id last."""
        cut = [self.cut(t) for t in texts]
        known = self.known
        segments = set().union(*cut)
        new = [s for s in segments if s not in known]
        fresh = self.learn(new) if new else {}
        look = known
        if len(known) + len(fresh) > REMEMBERED:
            look = {s: known[s] for s in segments if s in known} | fresh
            known.clear()
            self.known = {s: v for s, v in look.items() if len(s) < LONGEST} if len(look) <= REMEMBERED else {}
        else:
            known.update(fresh)
        out = [[*unpacked(map(look.__getitem__, segments)), self.end] for segments in cut]
        if look is known:
            for s in fresh:
                if len(s) >= LONGEST:
                    del known[s]
        return out

    def told(self, ids: list[int]) -> str:
        """Ids in decimal, joined by blanks."""
        return " ".join(map(self.names.__getitem__, ids))


def unpacked(ids) -> list[int]:
    return np.frombuffer(b"".join(ids), ID).tolist()


@lru_cache(maxsize=2)
def merger(path: str) -> Merger:
    """One per Python worker, which serves many tasks."""
    return Merger(path)


def encode_pieces(docs: DataFrame, path: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``ids``, the ids and the
    decoded text, by the model in the file ``path``."""

    def run(batches):
        coder = merger(path)
        for batch in batches:
            out, at = [], iter(batch["doc_id"])
            for texts in slices(batch["text"]):
                coded = coder.encode(texts)
                for found, text in zip(coded, coder.model.decode(coded)):
                    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (coder.told(found), text)]
                    row = (next(at), len(found), *digests)
                    out.append((*row, found, text) if ids else row)
            columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * ids
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_exact(docs.select("doc_id", "text"), run, schema + ", ids array<int>, decoded string" * ids)
