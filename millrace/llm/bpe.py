"""Byte-level BPE with a sentencepiece model made from a rank file.

The vocabulary is serialised as a sentencepiece BPE model: every byte becomes
one printable character, a token's score is its negative rank, normalisation is
the identity. Texts are cut by the pre-token pattern, each pre-token is encoded
by that model, and ids are decoded through the inverse mapping.

A pre-token that is itself in the vocabulary is that token, as the rank file's
own library has it. Null text is an empty text: no ids, empty bytes. Repeated
rows give repeated results, an empty table none."""

from __future__ import annotations

import base64
import hashlib
import struct

import pandas as pd
from pyspark.sql import DataFrame

from millrace.llm.common import map_exact, slices

#: Pre-tokens whose ids are remembered by a task.
REMEMBERED = 150_000
#: The first of 256 consecutive letters that stand for the bytes 0 to 255.
FIRST_LETTER = 0x4E00


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def letters_of(token: bytes) -> str:
    return "".join([chr(FIRST_LETTER + b) for b in token])


def _field(number: int, kind: int, payload: bytes) -> bytes:
    return bytes([number << 3 | kind]) + payload


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _message(number: int, body: bytes) -> bytes:
    return _field(number, 2, _varint(len(body)) + body)


def bpe_model(pieces: list[tuple[str, float]]) -> bytes:
    """A sentencepiece BPE ModelProto: piece k has id k; one more piece stands
    for unknown characters, which never occur."""
    body = b"".join([_message(1, _message(1, text.encode()) + _field(2, 5, struct.pack("<f", score))) for text, score in pieces])
    unknown = _message(1, _message(1, b"<unk>") + _field(2, 5, struct.pack("<f", 0.0)) + _field(3, 0, _varint(2)))
    trainer = (
        _field(3, 0, _varint(2))  # model_type: BPE
        + _field(4, 0, _varint(len(pieces) + 1))
        + b"".join(_varint(n << 3) + _varint(v) for n, v in ((40, len(pieces)), (41, 2**64 - 1), (42, 2**64 - 1), (43, 2**64 - 1)))
    )
    # identity: no character map, no dummy prefix, blanks neither removed nor escaped
    normalizer = _message(1, b"identity") + b"".join(_field(n, 0, _varint(0)) for n in (3, 4, 5))
    return body + unknown + _message(2, trainer) + _message(3, normalizer)


def sentencepiece_model(ranks: dict[bytes, int]) -> bytes:
    """Piece k is the token of rank k; ranks must be gapless from 0."""
    tokens = sorted(ranks, key=ranks.__getitem__)
    if [ranks[t] for t in tokens] != list(range(len(tokens))) or any(bytes([b]) not in ranks for b in range(256)):
        raise ValueError("ranks must be gapless from 0 and hold every byte")
    return bpe_model([(letters_of(token), -float(rank)) for rank, token in enumerate(tokens)])


class Encoder:
    """Ids of a text, and bytes of ids."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        self.ranks = read_ranks(path)
        self.tokens = sorted(self.ranks, key=self.ranks.__getitem__)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=sentencepiece_model(self.ranks))
        self.cut = regex.compile(pattern).findall
        self.letters = [chr(FIRST_LETTER + b) for b in range(256)]
        #: for each pre-token: its ids as text, and the bytes that they decode to
        self.known: dict[str, tuple[str, bytes]] = {}

    def ids_of(self, words: list[str]) -> list[list[int]]:
        """The ids of single pre-tokens."""
        raw = [w.encode() for w in words]
        letters = self.letters
        out = self.model.encode(["".join([letters[b] for b in r]) for r in raw], num_threads=1) if raw else []
        return [[self.ranks[r]] if r in self.ranks else x for r, x in zip(raw, out)]

    def encode(self, text: str) -> list[int]:
        words = self.cut(text)
        by_word = dict(zip(new := list(set(words)), self.ids_of(new)))
        return [i for w in words for i in by_word[w]]

    def decode(self, ids: list[int]) -> bytes:
        """Every id back to its piece, every letter of it back to its byte."""
        return b"".join([self.tokens[i] for i in ids])

    def digests(self, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
        """Number of ids, comma-joined decimal ids, decoded bytes of each text."""
        cut = [self.cut(t) for t in texts]
        words = set().union(*cut)
        new = [w for w in words if w not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = list(words)
        for w, ids in zip(new, self.ids_of(new)):
            self.known[w] = (",".join(map(str, ids)), self.decode(ids))
        out = []
        for words in cut:
            got = [self.known[w] for w in words]
            told = ",".join([x for x, _ in got])
            out.append((told.count(",") + 1 if told else 0, told.encode(), b"".join([x for _, x in got])))
        return out


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if ``ids``, the ids."""

    def run(batches):
        encoder = Encoder(rank_path, pattern)
        for batch in batches:
            out = []
            coded = (x for run in slices(batch["text"]) for x in encoder.digests(run))
            for doc_id, (n, told, decoded) in zip(batch["doc_id"], coded):
                row = (doc_id, n, hashlib.sha256(told).hexdigest(), hashlib.sha256(decoded).hexdigest())
                out.append((*row, [int(x) for x in told.split(b",")] if n else []) if ids else row)
            columns = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * ids
            yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_exact(docs.select("doc_id", "text"), run, schema + ", ids array<int>" * ids)
