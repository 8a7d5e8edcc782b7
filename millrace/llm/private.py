"""Personal data by fixed patterns and a skip-chain conditional random field.

Emails, ip addresses, card and phone numbers are first found by pattern; these
base spans are never changed. A random field then labels the other candidate
tokens (words with a digit or an ``@``) of each document. Its potentials:

* single tokens: shapes of the token and its neighbours (a softmax);
* chains: pairs of neighbouring candidates;
* skip chains: each candidate and the next one in the document that is the same
  or similar (same last digits, same name before ``@``).

Weights are fitted piece by piece on a sample of about ``SAMPLE_DOCS``
documents, in which tokens in base spans carry their kind. Base tokens are
observed. Loopy message passing, over all documents of a batch at once, brings
the evidence of one mention to all its repetitions: each round passes exactly
along whole skip paths, then whole chains, until the messages of a document
stand still. Tokens that are then ``SURE`` of a kind become spans. The number of
edges is below twice the number of tokens, and a path of n tokens takes log2(n)
steps, so long documents cost little more than in proportion.

Null text is an empty text, without spans. Repeated rows are labelled each for
itself. An empty table gives an empty result."""

from __future__ import annotations

import hashlib
import re
import warnings
import zlib
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_exact

KINDS = ("email", "ip", "card", "phone")
SAMPLE_DOCS = 4000
FEATURES = 2048
#: Message passing goes on until no logarithm of a message changes by more.
TOLERANCE = 1e-6
#: Loops that do not settle take half the step after so many rounds each, and
#: are given up with a warning below the least share of a step.
SLOWER = 200
LEAST_SHARE = 1e-3
SURE = 0.9
#: Pairs of like tokens with one label that are taken as seen beforehand.
AGREEMENT = 8

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
LONG_NUMBER = re.compile(r"[0-9](?:[\x20-]?[0-9]){11}")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
HINT = re.compile(r"[0-9@]")
NO_DIGIT = re.compile(r"[^0-9]+")
EDGE = re.compile(r"^[^0-9A-Za-z+(]+|[^0-9A-Za-z)]+$")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from their ``@`` so that no long run of letters
    is read more than once."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            end = found.end()
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in IP.finditer(text) if all(map(small, m.groups()))]


def luhn(digits: str) -> bool:
    ends = [int(d) for d in reversed(digits)]
    return (sum(ends[::2]) + sum(2 * d - 9 * (d > 4) for d in ends[1::2])) % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    if not LONG_NUMBER.search(text):
        return []
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = NO_DIGIT.sub("", m.group())
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(m.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    if "+" not in text:
        return []
    return [m.span() for m in PHONE.finditer(text) if 9 <= len(NO_DIGIT.sub("", m.group())) <= 15]


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of kind, end), in order."""
    if not HINT.search(text):
        return []
    found = [(s, k, e) for k, f in enumerate((emails, ips, cards, phones)) for s, e in f(text)]
    return sorted(found)


#: Signs of a token's shape that are told as they are.
LONG_SHAPE = 64


def shape(word: str) -> str:
    """Digits as 9 and other signs as they are, runs longer than 6 as the sign and
    +, runs of letters as a; of the whole token. A long shape ends in its hash."""
    out = []
    for kind, run in groupby(word, lambda c: "9" if "0" <= c <= "9" else "a" if c.isalpha() else c):
        n = sum(1 for _ in run)
        out.append("a" if kind == "a" else kind * n if n <= 6 else kind + "+")
    told = "".join(out)
    return told if len(told) <= LONG_SHAPE else f"{told[:LONG_SHAPE]}#{zlib.crc32(told.encode('utf-8', 'replace'))}"


def likeness(word: str) -> str:
    """What the same or similar tokens have in common."""
    name = EDGE.sub("", word.partition("@")[0]).lower()
    digits = NO_DIGIT.sub("", word)
    if "@" in word or any(c.isalpha() for c in name):
        return "n" + name if any("0" <= c <= "9" for c in name) else ""
    return "d" + digits[-7:] if len(digits) >= 4 else ""


def checked(word: str) -> str:
    """What the checks behind the patterns say of a token."""
    digits = NO_DIGIT.sub("", word)
    parts = [p for p in re.split("[^0-9]+", word) if p]
    number = ("luhn" if luhn(digits) else "no luhn") if 12 <= len(digits) <= 19 else "short" if len(digits) < 12 else "long"
    return number + (" bytes" if len(parts) == 4 and all(map(small, parts)) else "") + (" mail" if emails(word) else "")


class Tokens:
    """The candidate tokens of a batch of documents."""

    def __init__(self):
        self.doc: list[int] = []
        self.at: list[int] = []
        self.span: list[tuple[int, int]] = []
        self.label: list[int] = []  # 0, or 1 + kind of the base span it lies in
        self.shapes: list[str] = []
        self.checks: list[str] = []
        self.edges: list[tuple[int, int, int]] = []

    def add(self, doc: int, text: str, base: list[tuple[int, int, int]]) -> None:
        seen: dict[str, int] = {}
        spans = iter(base)
        span = next(spans, None)
        for at, m in enumerate(WORD.finditer(text)):
            word = m.group()
            if not HINT.search(word):
                continue
            while span and span[2] <= m.start():
                span = next(spans, None)
            n = len(self.doc)
            self.label.append(span[1] + 1 if span and span[0] < m.end() else 0)
            beside = n > 0 and self.doc[-1] == doc and self.at[-1] == at - 1
            if beside:
                self.edges.append((n - 1, n, 0))
            self.doc.append(doc)
            self.at.append(at)
            self.span.append(m.span())
            self.shapes.append(shape(word))
            self.checks.append(checked(word))
            key = likeness(word)
            if key:
                if key in seen and not (beside and seen[key] == n - 1):
                    self.edges.append((seen[key], n, 1))
                seen[key] = n

    def features(self) -> np.ndarray:
        """Numbers of the features that each token has."""
        n, out = len(self.doc), []
        beside = lambda i, j: self.shapes[j] if 0 <= j < n and self.doc[j] == self.doc[i] and self.at[j] - self.at[i] == j - i else "w"
        for i, own in enumerate(self.shapes):
            left, right = beside(i, i - 1), beside(i, i + 1)
            names = ("s" + own, "c" + re.sub("9+", "9", own), f"d{own.count('9')}", "@" * ("@" in own) + f".{own.count('.')}", "l" + left, "r" + right, f"b{left}|{own}", f"e{own}|{right}", "v" + self.checks[i])
            out.append([zlib.crc32(x.encode("utf-8", "replace")) % FEATURES for x in names])
        return np.array(out, "i4").reshape(-1, 9)

    def arrays(self):
        return np.array(self.label, "i4"), np.array(self.edges, "i4").reshape(-1, 3)


def fit(tokens: Tokens, steps: int = 200, rate: float = 0.5) -> np.ndarray:
    """Flat weights: softmax (FEATURES x kinds), chain and skip potentials."""
    size = len(KINDS) + 1
    label, edges = tokens.arrays()
    weights = np.zeros((FEATURES, size))
    weights[:, 0] += 0.05  # a feature never seen speaks for no kind
    if len(label):
        x, want = tokens.features(), np.eye(size)[label]
        square = np.full((FEATURES, size), 1e-6)
        for _ in range(steps):  # adaptive gradient steps
            p = softmax(weights[x].sum(axis=1))
            gradient = np.zeros_like(weights)
            for k in range(size):
                gradient[:, k] = np.bincount(x.ravel(), np.repeat((p - want)[:, k], x.shape[1]), FEATURES)
            gradient = gradient / len(label) + 1e-4 * weights
            square += gradient**2
            weights -= rate * gradient / np.sqrt(square)
    pairs = []
    for kind in (0, 1):  # how much more often two labels meet than by chance
        own = edges[edges[:, 2] == kind]
        seen = np.full((size, size), 0.5)
        np.add.at(seen, (label[own[:, 0]], label[own[:, 1]]), 1)
        if kind:
            seen = seen + seen.T
            seen += AGREEMENT * np.eye(size)
        share = seen / seen.sum()
        pairs.append(np.clip(np.log(share / np.outer(share.sum(1), share.sum(0))), -4, 4))
    return np.concatenate([weights.ravel(), *(p.ravel() for p in pairs)])


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


class Paths:
    """Edges of one kind form paths, since a token has one at most on either
    side. Messages pass along whole paths at once, exactly: a message is a
    product of small matrices, and products of 1, 2, 4, ... tokens are joined."""

    def __init__(self, edges: np.ndarray, n: int, potential: np.ndarray):
        root, place = list(range(n)), [0] * n
        for a, b in edges[:, :2].tolist():  # in the order of b
            root[b], place[b] = root[a], place[a] + 1
        on = np.zeros(n, bool)
        on[edges[:, :2].ravel()] = True
        nodes = np.flatnonzero(on)
        root, place = np.array(root, "i8")[nodes], np.array(place, "i8")[nodes]
        order = np.lexsort((place, root))
        self.nodes, self.place = nodes[order], place[order]
        self.ahead = np.exp(potential)

    def keep(self, nodes: np.ndarray) -> None:
        """Goes on with some tokens, whole documents of them."""
        stays = nodes[self.nodes]
        self.nodes, self.place = self.nodes[stays], self.place[stays]

    def messages(self, own: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Logarithms of what ``nodes`` hear from both sides of their paths."""
        own = own[self.nodes] + others[self.nodes]
        own = np.exp(own - own.max(axis=1, keepdims=True))
        first = self.place == 0
        ends = np.flatnonzero(np.append(first[1:], np.ones(min(1, len(first)), bool)))
        after = np.repeat(self.place[ends], self.place[ends] + 1) - self.place
        heard = self._along(own, self.place, self.ahead) + self._along(own[::-1], after[::-1], self.ahead.T)[::-1]
        return heard - heard.max(axis=1, keepdims=True)

    @staticmethod
    def _along(own: np.ndarray, place: np.ndarray, step: np.ndarray) -> np.ndarray:
        product = own[:, :, None] * step
        reach, rows = 1, np.flatnonzero(place >= 1)
        while len(rows):
            joined = product[rows - reach] @ product[rows]
            product[rows] = joined / joined.max(axis=(1, 2), keepdims=True)
            reach *= 2
            rows = rows[place[rows] >= reach]
        sent = np.log(product.sum(axis=1))
        out = np.zeros_like(own)
        later = np.flatnonzero(place >= 1)
        out[later] = sent[later - 1]
        return out - out.max(axis=1, keepdims=True)


def marginals(tokens: Tokens, flat: np.ndarray, tolerance: float = TOLERANCE) -> np.ndarray:
    """Probabilities of each token's labels after loopy message passing, along
    whole skip paths and whole chains in turn, until no message of a document
    changes by ``tolerance``; documents that have settled drop out."""
    size = len(KINDS) + 1
    weights = flat[: FEATURES * size].reshape(FEATURES, size)
    pairs = flat[FEATURES * size :].reshape(2, size, size)
    label, edges = tokens.arrays()
    own = np.log(softmax(weights[tokens.features()].sum(axis=1)) + 1e-12)
    own[label > 0] = -60.0
    own[label > 0, label[label > 0]] = 0.0
    if not len(edges):
        return softmax(own)
    doc = np.unique(tokens.doc, return_inverse=True)[1]
    chain, skip = (Paths(edges[edges[:, 2] == kind], len(own), pairs[kind]) for kind in (0, 1))
    by_chain, by_skip = np.zeros_like(own), np.zeros_like(own)
    rounds, share = 0, 1.0
    while len(chain.nodes) or len(skip.nodes):
        by_skip[skip.nodes] = skip.messages(own, by_chain)
        step = chain.messages(own, by_skip) - by_chain[chain.nodes]
        by_chain[chain.nodes] += share * step
        moving = np.zeros(doc[-1] + 1, bool)
        moving[doc[chain.nodes[np.abs(step).max(axis=1) > tolerance]]] = True
        rounds += 1
        if rounds % SLOWER == 0:  # what swings to and fro takes smaller steps
            share /= 2
            if share < LEAST_SHARE:
                warnings.warn(f"message passing does not settle in {moving.sum()} documents", stacklevel=2)
                break
        chain.keep(moving[doc])
        skip.keep(moving[doc])
    return softmax(own + by_chain + by_skip)


def added_spans(tokens: Tokens, texts: dict[int, str], flat: np.ndarray, sure: float = SURE) -> dict[int, list[tuple[int, int, int]]]:
    """The method's own spans of each document: neighbouring sure tokens."""
    if not len(tokens.doc):
        return {}
    p = marginals(tokens, flat)
    kind = p.argmax(axis=1)
    chosen = (kind > 0) & (p.max(axis=1) >= sure) & (np.array(tokens.label) == 0)
    out: dict[int, list[tuple[int, int, int]]] = {}
    last = None
    for i in np.flatnonzero(chosen).tolist():
        doc, (start, end), k = tokens.doc[i], tokens.span[i], int(kind[i]) - 1
        word = texts[doc][start:end]
        core = EDGE.sub("", word)
        if not core:
            continue
        start += word.index(core)
        end = start + len(core)
        rows = out.setdefault(doc, [])
        if last == (doc, tokens.at[i] - 1, k) and rows:
            rows[-1] = (rows[-1][0], k, end)
        else:
            rows.append((start, k, end))
        last = (doc, tokens.at[i], k)
    return out


def told(spans) -> str:
    return ",".join([f"{KINDS[k]}:{s}:{e}" for s, k, e in spans])


def fit_on(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> np.ndarray:
    """Weights from about ``sample_docs`` documents, chosen by a hash of their
    doc_id; at most twice as many. Fitted in one task."""
    n = docs.count()
    sample = docs.select("doc_id", "text")
    if n > sample_docs:
        share = int(sample_docs / n * 2**62)
        sample = sample.where(F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("crf")), 2) < share).limit(2 * sample_docs)

    def train(batches):
        tokens, n = Tokens(), 0
        for batch in batches:
            for text in batch["text"]:
                n += 1
                if text and HINT.search(text):
                    tokens.add(n, text, base_spans(text))
        yield pd.DataFrame({"weights": [fit(tokens)]})

    rows = sample.repartition(1).mapInPandas(train, "weights array<double>").collect()  # one row of fixed size
    return np.array(rows[0][0]) if rows else fit(Tokens())


def spans_of(texts, flat: np.ndarray, size: int = 2_000_000):
    """(base spans, all spans) of each text; texts go through the field many at
    a time, up to about ``size`` characters."""
    run, held = [], 0

    def flush():
        tokens, base = Tokens(), [base_spans(t) for t in run]
        hinted = {n: t for n, t in enumerate(run) if HINT.search(t)}
        for n, t in hinted.items():
            tokens.add(n, t, base[n])
        more = added_spans(tokens, hinted, flat)
        for n, b in enumerate(base):
            extra = [x for x in more.get(n, []) if all(x[2] <= s or e <= x[0] for s, _, e in b)]
            yield b, sorted(b + extra)

    for text in texts:
        run.append(text or "")
        held += len(run[-1])
        if held >= size:
            yield from flush()
            run, held = [], 0
    yield from flush()


def masked(text: str | None, spans) -> str | None:
    """The text with each span replaced by its kind; of overlapping spans the
    later is cut at the end of the earlier."""
    if not text or not spans:
        return text
    out, last = [], 0
    for start, kind, end in spans:
        if end <= last:
            continue
        out += [text[last : max(start, last)], f"[{KINDS[kind].upper()}]"]
        last = end
    return "".join(out) + text[last:]


def find_private(docs: DataFrame, flat: np.ndarray | None = None) -> DataFrame:
    """doc_id, counts of base spans, base_sha256 and spans."""
    flat = fit_on(docs) if flat is None else flat

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, (base, spans) in zip(batch["doc_id"], spans_of(batch["text"], flat)):
                counts = [sum(k == kind for _, k, _ in base) for kind in range(len(KINDS))]
                out.append((doc_id, *counts, hashlib.sha256(told(base).encode()).hexdigest(), told(spans)))
            names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_exact(docs.select("doc_id", "text"), run, f"doc_id long, {counts}, base_sha256 string, spans string")


def mask_private(docs: DataFrame, flat: np.ndarray | None = None) -> DataFrame:
    """``docs``, all columns, with every span in text replaced by its kind."""
    flat = fit_on(docs) if flat is None else flat

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text").to_pylist()
            new = [masked(t, spans) for t, (_, spans) in zip(texts, spans_of(texts, flat))]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))

    return docs.mapInArrow(run, docs.schema)
