"""Periodic runs of words by Lyndon roots.

A run with smallest period q has a factor of length q that is the longest Lyndon word
at its place, under the order of the words or under the reverse order. The lengths of
these longest Lyndon words come from the first phase of Baier's suffix sorter: suffixes
start in groups by first word; groups are taken from the greatest down, and each of
their suffixes lengthens the context of the nearest smaller suffix to its left, which
moves to a higher group. When a group is taken, its context is the Lyndon word of its
members. Every root is then extended to both sides by longest common extensions over
names of blocks of 1, 2, 4, ... words, which are exact.

Only stretches of words whose triples each occur three times or more in the stretch are
sorted: in a run of four periods and six words each triple does, so no run is lost.

Null and empty texts have no words and no runs. Very long texts are whole; memory is in
proportion to a slice of texts or to one longer text. Runs of equal exponent: the
smallest start, then the smallest period. Repeated rows give repeated results, an empty
table none. Only doc_id and text are read, so other columns may have any name; a null
doc_id stays null, and its words are never changed by ``recur``."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from millrace.llm.common import map_exact, slices

#: A run has so many words at least, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4


def lyndon_lengths(codes: np.ndarray) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there."""
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    first = np.flatnonzero(np.diff(codes[order], prepend=codes[order[:1]] - 1)) if n else order
    spread = np.repeat(first, np.diff(first, append=n))
    start = np.empty(n, np.int64)
    start[order] = spread
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    # a group is named by its first place among the sorted suffixes
    suffixes, start, place = order.tolist(), start.tolist(), place.tolist()
    size, context = [0] * n, [1] * n
    for a, b in zip(first.tolist(), [*first[1:].tolist(), n]):
        size[a] = b - a
    length = [0] * n
    #: slot i + 1 leads to the nearest suffix at or before i that was not yet taken
    lead = list(range(n + 1))

    def move(group: int, members: list[int], longer: int) -> None:
        """Members go to the upper end of their group, as a group of their own."""
        rest = size[group] - len(members)
        if not rest:
            context[group] += longer
            return
        at = group + rest
        size[group], size[at], context[at] = rest, len(members), context[group] + longer
        for k, p in enumerate(members):
            here, there = place[p], at + k
            other = suffixes[there]
            suffixes[here], suffixes[there] = other, p
            place[other], place[p] = here, there
        for p in members:
            start[p] = at

    def nearest(slot: int) -> int:
        while lead[slot] != slot:
            lead[slot] = slot = lead[lead[slot]]
        return slot

    end = n
    while end:
        group = start[suffixes[end - 1]]
        own = context[group]
        if end - group == 1:
            i = suffixes[group]
            length[i], lead[i + 1] = own, i
            p = nearest(i) - 1
            if p >= 0:
                if size[start[p]] == 1:
                    context[start[p]] += own
                else:
                    move(start[p], [p], own)
        else:
            times: dict[int, int] = {}
            taken = suffixes[group:end]
            for i in taken:
                length[i], lead[i + 1] = own, i
            for i in taken:
                p = nearest(i) - 1
                if p >= 0:
                    times[p] = times.get(p, 0) + 1
            by_times: dict[int, dict[int, list[int]]] = {}
            for p, m in times.items():
                by_times.setdefault(m, {}).setdefault(start[p], []).append(p)
            for m in sorted(by_times, reverse=True):
                for at, members in by_times[m].items():
                    move(at, members, m * own)
        end = group
    return length


class Extensions:
    """Longest common extensions of a sequence, by names of its blocks."""

    def __init__(self, codes: np.ndarray, longest: int):
        self.levels = [codes.astype(np.int64)]
        while 2 << (len(self.levels) - 1) <= longest:
            now, half = self.levels[-1], 1 << (len(self.levels) - 1)
            pairs = now[:-half] * (int(now.max()) + 1) + now[half:]
            self.levels.append(np.unique(pairs, return_inverse=True)[1])

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words from a < b on."""
        a, b, found = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            names, step = self.levels[j], 1 << j
            # a block is met at most once on the way down, but for the largest
            while True:
                fits = b < len(names)
                same = fits & (names[np.where(fits, a, 0)] == names[np.where(fits, b, 0)])
                for x in (a, b, found):
                    x[same] += step
                if j < len(self.levels) - 1 or not same.any():
                    break
        return found

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal words before a < b."""
        a, b, found = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for j in range(len(self.levels) - 1, -1, -1):
            names, step = self.levels[j], 1 << j
            while True:
                fits = a >= step
                same = fits & (names[np.where(fits, a - step, 0)] == names[np.where(fits, b - step, 0)])
                a[same] -= step
                b[same] -= step
                found[same] += step
                if j < len(self.levels) - 1 or not same.any():
                    break
        return found


def repeating(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches, inside the given ones, of which each three words in a row occur
    three times or more. Equal hashes of unlike words can only keep too much."""
    mix = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
    while True:
        long_enough = ends - starts >= LEAST_WORDS
        starts, ends = starts[long_enough], ends[long_enough]
        if not len(starts):
            return starts, ends
        sizes = ends - starts - 2
        stretch = np.repeat(np.arange(len(starts)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + starts[stretch]
        wide = codes.astype(np.uint64)
        key = wide[at] * mix[0] + wide[at + 1] * mix[1] + wide[at + 2] * mix[2]
        key ^= key >> np.uint64(29)
        key = (key + stretch.astype(np.uint64)) * mix[3]
        order = np.argsort(key, kind="stable")
        edge = np.flatnonzero(np.diff(key[order], prepend=~key[order[:1]]))
        counts = np.diff(edge, append=len(order))
        often = np.empty(len(order), bool)
        often[order] = np.repeat(counts >= 3, counts)
        chain = often & np.append(False, often[:-1] & (stretch[1:] == stretch[:-1]))
        heads = np.flatnonzero(often & ~chain)
        tails = np.flatnonzero(often & ~np.append(chain[1:], False))
        before, starts, ends = (ends - starts).sum(), at[heads], at[tails] + 3
        if (ends - starts).sum() > 0.9 * before:
            return starts, ends


def find_runs(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Runs inside the given stretches of a sequence of word numbers: rows of
    (start, length, period), by start, then period."""
    starts, ends = repeating(codes, starts, ends)
    none = np.zeros((0, 3), np.int64)
    if not len(starts):
        return none
    # stretches one after another, each followed by a word of its own
    sizes = ends - starts
    shifts = np.cumsum(sizes + 1) - sizes - 1
    line = np.empty(int((sizes + 1).sum()), np.int64)
    back = np.zeros(len(line), np.int64)
    roots, periods, top = [], [], int(codes.max()) + 1
    for k, (a, b, to) in enumerate(zip(starts.tolist(), ends.tolist(), shifts.tolist())):
        part = codes[a:b]
        line[to : to + b - a], line[to + b - a] = part, top + k
        back[to : to + b - a] = np.arange(a, b)
        for ordered in (part, -part):
            periods.append(np.array(lyndon_lengths(ordered), np.int64))
            roots.append(np.arange(to, to + b - a))
    root, period = np.concatenate(roots), np.concatenate(periods)
    # one word beside the root repeats to the right or to the left, else there is no run
    near = line[root] == line[root + period]
    near |= (root > 0) & (line[root - 1] == line[root + period - 1])
    root, period = root[near], period[near]
    if not len(root):
        return none
    extend = Extensions(line, int(sizes.max()))
    left = extend.left(root, root + period)
    length = left + period + extend.right(root, root + period)
    is_run = (length >= LEAST_WORDS) & (length >= LEAST_PERIODS * period)
    found = np.stack([back[(root - left)[is_run]], length[is_run], period[is_run]], axis=1)
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def recur(doc_id: int | None, n: int) -> np.ndarray | None:
    """For one document in ten, which word stands at each place: from word a on, the
    next p words over and over. None: as they are."""
    if doc_id is None or not n or (h := zlib.crc32(str(doc_id).encode())) % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    return np.where(places < a, places, a + (places - a) % p)


def run_rows(doc_ids: list, texts: list[str], change: Callable | None = None) -> list[tuple]:
    """Per document (doc_id, runs, kept words as bytes)."""
    words = [t.encode(errors="surrogatepass").split() for t in texts]
    number = {w: k for k, w in enumerate(set().union(*words))}
    coded = []
    for k, (doc_id, own) in enumerate(zip(doc_ids, words)):
        places = change(doc_id, len(own)) if change else None
        if places is not None:
            words[k] = own = [own[i] for i in places.tolist()]
        coded.append(np.fromiter(map(number.__getitem__, own), np.int64, len(own)))
    ends = np.cumsum([len(c) for c in coded])
    starts = ends - [len(c) for c in coded]
    runs = find_runs(np.concatenate(coded), starts, ends) if coded else np.zeros((0, 3), np.int64)
    at = np.searchsorted(runs[:, 0], [*starts, ends[-1] if len(ends) else 0])
    out = []
    for k, (doc_id, own) in enumerate(zip(doc_ids, words)):
        mine = runs[at[k] : at[k + 1]] - [starts[k], 0, 0]
        if len(mine):
            gone = np.zeros(len(own) + 1, np.int64)
            np.add.at(gone, mine[:, 0] + mine[:, 2], 1)
            np.add.at(gone, mine[:, 0] + mine[:, 1], -1)
            stay = np.cumsum(gone[:-1]) == 0
            own = [own[i] for i in np.flatnonzero(stay).tolist()]
        out.append((doc_id, mine, b" ".join(own)))
    return out


def periodic_runs(docs: DataFrame, change: Callable | None = None, text: bool = False) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent (start, length, period,
    exponent_milli), digests of all runs and of the words that stay when every run
    keeps its first period only; with ``text`` those words and all runs too.
    ``change(doc_id, n)`` may give the word that stands at each place."""

    def run(batches):
        for batch in batches:
            ids = batch["doc_id"].astype(object).where(batch["doc_id"].notna(), None).tolist()
            out, at = [], 0
            for texts in slices(batch["text"]):
                for doc_id, runs, kept in run_rows(ids[at : at + len(texts)], texts, change):
                    best = [None] * 4
                    if len(runs):
                        start, length, period = max(runs.tolist(), key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))
                        best = [start, length, period, 1000 * length // period]
                    told = "".join(f"{s},{n},{q}\n" for s, n, q in runs.tolist())
                    row = (doc_id, len(runs), *best, hashlib.sha256(told.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())
                    more = [{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()]
                    out.append((*row, kept.decode(errors="surrogatepass"), more) if text else row)
                at += len(texts)
            numbers = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
            frame = pd.DataFrame(out, columns=[*numbers, "runs_sha256", "collapsed_sha256"] + ["text", "runs"] * text)
            yield frame.astype({c: "Int64" for c in numbers})

    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
    more = ", text string, runs array<struct<start:long,length:long,period:long>>" * text
    return map_exact(docs.select("doc_id", "text"), run, schema + more)
