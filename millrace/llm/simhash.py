"""SimHash near-dedup with deletion-variant signatures.

A fingerprint has a bit set where more than half of the text's shingle hashes
have it. Fingerprints link at ``BITS`` = 2 differing bits or fewer. Cut into two
halves, one half of a linked pair differs by at most one bit, so the pair shares
a variant: a half with one position masked. The 64 variants of every *distinct*
fingerprint are joined by equality, and each pair met is verified on all bits.

Copies collapse before the join. Variants meet in buckets of bounded size; in a
bucket, small groups are compared directly, large ones by looking up what two
flipped bits can reach, which grows with the group and not with its square. If
a half is shared by very many fingerprints, its variants are joined by a third
of the other half as well: at most two bits differ there, so one of three parts
is equal. Only a forest of links leaves a bucket.

Null and empty text has the fingerprint zero. Null doc_ids are ignored when the
smallest doc_id of a component is taken (null if there is no other). Repeated
rows stay in the result. An empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, join_counted, map_exact
from millrace.runtime import materialise

SHINGLE = 3
BITS = 2
SEED = 42
#: Variants in a bucket, on average; a half shared by more fingerprints than
#: HEAVY is split by parts of the other half.
BUCKET_VARIANTS = 400_000
HEAVY = 200_000
#: Groups up to this size are compared directly.
SMALL_GROUP = 4096
#: The parts of a half, as (shift, bits).
PARTS = ((0, 11), (11, 11), (22, 10))

LOWER = bytes([b + 32 if 65 <= b <= 90 else b for b in range(256)])


def fingerprint(words: list[bytes], shingle: int = SHINGLE) -> int:
    """Of lower-case words; 0 without words."""
    import xxhash

    if not words:
        return 0
    if len(words) <= shingle:
        parts = [b" ".join(words)]
    else:
        parts = [b" ".join(x) for x in zip(*[words[k:] for k in range(shingle)])]
    hashes = np.fromiter(map(HASH(xxhash), parts), "<u8", len(parts))
    ones = np.zeros(64, "i8")
    for at in range(0, len(hashes), 100_000):
        bits = np.unpackbits(hashes[at : at + 100_000].view("u1").reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype="i8")
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def HASH(xxhash):
    digest = xxhash.xxh64_intdigest
    return lambda x: digest(x, SEED)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id and fp, the fingerprint as a signed long; and the columns ``carry``."""
    types = {"doc_id": "long", **{c: docs.schema[c].dataType.simpleString() for c in carry}}

    def run(batches):
        for batch in batches:
            fps = [fingerprint((t or "").encode().translate(LOWER).split(), shingle) for t in batch["text"]]
            yield batch[list(types)].astype({"doc_id": "Int64"}).assign(fp=np.array(fps, "u8").view("i8"))

    return map_exact(docs.select(*types, "text"), run, "".join(f"{c} {t}, " for c, t in types.items()) + "fp long")


def half(fp: Column, which: Column) -> Column:
    """The low (0) or high (1) 32 bits, from 0 to 2 ** 32 - 1."""
    return F.when(which == 0, fp.bitwiseAND(0xFFFFFFFF)).otherwise(F.shiftrightunsigned(fp, 32))


def variants(fps: DataFrame) -> DataFrame:
    """key and fp: 64 rows per fingerprint. key is the masked half, and above
    it the position masked (0 to 63)."""
    at = F.col("_at")
    rows = fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("_at"))
    masked = half(F.col("fp"), F.floor(at / 32)).bitwiseAND(F.bitwise_not(F.expr("shiftleft(1L, _at % 32)")))
    return rows.select(masked.bitwiseOR(F.expr("shiftleft(CAST(_at AS BIGINT), 32)")).alias("key"), "fp")


def split_heavy(rows: DataFrame, fps: DataFrame, heavy: int) -> DataFrame:
    """``variants`` with a column part: 0, or where a half is heavy, the number
    and value of each part of the other half."""
    one = fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("w"))
    halves = one.select("w", half(F.col("fp"), F.col("w")).alias("h")).groupBy("w", "h").count().where(F.col("count") > heavy)
    halves = materialise(halves, "heavy")
    if halves.isEmpty():
        return rows.withColumn("part", F.lit(0).cast("long"))
    at = F.explode(F.sequence(F.lit(0), F.lit(31))).alias("_b")
    keys = halves.select("w", "h", at).select(
        F.expr("(h & ~shiftleft(1L, _b)) | shiftleft(CAST(w * 32 + _b AS BIGINT), 32)").alias("key")
    )
    keys = materialise(keys.distinct(), "heavy_keys")
    other = half(F.col("fp"), 1 - F.floor(F.shiftrightunsigned("key", 32) / 32))
    parts = [
        (F.shiftrightunsigned(other, shift).bitwiseAND((1 << bits) - 1) + ((n + 1) << 12)).cast("long")
        for n, (shift, bits) in enumerate(PARTS)
    ]
    split = rows.join(keys, "key", "left_semi").select("key", "fp", F.explode(F.array(*parts)).alias("part"))
    return rows.join(keys, "key", "left_anti").withColumn("part", F.lit(0).cast("long")).unionByName(split)


#: All differences of up to two bits in a half that is not masked.
_ONE = [1 << i for i in range(32)]
FLIPS = np.array([0, *_ONE, *(a | b for n, a in enumerate(_ONE) for b in _ONE[n + 1 :])], "u8")


def group_links(fp: np.ndarray, at: int, limit: int = SMALL_GROUP) -> tuple[np.ndarray, np.ndarray]:
    """Indices of linked pairs of one group: sorted distinct fingerprints that
    agree on one half but for the masked position ``at``."""
    if len(fp) <= limit:
        a, b = [], []
        for d in range(1, len(fp)):
            hit = np.flatnonzero(np.bitwise_count(fp[d:] ^ fp[:-d]) <= BITS)
            a.append(hit)
            b.append(hit + d)
        return np.concatenate(a), np.concatenate(b)
    shift = np.uint64(0 if at >= 32 else 32)  # of the half that may differ freely
    a, b = [], []
    for masked in (np.uint64(0), np.uint64(1) << np.uint64(at)):
        for flip in FLIPS if not masked else FLIPS[:33]:
            other = fp ^ (flip << shift) ^ masked
            found = np.minimum(np.searchsorted(fp, other), len(fp) - 1)
            hit = np.flatnonzero((fp[found] == other) & (found > np.arange(len(fp))))
            a.append(hit)
            b.append(found[hit])
    return np.concatenate(a), np.concatenate(b)


def bucket_links(key: np.ndarray, part: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A forest (a, b) over the linked fingerprints of a bucket."""
    order = np.lexsort((fp, part, key))
    key, part, fp = key[order], part[order], fp[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (part[1:] != part[:-1])]
    start = np.flatnonzero(new)
    size = np.diff(np.r_[start, len(key)])
    a, b = [], []
    group = np.cumsum(new) - 1
    alive = np.flatnonzero(size[group] > 1)
    alive = alive[size[group[alive]] <= 64]
    for d in range(1, 64):  # small groups, all at once
        alive = alive[alive + d < len(key)]
        alive = alive[group[alive + d] == group[alive]]
        if not len(alive):
            break
        hit = alive[np.bitwise_count(fp[alive] ^ fp[alive + d]) <= BITS]
        a.append(hit)
        b.append(hit + d)
    for g in np.flatnonzero(size > 64):
        s = start[g]
        x, y = group_links(fp[s : s + size[g]], int(key[s] >> 32))
        a.append(x + s)
        b.append(y + s)
    if not a:
        return np.zeros(0, "u8"), np.zeros(0, "u8")
    a, b = fp[np.concatenate(a)], fp[np.concatenate(b)]
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while len(x):
        low = np.minimum(root[x], root[y])
        was = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = np.minimum(root, root[root])
        if (root == was).all():
            break
    child = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[child], nodes[root[child]]


def links(fps: DataFrame, heavy: int = HEAVY) -> DataFrame:
    """a, b: enough links between distinct fingerprints (column fp) to connect
    all that are linked."""
    buckets = max(1, fps.count() * 64 // BUCKET_VARIANTS)
    rows = split_heavy(variants(fps), fps, heavy)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key", "part"), F.lit(buckets)))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        a, b = bucket_links(frame["key"].to_numpy(), frame["part"].to_numpy(), frame["fp"].to_numpy().view("u8"))
        return pd.DataFrame({"a": a.view("i8"), "b": b.view("i8")})

    return rows.groupBy("bucket").applyInPandas(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (the smallest doc_id
    reachable by links, the row's own included). With ``carry``, columns of
    ``docs``, also these and ``root``, a fingerprint that names the component, also
    where no document of it has a doc_id."""
    prints = materialise(fingerprints(docs, shingle, carry), "fingerprints")
    classes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("_n"))
    classes = materialise(classes, "classes")
    tree = components(links(classes.select("fp")), "stars")
    rooted = classes.join(tree, classes["fp"] == tree["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialise(rooted.select("fp", "root", "_n").join(least, "root").select("fp", "root", "component_id", "_n"), "named")
    total = named.agg(F.sum("_n")).first()[0] or 0
    out = join_counted(prints, named, "fp", "_n", total)
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return out.select("doc_id", digits, "component_id", *([*carry, "root"] if carry else []))
