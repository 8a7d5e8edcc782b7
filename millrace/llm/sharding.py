"""Balanced label propagation into shards.

Documents of equal text are linked. All documents start on the shard that a
hash gives them. In every round each group of linked documents looks where most
of its members are, in every other round among the shards that still have room;
its other members ask to move there. A shard admits at most what its quota and
those that leave it make free, by a hash of the group, so that groups move as a
whole; a group larger than a shard fills one shard after another. Rounds end when
next to nothing moves (``SETTLED``). Documents without a
link cut nothing wherever they are: at the end they, and what a shard has
beyond its quota, fill all shards so that row counts are at most one apart.

Rounds keep one row per group and shard; documents are read again at the end
only. No task holds a shard or a group: see ``numbered``. Of shards with as many members
a hash of group and shard decides. Very long texts count with all their bytes; only
doc_id and text are read, so other columns may have any name.

Null text is an empty text (size 1), linked to other empty ones. Repeated rows
are documents of their own. Fewer documents than shards leave shards empty; an
empty table gives an empty result."""

from __future__ import annotations

from itertools import count

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import numbered
from millrace.runtime import materialise

SHARDS = 16
#: Rounds end when no more than this share of the linked documents moves.
SETTLED = 1 / 1000


def described(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32, and the group as two 64-bit hashes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).cast("long").alias("text_crc32"),
        F.xxhash64(text).alias("group"),
        F.xxhash64(F.lit(1), text).alias("group_two"),
    )


def admitted(wanted: np.ndarray, room: np.ndarray) -> np.ndarray:
    """Of the moves ``wanted`` from shard i to shard j, the share for which there is
    room once those that leave j are gone: arrivals of a shard that would overflow
    are scaled down until none does. At most shards x shards numbers."""
    flow = wanted.astype(float)
    while True:
        arrive, leave = flow.sum(axis=0), flow.sum(axis=1)
        fits = np.divide(room + leave, arrive, out=np.ones(len(room)), where=arrive > 0)
        if (fits > 1 - 1e-6).all():
            return np.divide(flow, wanted, out=np.zeros_like(flow), where=wanted > 0)
        flow *= np.minimum(fits, 1)
        flow[flow < 1e-3] = 0


def propagate(cells: DataFrame, capacity: int, shards: int) -> DataFrame:
    """``cells`` (group, group_two, home, shard, n): how many members of a group
    that started at ``home`` are on ``shard``. Moves whole cells or parts of
    them. Members ask for the fullest shard of their group, in every other round
    for the fullest one that has room, and only for a fuller one than their own (of
    equals, by a hash), so the squares of members grow with every move and rounds
    come to an end: after two in a row in which less than ``SETTLED`` of all moved."""
    group, quiet = ["group", "group_two"], 0
    linked = cells.agg(F.sum("n")).first()[0] or 0
    place = F.struct("n", F.xxhash64(*group, "shard").alias("h"), "shard")
    for turn in count():
        load = {r["shard"]: r["n"] for r in cells.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # <= shards rows
        room = np.array([max(0, capacity - load.get(s, 0)) for s in range(shards)])
        open_ = F.array(*[F.lit(bool(r)) for r in room])
        held = cells.groupBy(*group, "shard").agg(F.sum("n").alias("n"))
        best = held.groupBy(*group).agg(
            F.max(place).alias("most"), F.max(F.when(F.get(open_, F.col("shard")), place)).alias("open")
        )
        target = F.col("most") if turn % 2 == 0 else F.col("open")
        own = F.sum("n").over(Window.partitionBy(*group, "shard"))  # at most one row a home
        asked = cells.withColumn("_own", own).join(best, group)
        mine = F.struct(F.col("_own").alias("n"), F.xxhash64(*group, "shard").alias("h"), F.col("shard"))
        asked = asked.withColumns({"to": target["shard"], "asks": F.coalesce(target > mine, F.lit(False))})
        asked = materialise(asked.select(*cells.columns, "to", "asks"), "asked")
        wanted = np.zeros((shards, shards))
        for r in asked.where("asks").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect():  # <= shards^2 rows
            wanted[r["shard"], r["to"]] = r["n"]
        moved = 0
        if wanted.any():
            share = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in admitted(wanted, room)])
            part = F.get(F.get(share, F.col("shard")), F.col("to"))
            # of each request the share for which there is room; small groups move whole
            luck = F.pmod(F.shiftrightunsigned(F.xxhash64("group", F.lit(turn)), 11), F.lit(1_000_000)) / 1e6
            large = F.lit(max(16, capacity // 100))
            some = F.floor(F.col("n") * part + luck)  # rounded up or down by the same hash
            whole = F.when(luck < part, F.col("n")).otherwise(0)
            moving = F.when(~F.col("asks"), 0).when(F.col("n") > large, F.least(some, F.col("n"))).otherwise(whole)
            step = asked.withColumn("m", moving.cast("long"))
            gone = step.where("m > 0").select(*group, "home", F.col("to").alias("shard"), F.col("m").alias("n"))
            stay = step.where("n > m").select(*group, "home", "shard", (F.col("n") - F.col("m")).alias("n"))
            moved = gone.agg(F.sum("n")).first()[0] or 0
            if moved:
                cells = materialise(stay.unionByName(gone).groupBy(*group, "home", "shard").agg(F.sum("n").alias("n")), "cells")
        quiet = quiet + 1 if moved <= SETTLED * linked else 0
        if quiet == 2:
            return cells


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law (``rows``), shard, slot, grown_shard (null)."""
    rows = described(docs).withColumn("tie", F.xxhash64("doc_id", F.monotonically_increasing_id()))
    rows = materialise(rows.withColumn("home", F.pmod("tie", F.lit(shards)).cast("int")), "described")
    total = rows.count()
    capacity = -(-total // shards)
    group = ["group", "group_two"]
    counted = rows.groupBy(*group, "home").agg(F.count("*").alias("n"))
    linked = counted.withColumn("_all", F.sum("n").over(Window.partitionBy(*group))).where("_all > 1").drop("_all")
    cells = materialise(linked.withColumn("shard", F.col("home")), "cells")
    cells = propagate(cells, capacity, shards)
    # members of a group with one home are alike: the first n of them go to the first cell, and so on
    upto = Window.partitionBy(*group, "home").orderBy("shard")
    ends = cells.withColumn("_end", F.sum("n").over(upto)).groupBy(*group, "home").agg(
        F.sort_array(F.collect_list(F.struct("_end", "shard"))).alias("cells")  # at most one per shard
    )
    ends = materialise(ends, "ends")
    single = F.size("cells") == 1
    # only groups that were cut need numbers
    cut = ends.where(~single)
    one = ends.where(single).select(*group, "home", F.col("cells")[0]["shard"].alias("to"))
    split = numbered(rows.join(cut, [*group, "home"]), [*group, "home"], F.col("tie"), F.xxhash64("tie"))
    split = split.withColumn("to", F.expr("filter(cells, c -> number < c._end)")[0]["shard"]).drop("cells", "number")
    whole = rows.join(cut.select(*group, "home"), [*group, "home"], "left_anti").join(one, [*group, "home"], "left")
    placed = materialise(whole.unionByName(split), "placed")
    # exact quotas: in each shard linked documents come first, those beyond the quota and all others fill up
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    linked_rows = numbered(placed.where("to is not null"), ["to"], F.col("group"), F.col("tie"))
    limit = F.get(F.array(*[F.lit(q) for q in quota]), F.col("to"))
    linked_rows = materialise(linked_rows.withColumn("stays", F.col("number") < limit), "linked")
    kept = {r["to"]: r["n"] for r in linked_rows.where("stays").groupBy("to").agg(F.count("*").alias("n")).collect()}
    columns = ["doc_id", "size", "text_crc32", "group", "tie"]
    stays = linked_rows.where("stays").select(*columns, F.col("to").alias("shard"))
    free = linked_rows.where("not stays").select(*columns).unionByName(placed.where("to is null").select(*columns))
    free = numbered(free.withColumn("all", F.lit(0)), ["all"], F.col("group"), F.col("tie"))
    bounds, at = [], 0
    for s in range(shards):
        at += quota[s] - kept.get(s, 0)
        bounds.append(at)
    shard = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= F.col("number"))).cast("int")
    filled = free.select(*columns, shard.alias("shard"))
    final = materialise(stays.unionByName(filled), "final")
    slots = numbered(final, ["shard"], F.xxhash64("doc_id"), F.col("tie"))
    return slots.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        F.col("number").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
