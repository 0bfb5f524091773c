"""Mixing sources to target weights with Pfair scheduling.

Every source is cut into blocks of equal volume. Block j of a source with weight w (a share of the
sum) is released in slot floor(j / w) and due in slot ceil((j + 1) / w); in each slot the released block
with the earliest deadline goes next. For weights that add up to one this keeps every source within
less than one block of its target at every moment. The timetable repeats after ``sum of shares``
slots, so one period is worked out, from the shares alone, and every block finds its slot by
arithmetic. When a source ends, the shares of the others make up a new timetable from there on.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Mapping
from dataclasses import dataclass
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postquarry.llm.common import running_total

REST = "(other)"


def timetable(shares: Mapping[str, int]) -> list[str]:
    """Earliest deadline first over one period: the source of every slot. Ties go by name."""
    period = sum(shares.values())
    waiting = [(0, -(-period // share), name, 0) for name, share in shares.items()]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, deadline, name, j = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, name, j))
        deadline, name, j = heapq.heappop(ready)
        slots.append(name)
        if j + 1 < shares[name]:
            n, share = j + 1, shares[name]
            heapq.heappush(waiting, (n * period // share, -(-(n + 1) * period // share), name, n))
    return slots


@dataclass
class Phase:
    """Slots from ``start`` on, until the first of its sources ends."""

    start: int
    period: int
    shares: dict[str, int]
    first: dict[str, int]  # blocks that went before, by source
    slots: dict[str, list[int]]  # slots of a source within a period
    length: int = 0


def phases(shares: Mapping[str, int], blocks: Mapping[str, int]) -> list[Phase]:
    """Timetables from the first slot to the last block; at most one per source."""
    left = {name: n for name, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    out, start = [], 0
    while left:
        divisor = gcd(*[shares[name] for name in left])
        now = {name: shares[name] // divisor for name in sorted(left)}
        period, slots = sum(now.values()), {name: [] for name in now}
        for slot, name in enumerate(timetable(now)):
            slots[name].append(slot)
        ends = lambda name: (left[name] - 1) // now[name] * period + slots[name][(left[name] - 1) % now[name]] + 1
        length = min(map(ends, now))
        out.append(Phase(start, period, now, {name: done[name] for name in now}, slots, length))
        for name in now:
            used = length // period * now[name] + sum(s < length % period for s in slots[name])
            done[name] += used
            left[name] -= used
        left = {name: n for name, n in left.items() if n}
        start += length
    return out


def mix_sources(
    df: DataFrame, shares: Mapping[str, int], block_chars: int = 16_384, rest_share: int = 1,
    doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> DataFrame:
    """Add to (doc_id, source) of every row: mix_class, block, phase, release, deadline, slot, mix_offset.

    ``shares`` gives whole numbers; sources that it does not name, null too, are one class with
    ``rest_share``. The volume of a row is the length of its text; a block holds the rows that begin
    within its ``block_chars`` characters, in the order of doc_id, then source and text length. A long
    row covers blocks of its own source that then hold no beginning. Release, deadline and slot count
    from the beginning of all; ``mix_offset`` is the slot's first character plus the row's place in its
    block: sorting by it, then doc_id, is the mix. Null or empty texts take no room. Repeated rows stay,
    an empty table gives an empty result.

    Only one volume per class reaches the driver. Rows are summed up by ranges of ids, so a source
    with most of the rows is spread over all tasks; the timetables are joined as a table whose size
    depends on the shares alone.
    """
    if any(s < 1 for s in [*shares.values(), rest_share]):
        raise ValueError("shares are whole numbers of 1 or more")
    spark = df.sparkSession
    named = F.col(source).isin(*shares) if shares else F.lit(False)
    rows = df.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.when(named, F.col(source)).otherwise(F.lit(REST)).alias("mix_class"),
        F.coalesce(F.length(F.col(text)), F.lit(0)).cast("long").alias("volume"),
    )
    placed = running_total(rows, "mix_class", ["doc_id", "source", "volume"], "volume", "before")
    volumes = {r["mix_class"]: r["v"] for r in rows.groupBy("mix_class").agg(F.sum("volume").alias("v")).collect()}
    blocks = {name: max(1, -(-v // block_chars)) for name, v in volumes.items()}
    plan = phases({**shares, REST: rest_share}, blocks)
    cells = [
        (name, n, p.start, p.period, p.shares[name], p.first[name],
         plan[n + 1].first[name] if n + 1 < len(plan) and name in plan[n + 1].first else blocks[name], p.slots[name])
        for n, p in enumerate(plan) for name in p.shares
    ]
    names = ["mix_class", "phase", "_start", "_period", "_share", "_first", "_end", "_slots"]
    kinds = "array<struct<mix_class:string,phase:int,_start:long,_period:long,_share:long,_first:long,_end:long,_slots:array<long>>>"
    written = json.dumps([dict(zip(names, cell)) for cell in cells])
    table = spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(written), kinds)))
    j = F.col("block") - F.col("_first")
    count = F.from_json(F.lit(json.dumps(blocks)), "map<string,long>")
    return (
        placed.withColumn("block", F.least(F.floor(F.col("before") / block_chars), F.element_at(count, F.col("mix_class")) - 1))
        .join(F.broadcast(table), "mix_class").where("block >= _first and block < _end")
        .select(
            "doc_id", "source", "mix_class", "block", "phase", "volume",
            (F.col("_start") + F.floor(j * F.col("_period") / F.col("_share"))).alias("release"),
            (F.col("_start") + F.ceil((j + 1) * F.col("_period") / F.col("_share"))).alias("deadline"),
            (F.col("_start") + F.floor(j / F.col("_share")) * F.col("_period")
             + F.get("_slots", (j % F.col("_share")).cast("int"))).alias("slot"),
            (F.col("before") - F.col("block") * block_chars).alias("_in"),
        )
        .withColumn("mix_offset", F.col("slot") * block_chars + F.col("_in")).drop("_in")
    )
