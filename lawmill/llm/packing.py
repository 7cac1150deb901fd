"""Texts of varying length combined into containers of fixed capacity.

Method: bin completion. Around the largest text not yet packed, a branch-and-bound search
enumerates the undominated fillings of the room it leaves, largest text first, prunes what
can't waste less than the incumbent (at first the best-fit filling), and closes the
container. A filling is dominated if one more text goes in, if a larger text
goes into the place of one of its own, or if two of its texts could give way to one of their joint size. Where
the containers so filled are more than the lower bound, the search goes back over the choice of fillings,
pruned by the waste that one container fewer allows. Both searches end after a number of nodes (``NODES``,
``CONTAINERS``; None: never, which is exact), and the incumbent is taken. Texts of one size are alike, so the search runs on the
histogram of sizes, size by multiplicity and without recursion: a filling is repeated as often as the counts allow, and the
histogram has at most as many rows as the capacity has tokens, whatever the corpus. One task packs one capacity; which texts go
where is a join of every text's rank within its size with the ranges of the fillings.

Ranks are numbered in two steps (within a salt, plus the counts of the salts before), so that a
size that a third of the texts share is never one task's group.

Defined results: a text longer than the capacity, and no other, is split: into pieces that
fill a container each, and a rest that is packed like any text; a text without tokens needs no
container (bin_id null); repeated rows of a doc_id are packed each; a null size counts as none;
columns named like the result's are replaced.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lawmill.session import stage

SALTS = 64
MAX_TARGETS = 1000
#: Nodes looked at around one largest text, and containers chosen anew, before the incumbent is taken.
NODES, CONTAINERS = 3_000, 2_000


def best_fit(sizes: list[int], counts: dict[int, int], room: int) -> tuple[list[tuple[int, int]], int]:
    """The filling that takes the largest size that goes in, again and again, as (size, how many), and its waste; ``sizes`` rise."""
    out, i = [], bisect_right(sizes, room) - 1
    while i >= 0:
        n = min(counts[sizes[i]], room // sizes[i])
        if n:
            out.append((sizes[i], n))
            room -= sizes[i] * n
        i = min(i - 1, bisect_right(sizes, room) - 1)
    return out, room


def _open(sizes: list[int], counts: dict[int, int], used: dict[int, int], rest: int) -> bool:
    """Whether one more text would go into the rest, or a larger one into the place of one that is in."""
    return any(counts[s] > used.get(s, 0) for c in (0, *used) for s in sizes[bisect_right(sizes, c) : bisect_right(sizes, c + rest)])


def fillings(sizes: list[int], counts: dict[int, int], room: int, most_waste: Callable[[], int], nodes: int | None) -> Iterator[tuple[list[tuple[int, int]], int]]:
    """The undominated fillings of ``room`` that waste at most what ``most_waste`` says at the time, largest sizes first."""
    below = [0]
    for s in sizes:
        below.append(min(room, below[-1] + s * counts[s]))
    chosen: list[tuple[int, int]] = []
    stack = [[bisect_right(sizes, room) - 1, 0, room]]  # a size's place, how many of it are tried (0: none yet), the room there
    seen = 0
    while stack:
        i, m, r = frame = stack[-1]
        if m:
            chosen.pop()
            m -= 1
        elif i < 0 or r - below[i + 1] > most_waste():
            stack.pop()
            continue
        else:
            m = min(counts[sizes[i]], r // sizes[i])
        seen += 1
        if nodes is not None and seen > nodes:
            return
        if not m:
            frame[0], frame[1] = i - 1, 0
            continue
        s, rest = sizes[i], r - sizes[i] * m
        if rest - below[i] > most_waste():  # fewer of this size waste more still
            frame[0], frame[1] = -1, 0
            continue
        frame[1] = m
        used = dict(chosen)
        dominated = any(counts.get(c + s, 0) > used.get(c + s, 0) for c in used) or m > 1 and counts.get(2 * s, 0) > used.get(2 * s, 0)
        chosen.append((s, m))
        if dominated:
            continue
        j = min(i - 1, bisect_right(sizes, rest) - 1)
        if j >= 0:
            stack.append([j, 0, rest])
        elif rest <= most_waste() and not _open(sizes, counts, dict(chosen), rest):
            yield list(chosen), rest


def complete(sizes: list[int], counts: dict[int, int], room: int, nodes: int | None = NODES) -> list[tuple[int, int]]:
    """The filling of ``room`` that wastes least, as (size, how many)."""
    best, waste = best_fit(sizes, counts, room)
    if waste:
        for best, waste in fillings(sizes, counts, room, lambda: waste - 1, nodes):
            if not waste:
                break
    return best


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Containers that any packing needs: by the sum of sizes, and by the texts that can't share a container."""
    sizes = sorted(s for s, n in counts.items() if n)
    number, total = [0], [0]
    for s in sizes:
        number.append(number[-1] + counts[s])
        total.append(total[-1] + s * counts[s])
    half = bisect_right(sizes, capacity // 2)
    best = -(-total[-1] // capacity)
    for k in range(half + 1):  # texts below sizes[k] are left out
        alone = max(half, bisect_right(sizes, capacity - sizes[k]) if k < half else len(sizes))  # beyond, nothing of size k or more goes beside
        room = (number[alone] - number[half]) * capacity - (total[alone] - total[half])
        best = max(best, number[-1] - number[half] + max(0, -(-(total[half] - total[k] - room) // capacity)))
    return best


Packed = list[tuple[tuple[tuple[int, int], ...], int]]


def _descend(counts: dict[int, int], capacity: int, nodes: int | None) -> Packed:
    sizes = sorted(counts)
    out: Packed = []
    while sizes:
        top = sizes[-1]
        counts[top] -= 1
        if not counts[top]:
            sizes.pop()
        filling = dict(complete(sizes, counts, capacity - top, nodes))
        filling[top] = filling.get(top, 0) + 1
        counts[top] += 1
        if sizes[-1:] != [top]:
            sizes.append(top)
        times = min(counts[s] // n for s, n in filling.items())
        for s, n in filling.items():
            counts[s] -= n * times
            if not counts[s]:
                sizes.pop(bisect_right(sizes, s) - 1)
        out.append((tuple(sorted(filling.items(), reverse=True)), times))
    return out


def _search(counts: dict[int, int], capacity: int, spare: int, nodes: int | None, containers: int | None) -> Packed | None:
    """A packing that wastes no more than ``spare`` in all, if the search finds one: a choice of filling a container, gone back on."""
    sizes = sorted(counts)

    def take(filling: dict[int, int], sign: int) -> None:
        for s, n in filling.items():
            if sign < 0 and counts[s] == n:
                sizes.pop(bisect_right(sizes, s) - 1)
            if sign > 0 and not counts[s]:
                sizes.insert(bisect_right(sizes, s), s)
            counts[s] += sign * n

    def choices(left: int) -> Iterator[tuple[dict[int, int], int]]:
        top = sizes[-1]
        take({top: 1}, -1)
        found = sorted(fillings(list(sizes), dict(counts), capacity - top, lambda: left, nodes), key=lambda f: f[1]) if sizes and sizes[0] <= capacity - top else [([], capacity - top)]
        take({top: 1}, 1)
        for filling, waste in found:
            if waste <= left:
                f = dict(filling)
                f[top] = f.get(top, 0) + 1
                yield f, waste

    path: list[tuple[dict[int, int], int]] = []
    stack = [choices(spare)]
    seen = 0
    while sizes:
        step = next(stack[-1], None)
        seen += 1
        if containers is not None and seen > containers:
            return None
        if step is None:
            stack.pop()
            if not path:
                return None
            f, waste = path.pop()
            take(f, 1)
            spare += waste
            continue
        path.append(step)
        take(step[0], -1)
        spare -= step[1]
        if sizes:
            stack.append(choices(spare))
    return [(tuple(sorted(f.items(), reverse=True)), 1) for f, _ in path]


def pack_sizes(counts: dict[int, int], capacity: int, nodes: int | None = NODES, containers: int | None = CONTAINERS) -> Packed:
    """(sizes of a container as (size, how many), how many containers are filled so), for texts no longer than the capacity."""
    counts = {s: n for s, n in counts.items() if s > 0 and n > 0}
    best = _descend(dict(counts), capacity, nodes)
    total, least = sum(s * n for s, n in counts.items()), lower_bound(counts, capacity)
    while (bins := sum(n for _, n in best)) > least:
        better = _search(dict(counts), capacity, (bins - 1) * capacity - total, nodes, containers)
        if better is None:
            break
        best = better
    return best


RANGES = "target_id int, tokens bigint, first bigint, last bigint, per_bin bigint, first_bin bigint"


def _pack(nodes: int | None, containers: int | None):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        target, capacity = int(group["target_id"].iloc[0]), int(group["capacity"].iloc[0])
        rows, at, bins = [], {}, 0
        for filling, times in pack_sizes(dict(zip(group["tokens"].tolist(), group["n"].tolist())), capacity, nodes, containers):
            for s, n in filling:
                a = at.get(s, 0)
                rows.append((target, s, a, a + n * times - 1, n, bins))
                at[s] = a + n * times
            bins += times
        return pd.DataFrame(rows, columns=["target_id", "tokens", "first", "last", "per_bin", "first_bin"])

    return run


def pack(sizes: DataFrame, targets: DataFrame, salts: int = SALTS, nodes: int | None = NODES, containers: int | None = CONTAINERS) -> DataFrame:
    """(target_id, capacity, doc_id, piece_no, tokens, bin_id): every piece of every text of ``sizes``
    (doc_id, tokens) in a container of each capacity in ``targets`` (target_id, capacity).

    Containers of a target are numbered from 0, those that pieces of full size fill come last.
    """
    wanted = targets.where("capacity > 0").select("target_id", "capacity").distinct().limit(MAX_TARGETS + 1).collect()
    if len(wanted) > MAX_TARGETS:
        raise ValueError(f"more than {MAX_TARGETS} capacities")
    each = F.array(*(F.struct(F.lit(r.target_id).cast("int").alias("target_id"), F.lit(r.capacity).cast("int").alias("capacity")) for r in wanted)) if wanted else F.expr("array_remove(array(struct(0 AS target_id, 1 AS capacity)), struct(0 AS target_id, 1 AS capacity))")
    s = sizes.select("doc_id", F.coalesce(F.col("tokens"), F.lit(0)).cast("bigint").alias("tokens"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"))
    s = s.withColumn("t", F.explode(each)).select("doc_id", "tokens", "salt", "t.*").withColumn("full", F.expr("tokens div capacity")).withColumn("rest", F.col("tokens") % F.col("capacity"))
    rest = s.where("rest > 0")
    held = rest.groupBy("target_id", "capacity", "rest", "salt").agg(F.count("*").alias("n"))
    held = stage(held, "packing-counts")  # at most capacity x salts rows a target
    before = held.withColumn("before", F.coalesce(F.sum("n").over(W.partitionBy("target_id", "rest").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    histogram = held.groupBy("target_id", "capacity", F.col("rest").alias("tokens")).agg(F.sum("n").alias("n"))
    # a number of partitions that is asked for isn't folded: each capacity is a task of its own
    ranges = histogram.repartition(4 * max(1, len(wanted)), "target_id").groupBy("target_id").applyInPandas(_pack(nodes, containers), RANGES)
    ranges = stage(ranges, "packing-ranges")
    ranked = rest.withColumn("k", F.row_number().over(W.partitionBy("target_id", "rest", "salt").orderBy("doc_id")) - 1)
    ranked = ranked.join(before.select("target_id", "rest", "salt", "before"), ["target_id", "rest", "salt"]).withColumn("rank", F.col("k") + F.col("before"))
    r = ranges.alias("r")
    on = (F.col("m.target_id") == F.col("r.target_id")) & (F.col("m.rest") == F.col("r.tokens")) & F.col("rank").between(F.col("first"), F.col("last"))
    placed = ranked.alias("m").join(r, on).select(
        "m.target_id", "capacity", "doc_id", F.col("full").cast("int").alias("piece_no"), F.col("m.rest").alias("tokens"),
        (F.col("first_bin") + F.floor((F.col("rank") - F.col("first")) / F.col("per_bin")).cast("bigint")).alias("bin_id"),
    )
    none = s.where("tokens = 0").select("target_id", "capacity", "doc_id", F.lit(0).alias("piece_no"), F.lit(0).cast("bigint").alias("tokens"), F.lit(None).cast("bigint").alias("bin_id"))
    # pieces of full size: numbered per salt, after all other containers
    used = ranges.groupBy("target_id").agg(F.max(F.col("first_bin") + F.expr("(last - first + 1) div per_bin")).alias("used"))
    big = s.where("full > 0").withColumn("upto", F.sum("full").over(W.partitionBy("target_id", "salt").orderBy("doc_id", "tokens").rowsBetween(W.unboundedPreceding, W.currentRow)))
    per_salt = s.where("full > 0").groupBy("target_id", "salt").agg(F.sum("full").alias("n"))
    per_salt = per_salt.withColumn("offset", F.coalesce(F.sum("n").over(W.partitionBy("target_id").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    whole = big.join(per_salt.select("target_id", "salt", "offset"), ["target_id", "salt"]).join(used, "target_id", "left")
    whole = whole.withColumn("piece_no", F.explode(F.sequence(F.lit(0), F.col("full").cast("int") - 1))).select(
        "target_id", "capacity", "doc_id", "piece_no", F.col("capacity").cast("bigint").alias("tokens"),
        (F.coalesce("used", F.lit(0)) + F.col("offset") + F.col("upto") - F.col("full") + F.col("piece_no")).cast("bigint").alias("bin_id"),
    )
    return placed.unionByName(whole).unionByName(none)


def usage(packed: DataFrame) -> DataFrame:
    """(target_id, capacity, bins, tokens, least_bins, fill): how well each capacity is used. The least number is by the sum of sizes."""
    u = packed.where("bin_id is not null").groupBy("target_id", "capacity").agg((F.max("bin_id") + 1).alias("bins"), F.sum("tokens").alias("tokens"))
    return u.withColumn("least_bins", F.ceil(F.col("tokens") / F.col("capacity"))).withColumn("fill", F.round(F.col("tokens").cast("double") / (F.col("bins") * F.col("capacity")), 6))
