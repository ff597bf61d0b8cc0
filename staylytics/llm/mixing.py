"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they count for). Words flow from
patterns to source quotas; the first pass over a pattern is free and each further one costs
more, so a document is repeated only when no fresh words are left for a quota. The network has a node for each
pattern and source, whatever the number of documents. Then seeded documents are selected: those
below a cut in hash order whose sizes sum up to the flow, found by histograms.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from staylytics.llm.common import WORD
from staylytics.llm.cuts import KEYS, weighted_cuts
from staylytics.sources import materialize

Pattern = tuple[str | None, ...]
#: Patterns and sources are listed on the driver and sent to every task; more than this raises.
MAX_PATTERNS = 100_000


def targets(sizes: dict[str | None, int], weights: Sequence[float] = (3, 1, 2), share: float = 1.5, repeats: int = 2, total: int | None = None) -> dict[str | None, float]:
    """Words wanted of each source: ``share`` of all (the sum of sizes, or ``total`` where sources overlap), split by weight, none above ``repeats`` times the source.

    Sources are ordered by code point with null last, and the weights repeat along that order.
    What a full source cannot take is shared by weight among the others, until none is above.
    """
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(weights[i % len(weights)]) for i, s in enumerate(order)}
    left, rest, out = share * (sum(sizes.values()) if total is None else total), set(order), {}
    while rest:
        parts = sum(weight[s] for s in rest)
        full = [s for s in rest if left * weight[s] / parts > repeats * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / parts for s in rest}
        out |= {s: float(repeats * sizes[s]) for s in full}
        left -= sum(out[s] for s in full)
        rest.difference_update(full)
    return out


def route(words: dict[Pattern, float], quotas: dict[str | None, float], repeats: int = 2) -> dict[Pattern, float]:
    """Words to take from each pattern: a maximum flow to the quotas of least repetition cost.

    Shortest paths first; pass ``k`` over a pattern costs ``k`` a word, so costs are convex. Only the first step of a path
    costs anything, and no shortest path comes back to the start, so all paths of cost ``k`` are found before those of ``k + 1``. What a
    pattern has left goes to its sources while they have room; where they have none, along a chain of sources, each of which passes on
    words of a pattern that also counts for the next. A chain is searched over sources alone, of which there are few.
    """
    room = {s: float(q) for s, q in quotas.items()}
    least = 1e-6 * max(1.0, sum(room.values())) / max(1, len(room))
    flows: dict[Pattern, dict[str | None, float]] = {p: {} for p in words}
    movable: dict[str | None, dict[str | None, dict[Pattern, None]]] = {s: {} for s in room}  # source, next source, patterns that can pass words on
    taken = dict.fromkeys(words, 0.0)

    def give(p: Pattern, s: str | None, by: float) -> None:
        flows[p][s] = flows[p].get(s, 0.0) + by
        held = flows[p][s] > least
        for t in p:
            if t != s:
                if held:
                    movable[s].setdefault(t, {})[p] = None
                else:
                    movable[s].get(t, {}).pop(p, None)

    def chain(p: Pattern) -> list[tuple[str | None, Pattern | None]]:
        """Sources from one of the pattern's to one with room, each with the pattern whose words go on to it (none for the first)."""
        via: dict[str | None, tuple[str | None, Pattern | None]] = {s: (s, None) for s in p}
        queue = list(via)
        for s in queue:
            if room[s] > least:
                out = []
                while via[s][1] is not None:
                    out.append((s, via[s][1]))
                    s = via[s][0]
                return [*out, (s, None)][::-1]
            for t, carriers in movable[s].items():
                if carriers and t not in via:
                    via[t] = (s, next(iter(carriers)))
                    queue.append(t)
        return []

    for _ in range(repeats):
        for p, n in words.items():
            left = float(n)
            while left > least and (path := chain(p)):
                by = min([left, room[path[-1][0]], *[flows[q][s] for (s, _), (_, q) in zip(path, path[1:])]])
                for (s, _), (t, q) in zip(path, path[1:]):
                    give(q, s, -by)
                    give(q, t, by)
                give(p, path[0][0], by)
                room[path[-1][0]] -= by
                taken[p] += by
                left -= by
    return taken


def _size(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(id_column: str, text_column: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.col(id_column), F.col(text_column)), F.lit(KEYS))


def _pattern(members: Column) -> Column:
    return F.to_json(F.struct(F.array_sort(F.array_distinct(members)).alias("m")), {"ignoreNullFields": "false"})


def mix(
    docs: DataFrame,
    members: Column | None = None,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    seed: int = 7,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    precise: float = 0.001,
) -> DataFrame:
    """(row struct, size, source_size, target, taken) for every row of ``docs``; ``row`` holds all its columns.

    ``members`` is an array of the sources a document counts for; by default its own source alone. ``taken`` is 0,
    or the size once for each time the document is in the mix (at most ``repeats``); ``source_size`` and ``target`` belong to the source column
    (null where no document counts for it). A text that is null or has no words has size 0 and takes nothing. A null source is one source, the last.
    Documents are never cut, so a source misses its target by less than its smallest document left out, or
    by ``precise`` of the target. Rows of equal id and text are taken together; the same table and seed
    give the same mix. An empty table gives an empty table.
    """
    own = F.array(F.col(source_column).cast("string")) if members is None else members
    rows = docs.select(_key(id_column, text_column, seed).alias("key"), _size(F.col(text_column)).alias("size"), F.array_distinct(own).alias("members"))
    rows = materialize(rows.withColumn("pattern", _pattern(F.col("members"))), "mix")
    patterns = rows.groupBy("pattern").agg(F.first("members").alias("m"), F.sum("size").alias("words"))
    patterns = patterns.limit(MAX_PATTERNS + 1).collect()
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of membership, which is as many as the network is for")
    words = {tuple(r["m"]): int(r["words"]) for r in patterns}
    sizes: dict[str | None, int] = {}
    for p, n in words.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + n
    wanted = targets(sizes, weights, share, repeats, total=sum(words.values()))
    flow = route({p: float(n) for p, n in words.items() if n}, wanted, repeats)
    plan = []
    for g, r in enumerate(patterns):
        n, take = int(r["words"]), flow.get(tuple(r["m"]), 0.0)
        passes = min(repeats, int(take / n + 1e-9)) if n else 0
        plan.append([g, r["pattern"], passes, max(0.0, take - passes * n) if passes < repeats and n else 0.0])
    chosen = _select(rows, plan, precise)
    schema = "pattern string, passes int, parts array<struct<lo: long, hi: long, most: long>>"
    table = docs.sparkSession.createDataFrame([(p, k, chosen[g]) for g, p, k, _ in plan], schema)
    by_source = [(s, s is None, sizes[s], wanted[s]) for s in sizes]
    source_table = docs.sparkSession.createDataFrame(by_source, "name string, none boolean, source_size long, target double")

    source = F.col(source_column).cast("string")
    out = docs.select(
        F.struct("*").alias("row"),
        _size(F.col(text_column)).alias("size"),
        _key(id_column, text_column, seed).alias("key"),
        _pattern(own).alias("pattern"),
        F.coalesce(source, F.lit("")).alias("name"),
        source.isNull().alias("none"),
    )
    out = out.join(F.broadcast(table), "pattern", "left")
    out = out.join(F.broadcast(source_table.fillna("", "name")), ["name", "none"], "left")
    again = F.exists("parts", lambda x: (F.col("key") >= x["lo"]) & (F.col("key") < x["hi"]) & (F.col("size") <= x["most"]))
    times = F.coalesce("passes", F.lit(0)) + F.coalesce(again, F.lit(False)).cast("int")
    return out.select("row", "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def _select(rows: DataFrame, plan: Iterable[Sequence], precise: float) -> dict[int, list[tuple[int, int, int]]]:
    """For each pattern, ranges of hash keys (with a largest size) whose documents sum up to its remainder.

    The first range ends before the document that would be too much. The next ones go on behind it with
    documents small enough for what is left, until too little is left or no such document exists.
    """
    spark = rows.sparkSession
    left = {g: extra for g, _, _, extra in plan if extra > 0}
    whole = dict(left)
    chosen: dict[int, list[tuple[int, int, int]]] = {g: [] for g, *_ in plan}
    start = dict.fromkeys(left, 0)
    names = {g: p for g, p, *_ in plan}
    while left:
        limits = spark.createDataFrame([(g, names[g], start[g], int(left[g])) for g in left], "grp int, pattern string, start long, most long")
        fitting = rows.join(F.broadcast(limits), "pattern").where("key >= start and size between 1 and most")
        cuts = weighted_cuts(fitting.select("grp", "key", F.col("size").alias("weight")), left, slack=0.0)
        for g, (cut, got) in cuts.items():
            if got > 0:
                chosen[g].append((start[g], cut, int(left[g])))
            left[g] -= got
            if cut >= KEYS or left[g] <= max(0.5, precise * whole[g]):
                del left[g]
            else:
                start[g] = cut + (got == 0)
    return chosen
