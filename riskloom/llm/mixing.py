"""Mixing sources to target weights (operator 8).

Documents may belong to several sources.  They are aggregated by membership
pattern (the set of their sources); a pattern's tokens can be taken up to
``max_repeats`` times, each repetition at a higher, convex cost.  A min-cost
flow routes the patterns' tokens to the sources' quotas.  Then documents are
selected: every document of a pattern is taken as often as the flow has whole
passes over the pattern, and a seeded order of the pattern's documents fills
the rest of each source's share.

Sources and their targets are a Spark table of any size.  A source that
overlaps with no other has one pattern, whose flow is its quota; only the
patterns of overlapping sources reach the driver for the flow, which is
sequential: more than ``max_patterns`` of those raise.  Running sums in the seeded order are taken within buckets
and shifted by the buckets' totals, so a source of any size is dealt to many
tasks.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.session import discard, written

from .common import record, utf8


class Flow:
    """Min-cost flow by successive shortest paths with potentials (costs >= 0)."""

    def __init__(self, n: int) -> None:
        self.out: list[list[int]] = [[] for _ in range(n)]
        self.to: list[int] = []
        self.room: list[int] = []
        self.cost: list[int] = []

    def arc(self, a: int, b: int, room: int, cost: int) -> int:
        for x, y, r, c in ((a, b, room, cost), (b, a, 0, -cost)):
            self.out[x].append(len(self.to))
            self.to.append(y)
            self.room.append(r)
            self.cost.append(c)
        return len(self.to) - 2

    def run(self, source: int, sink: int) -> None:
        """As much flow as there is, at the least cost."""
        high = [0] * len(self.out)
        while True:
            dist, via, heap = {source: 0}, {}, [(0, source)]
            done = set()
            while heap:
                d, x = heapq.heappop(heap)
                if x in done:
                    continue
                done.add(x)
                for e in self.out[x]:
                    y, nd = self.to[e], d + self.cost[e] + high[x] - high[self.to[e]]
                    if self.room[e] and nd < dist.get(y, 1 << 62):
                        dist[y], via[y] = nd, e
                        heapq.heappush(heap, (nd, y))
            if sink not in dist:
                return
            far = max(dist.values())
            for x in range(len(high)):
                high[x] += dist.get(x, far)
            path, x = [], sink
            while x != source:
                path.append(via[x])
                x = self.to[via[x] ^ 1]
            step = min(self.room[e] for e in path)
            for e in path:
                self.room[e] -= step
                self.room[e ^ 1] += step


def targets(sizes: list[int], weights: list[float], total: int, max_repeats: int) -> list[float]:
    """Shares of ``total`` by weight; none above ``max_repeats`` times its size, what is beyond is shared again."""
    out, free, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / weight > max_repeats * sizes[i]}
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight
            return out
        for i in over:
            out[i] = float(max_repeats * sizes[i])
            left -= out[i]
        free -= over
    return out


def ranked(sources: DataFrame) -> DataFrame:
    """``rank`` (from 0) of the sources in code point order, null last; they are sorted by ranges."""
    order = [F.col("source").isNull(), F.col("source")]
    parts = written(sources.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # over a row per range
    shifts = (parts.groupBy("part").agg(F.count("*").alias("n"))
              .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return parts.withColumn("place", place).join(shifts, "part").withColumn("rank", F.col("shift") + F.col("place")).drop(
        "part", "place", "shift")


def source_targets(sources: DataFrame, total: int, max_repeats: int) -> DataFrame:
    """`targets` of a table of sources (``own``, ``weight``), as its column ``target``.

    Each pass finds the sources above their limit at the level of the pass before, until there are no more of them.
    """
    limit, n = (max_repeats * F.col("own")).cast("double"), 0
    left, free = float(total), sources.agg(F.sum("weight")).first()[0]
    while free:
        share = F.lit(left) * F.col("weight") / F.lit(free)
        over = share > limit
        found = sources.agg(F.count_if(over), F.sum(F.when(over, limit)), F.sum(F.when(~over, F.col("weight")))).first()
        if found[0] == n:
            return sources.withColumn("target", F.when(over, limit).otherwise(share))
        n, left, free = found[0], total - found[1], found[2]
    return sources.withColumn("target", limit)


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], max_repeats: int) -> list[dict[int, int]]:
    """Tokens that each pattern (its sources, its size) gives to each source.

    The k-th pass over a pattern costs k: spreading over patterns comes before
    repeating one.
    """
    n = len(patterns)
    flow = Flow(n + len(quotas) + 2)
    source, sink = n + len(quotas), n + len(quotas) + 1
    arcs: list[dict[int, int]] = []
    for p, (members, size) in enumerate(patterns):
        for k in range(max_repeats):
            flow.arc(source, p, size, k + 1)
        arcs.append({s: flow.arc(p, n + s, max_repeats * size, 0) for s in members})
    for s, quota in enumerate(quotas):
        flow.arc(n + s, sink, quota, 0)
    flow.run(source, sink)
    return [{s: flow.room[e + 1] for s, e in own.items()} for own in arcs]


SIZED = pa.schema([("doc_id", pa.int64()), ("pattern", pa.string()), ("key", pa.string()), ("size", pa.int64())])


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [len(raw.split()) for raw in utf8(batch.column("text"))]
        yield record(SIZED, size=sizes, **{c: batch.column(c) for c in ("doc_id", "pattern", "key")})


def order_key(id_col: str, text_col: str, seed: int = 5) -> Column:
    """A document's place in the seeded order."""
    name, text = F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.coalesce(F.col(text_col), F.lit(""))
    return F.md5(F.concat_ws(":", F.lit(str(seed)), name, F.md5(text)))


def mix(docs: DataFrame, weights: tuple[float, ...] = (1, 2, 3), max_repeats: int = 3, seed: int = 5,
        sources_col: str = "source", id_col: str = "doc_id", text_col: str = "text", total: int | None = None,
        rows_per_bucket: int = 1_000, max_patterns: int = 10_000) -> DataFrame:
    """(doc_id, key, size, source_size, target, taken) of every document.

    ``sources_col`` is a string (one source) or an array of strings (the
    sources that hold the document); null is a source of its own.  Sources in
    code point order, null last, weigh ``weights`` in turn and share ``total``
    words (all words of the documents, if not given).  ``taken`` counts words
    with repeats: whole passes over a document, and in each pattern one
    document may be taken in part, so that sources meet their targets.
    ``source_size`` and ``target`` are those of the first source.  ``key`` is
    the document's place in the seeded order; it is the same for rows of one
    id and text.

    A null, empty or blank text has size 0 and takes nothing.  Repeated rows
    are judged one by one; a null id is an id like others.  An empty table
    gives no rows; other columns are neither read nor returned.  The order
    depends on the seed, ids and texts only.
    """
    spark = docs.sparkSession
    many = dict(docs.dtypes)[sources_col].startswith("array")
    sources = F.col(sources_col).cast("array<string>") if many else F.array(F.col(sources_col).cast("string"))
    sources = F.when(F.size(sources) > 0, F.sort_array(F.array_distinct(sources))).otherwise(F.array(F.lit(None).cast("string")))
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.to_json(sources).alias("pattern"),
                       order_key(id_col, text_col, seed).alias("key"), text.alias("text"))
    sized = written(rows.mapInArrow(_sizes, "doc_id long, pattern string, key string, size long"))

    patterns = written(sized.groupBy("pattern").agg(F.sum("size").alias("words"), F.count("*").alias("docs")))
    members = patterns.select("pattern", "words", F.explode(F.from_json("pattern", "array<string>")).alias("source"))
    members = members.withColumn("tag", F.to_json(F.array("source")))  # a null source has a tag, too
    one = F.col("pattern") == F.col("tag")
    own = written(ranked(members.groupBy("tag", "source").agg(F.sum("words").alias("own"), (~F.every(one)).alias("overlaps"))))
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("rank") % len(weights) + 1).cast("int"))
    words = patterns.agg(F.sum("words")).first()[0] or 0 if total is None else total
    goals = written(source_targets(own.withColumn("weight", weight), words, max_repeats)
                    .withColumn("quota", F.floor(F.col("target") + 0.5)))
    first = F.min_by(F.struct("own", "target", "quota"), "rank").alias("first")
    judged = members.join(goals, "tag").groupBy("pattern").agg(first, F.bool_or("overlaps").alias("overlaps"))
    judged = written(patterns.join(judged, "pattern").select(
        "pattern", "words", "docs", F.col("first.own").alias("source_size"), "first.target", "first.quota", "overlaps"))

    routed = judged.where("overlaps").select("pattern", "words").limit(max_patterns + 1).collect()
    if len(routed) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns of overlapping sources")
    met = [json.loads(r["pattern"]) for r in routed]
    quotas = {r["source"]: int(r["quota"]) for r in (goals.where("overlaps").collect() if routed else [])}
    names = sorted(quotas, key=lambda s: (s is None, s or ""))
    number = {s: i for i, s in enumerate(names)}
    arcs = sorted((tuple(number[s] for s in p), int(r["words"]), r["pattern"]) for p, r in zip(met, routed, strict=True))
    given = route([a[:2] for a in arcs], [quotas[s] for s in names], max_repeats)
    flow = spark.createDataFrame([(a[2], sum(g.values())) for a, g in zip(arcs, given, strict=True)], "pattern string, given long")
    taken = judged.join(flow, "pattern", "left").withColumn("given", F.when(F.col("overlaps"), F.col("given")).otherwise(F.col("quota")))
    plan = written(taken.select(
        "pattern", "source_size", "target", F.ceil(F.col("docs") / rows_per_bucket).alias("buckets"),
        *(F.when(F.col("words") > 0, F.expr(e)).otherwise(0).alias(c) for c, e in
          (("passes", "given div nullif(words, 0)"), ("rest", "given % nullif(words, 0)")))))
    small = plan.count() <= max_patterns  # a larger plan is joined by pattern
    for used in (patterns, own, goals, judged):
        discard(used)

    # the key's first 32 bits split a pattern's order into buckets
    place = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * F.col("buckets")
    placed = sized.join(F.broadcast(plan) if small else plan, "pattern").withColumn("bucket", F.shiftright(place, 32))
    before = lambda c, w: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = (placed.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"))
              .select("pattern", "bucket", before("words", Window.partitionBy("pattern").orderBy("bucket")).alias("shift")))
    ordered = placed.withColumn("before", before("size", Window.partitionBy("pattern", "bucket").orderBy("key", "doc_id")))
    part = F.least("size", F.greatest(F.lit(0), F.col("rest") - F.col("before") - F.col("shift")))
    return ordered.join(shifts, ["pattern", "bucket"]).select(
        "doc_id", "key", "size", "source_size", "target", (F.col("passes") * F.col("size") + part).alias("taken"))


def mix_sql(documents: str = "documents", weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3, seed: int = 5) -> str:
    """DuckDB SQL of `mix` over single sources: the flow has a closed form there."""
    weight = f"list_value({', '.join(map(str, weights))})[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}]"
    return f"""
    WITH sized AS (
      SELECT doc_id, source,
             len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
             md5(concat_ws(':', '{seed}', coalesce(doc_id::VARCHAR, '-'), md5(coalesce(text, '')))) AS key
      FROM {documents}),
    sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
    weighed AS (SELECT *, {weight}::DOUBLE AS w, sum(source_size) OVER ()::DOUBLE AS total FROM sources),
    ranked AS (SELECT *, {max_repeats}.0 * source_size / w AS ratio FROM weighed),
    levels AS (
      SELECT *, total - coalesce(sum({max_repeats} * source_size) OVER (ORDER BY ratio, source NULLS LAST
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS rest,
             sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
      FROM ranked),
    level AS (SELECT arg_min(rest, ratio) AS rest, arg_min(free, ratio) AS free FROM levels WHERE rest / free <= ratio),
    goals AS (
      SELECT s.source, s.source_size,
             CASE WHEN l.rest IS NULL OR l.rest * s.w / l.free > {max_repeats} * s.source_size
                  THEN ({max_repeats} * s.source_size)::DOUBLE ELSE l.rest * s.w / l.free END AS target
      FROM weighed s CROSS JOIN level l),
    quotas AS (SELECT *, floor(target + 0.5)::BIGINT AS quota FROM goals),
    placed AS (
      SELECT d.*, q.source_size, q.target,
             CASE WHEN q.source_size > 0 THEN q.quota // q.source_size ELSE 0 END AS passes,
             CASE WHEN q.source_size > 0 THEN q.quota % q.source_size ELSE 0 END AS left_over,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY key, doc_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM sized d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source)
    SELECT doc_id, key, size, source_size, target,
           (passes * size + least(size, greatest(0, left_over - before)))::BIGINT AS taken
    FROM placed"""
