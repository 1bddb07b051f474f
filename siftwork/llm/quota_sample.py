"""Samples that match target category proportions.

Method: min-cost flow on cross-classified cell counts, a cell being a target's category and a value of one other field.
Arcs carry the targets' margins and floors, the cells' availability and the other field's proportional margins; slack
arcs expose what a target lacks. The integer quotas of the cells are then drawn at random around their proportional
shares, along cycles of the same network, so that both margins hold and each share is met on average.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwork.functions.keys import norm_key, one_row_per
from siftwork.session import Spool, cut

FIELDS = ("category_code", "institution", "unit_code")
#: The field that crosses a plan's own one.
CROSSED = {"category_code": "institution", "institution": "category_code", "unit_code": "institution"}
#: Cells of one network. A plan with more cells is solved in blocks of consecutive cells: a target's demand is divided over
#: its blocks by its records there, so needs, shortfalls and quotas stay exact; the crossed margin is held in each block.
BLOCK_CELLS = 50_000
#: Hash buckets by which a cell's records are ranked without gathering the cell in one task.
BUCKETS = 1024
SLACK = 1_000_000
#: The unit in which fractions of a record are counted.
UNIT = 1 << 40


class Network:
    """Min-cost flow by successive shortest paths with potentials."""

    def __init__(self, nodes: int) -> None:
        self.to: list[int] = []
        self.cap: list[int] = []
        self.cost: list[int] = []
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def arc(self, a: int, b: int, cap: int, cost: int) -> int:
        """Number of the new arc from a to b; the flow on it is :meth:`flow`. Costs must not be negative."""
        k = len(self.to)
        for u, v, c, w in ((a, b, cap, cost), (b, a, 0, -cost)):
            self.out[u].append(len(self.to))
            self.to.append(v)
            self.cap.append(c)
            self.cost.append(w)
        return k

    def flow(self, k: int) -> int:
        return self.cap[k ^ 1]

    def solve(self, s: int, t: int) -> int:
        n, total = len(self.out), 0
        price = [0] * n
        while True:
            dist: list[float] = [math.inf] * n
            dist[s] = 0
            heap = [(0, s)]
            while heap:
                d, u = heapq.heappop(heap)
                if d > dist[u]:
                    continue
                for k in self.out[u]:
                    if self.cap[k] and (x := d + self.cost[k] + price[u] - price[self.to[k]]) < dist[self.to[k]]:
                        dist[self.to[k]] = x
                        heapq.heappush(heap, (x, self.to[k]))
            if dist[t] == math.inf:
                return total
            far = dist[t]
            price = [p + min(d, far) for p, d in zip(price, dist)]
            total += self._augment(s, t, price)

    def _augment(self, s: int, t: int, price: list) -> int:
        """A blocking flow over arcs of reduced cost 0."""
        total, at = 0, [0] * len(self.out)
        while True:
            path: list[int] = []
            on = {s}
            u = s
            while u != t:
                while at[u] < len(self.out[u]):
                    k = self.out[u][at[u]]
                    v = self.to[k]
                    if self.cap[k] and v not in on and self.cost[k] + price[u] - price[v] == 0:
                        break
                    at[u] += 1
                else:
                    if not path:
                        return total
                    on.discard(u)
                    u = self.to[path.pop() ^ 1]
                    at[u] += 1
                    continue
                path.append(k)
                on.add(v)
                u = v
            push = min(self.cap[k] for k in path)
            for k in path:
                self.cap[k] -= push
                self.cap[k ^ 1] += push
            total += push


@dataclass
class Piece:
    """A target's part of a block: what it asks for at least (``demand``, with ``floor`` of it), what is to be drawn, the
    records there, and its cells (value of the crossed field, records)."""

    demand: int
    floor: int
    take: int
    have: int
    cells: list[tuple[str, int]]


def solve_block(pieces: list[Piece], rng: np.random.Generator) -> tuple[list[int], list[list[int]]]:
    """(shortfalls, cell quotas) of one network.

    Source -> target: the demand. Target -> crossed value: a cell, its records the capacity; the whole part of its
    proportional share is free and sent ahead, more costs 1. Crossed value -> sink: its proportional share is free, more
    costs 2. Target -> sink: slack, dearer for units of the floor. What slack carries is the shortfall; what reaches the
    cells bounds what is drawn there by :func:`draw_cells`."""
    values = sorted({m for p in pieces for m, _ in p.cells})
    at = {m: 2 + len(pieces) + j for j, m in enumerate(values)}
    net = Network(2 + len(pieces) + len(values))
    margin, ahead = dict.fromkeys(values, 0.0), dict.fromkeys(values, 0)
    slack: list[tuple[int, int]] = []
    sent: list[int] = []
    for i, p in enumerate(pieces):
        reach = min(p.demand, p.have)
        free = 0
        for m, n in p.cells:
            base = reach * n // p.have
            free += base
            ahead[m] += base
            margin[m] += reach * n / p.have
            if n > base and reach > 0:
                net.arc(2 + i, at[m], n - base, 1)
        sent.append(free)
        net.arc(0, 2 + i, p.demand - free, 0)
        slack.append((net.arc(2 + i, 1, p.demand - p.floor, SLACK), net.arc(2 + i, 1, p.floor, 2 * SLACK)))
    for m in values:
        net.arc(at[m], 1, max(0, math.ceil(margin[m] - 1e-9) - ahead[m]), 0)
        net.arc(at[m], 1, sum(p.demand for p in pieces), 2)
    net.solve(0, 1)
    short = [net.flow(a) + net.flow(b) for a, b in slack]
    take = [min(p.take, p.demand - s) for p, s in zip(pieces, short)]
    return short, draw_cells([(t, p.have, p.cells) for t, p in zip(take, pieces)], rng)


def draw_cells(rows: list[tuple[int, int, list[tuple[str, int]]]], rng: np.random.Generator) -> list[list[int]]:
    """Whole quotas of the cells of each row (take, records, cells): each row sums to its take, each column of equal values
    to its proportional sum rounded up or down, each cell is its share rounded up or down and meets it on average.

    Cells whose share is a fraction lie on cycles that turn from row to column and back. Along a cycle, units are
    shifted from every second cell to the others, in either direction by odds that keep the averages, until one of the
    cells is whole. A further row takes what the columns lack to be whole."""
    quota = [[0] * len(cells) for _, _, cells in rows]
    part: list[int] = []  # fraction of each open cell, in UNITs
    where: list[tuple[int, int] | None] = []
    ends: list[tuple[int, int]] = []
    columns: dict[str, int] = {}
    sums: list[int] = []
    for i, (take, have, cells) in enumerate(rows):
        own = []
        for j, (m, n) in enumerate(cells):
            quota[i][j], rest = divmod(take * n, have)
            if rest:
                own.append([rest * UNIT // have, j, columns.setdefault(m, len(columns))])
        own.sort(reverse=True)
        if own:
            own[0][0] += -sum(x[0] for x in own) % UNIT  # what cutting to units has lost
            if own[0][0] >= UNIT:
                quota[i][own[0][1]] += 1
                own[0][0] -= UNIT
        sums += [0] * (len(columns) - len(sums))
        for x, j, c in own:
            if x:
                part.append(x)
                where.append((i, j))
                ends.append((i, -1 - c))
                sums[c] += x
    for c, x in enumerate(sums):
        if x % UNIT:
            part.append(-x % UNIT)
            where.append(None)
            ends.append((len(rows), -1 - c))
    touch: dict[int, list[int]] = {}
    for k, (a, b) in enumerate(ends):
        touch.setdefault(a, []).append(k)
        touch.setdefault(b, []).append(k)
    luck = iter(rng.random(len(part) + 1).tolist())

    def next_cell(node: int, last: int) -> int:
        """An open cell at ``node`` other than ``last``, or -1."""
        held = touch[node]
        while held and part[held[-1]] in (0, UNIT):
            held.pop()
        if held and held[-1] == last:
            last_one = held.pop()
            while held and part[held[-1]] in (0, UNIT):
                held.pop()
            held.insert(0, last_one)
            if held[-1] == last:
                return -1
        return held[-1] if held else -1

    for start in list(touch):
        path, nodes, seen = [], [start], {start: 0}
        while True:
            node = nodes[-1]
            k = next_cell(node, path[-1] if path else -1)
            if k < 0:
                break
            a, b = ends[k]
            to = b if node == a else a
            path.append(k)
            if to not in seen:
                seen[to] = len(nodes)
                nodes.append(to)
                continue
            at = seen[to]
            cycle, path = path[at:], path[:at]
            up, down = cycle[::2], cycle[1::2]
            rise = min(min(UNIT - part[c] for c in up), min(part[c] for c in down))
            fall = min(min(part[c] for c in up), min(UNIT - part[c] for c in down))
            step = rise if next(luck) * (rise + fall) < fall else -fall
            for c in up:
                part[c] += step
            for c in down:
                part[c] -= step
            for n in nodes[at + 1 :]:
                del seen[n]
            nodes = nodes[: at + 1]
    for x, spot in zip(part, where):
        if spot and x == UNIT:
            quota[spot[0]][spot[1]] += 1
    return quota


def _requests(targets: DataFrame) -> DataFrame:
    """(target_id, plan_name, field_name, category, target_share, floor, need, quota): the targets with whole quotas: the
    largest remainders of the shares of a plan, raised to the floors."""
    known = targets.where("target_id IS NOT NULL AND plan_name IS NOT NULL")
    bad = known.where(~F.coalesce(F.col("field_name").isin(*FIELDS), F.lit(False))).select("field_name").first()
    if bad:
        raise ValueError(f"no plan on {bad[0]}")
    rows = known.select("target_id", "plan_name", "field_name", F.coalesce(norm_key("category"), F.lit("")).alias("category"), F.coalesce("target_share", F.lit(0.0)).alias("target_share"), F.greatest(F.coalesce("min_rows", F.lit(0)), F.lit(0)).alias("floor"), F.coalesce("sample_rows", F.lit(0)).alias("sample_rows")).distinct()
    exact = F.col("target_share") * F.col("sample_rows")
    rest = exact - F.floor(exact)
    plan = Window.partitionBy("plan_name")  # the requests of one plan
    extra = F.bround(F.sum(exact).over(plan), 0).cast("bigint") - F.sum(F.floor(exact)).over(plan)
    rank = F.row_number().over(plan.orderBy(F.desc(rest), "target_id"))
    quota = F.greatest(F.floor(exact) + F.when(rank <= extra, 1).otherwise(0), F.col("floor")).cast("bigint")
    return rows.select("target_id", "plan_name", "field_name", "category", "target_share", "floor", F.greatest(F.col("floor").cast("double"), exact).alias("need"), quota.alias("quota"))


def _cells(counted: DataFrame, fields: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(field_name, category, crossed, ...by, n): counts by the field of a plan and the one that crosses it."""
    out = None
    for f in fields:
        some = counted.where(F.col(f).isNotNull()).groupBy(F.lit(f).alias("field_name"), F.col(f).alias("category"), F.coalesce(CROSSED[f], F.lit("")).alias("crossed"), *by).agg(F.sum("n").alias("n"))
        out = some if out is None else out.unionByName(some)
    return out


def _blocks(cells: DataFrame) -> Iterator[list[tuple]]:
    """Runs of at most BLOCK_CELLS consecutive cells of one plan, as (row, records of its target before it)."""
    block: list[tuple] = []
    target, before = None, 0
    for r in cells.orderBy("plan_name", "target_id", "crossed").toLocalIterator():
        if block and (len(block) >= BLOCK_CELLS or r["plan_name"] != block[0][0]["plan_name"]):
            yield block
            block = []
        if r["target_id"] != target:
            target, before = r["target_id"], 0
        block.append((r, before))
        before += r["n"] or 0
    if block:
        yield block


def _pieces(block: list[tuple]) -> tuple[list, list[Piece]]:
    """(rows of the targets, their pieces): demand, floor and quota divided by the records before and within the block."""
    own: dict[int, list[tuple]] = {}
    for r, before in block:
        own.setdefault(r["target_id"], []).append((r, before))
    heads, pieces = [], []
    for cells in own.values():
        r, low = cells[0]
        high = cells[-1][1] + (cells[-1][0]["n"] or 0)
        have, demand = r["have"] or 0, math.ceil(r["need"])
        part = lambda x: x * high // have - x * low // have if have else x
        piece = part(demand)
        heads.append(r)
        pieces.append(Piece(piece, min(piece, part(r["floor"])), part(min(r["quota"], have)), high - low, [(c["crossed"], c["n"]) for c, _ in cells if c["n"]]))
    return heads, pieces


def draw(metadata: DataFrame, targets: DataFrame, seed: int = 11, with_rows: bool = True) -> tuple[DataFrame, DataFrame]:
    """(report, sample). report: (target_id, plan_name, field_name, category, target_share, needed, available, quota,
    drawn, shortfall, met); sample: (plan_name, image_id, category), no record twice in a plan.

    ``shortfall`` is what the slack arcs of the target carry and ``met`` is whether that is nothing: its category has as
    many records as the greater of ``min_rows`` and ``target_share * sample_rows``. Categories are compared without letter
    case and blanks; a null category is no category; a null ``min_rows`` is no floor; copies of an image count once (the
    least one). Records of a category that a plan doesn't name are never drawn; of two targets of a plan with one
    category, each cell follows the larger quota. An empty table of records leaves every target with a positive need
    unmet. The driver holds one block of cells at a time.
    """
    spark = metadata.sparkSession
    wanted = cut(_requests(targets), "requests")
    fields = [r[0] for r in wanted.select("field_name").distinct().orderBy("field_name").collect()]  # of FIELDS
    once = one_row_per(metadata.select("image_id", *[norm_key(f).alias(f) for f in FIELDS]), "image_id", list(FIELDS))
    if not fields:
        return _report(Spool(spark, "results", RESULT).table(), wanted), spark.createDataFrame([], "plan_name string, image_id bigint, category string")
    bucket = F.pmod(F.xxhash64(F.lit(seed), "image_id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    keys = [*FIELDS, "bucket"] if with_rows else list(FIELDS)
    counted = cut((once.withColumn("bucket", bucket) if with_rows else once).groupBy(*keys).agg(F.count("*").alias("n")), "counts")
    cells = _cells(counted, fields)
    have = cells.groupBy("field_name", "category").agg(F.sum("n").alias("have"))
    asked = wanted.join(cells, ["field_name", "category"], "left").join(have, ["field_name", "category"], "left")
    results, chosen = Spool(spark, "results", RESULT), Spool(spark, "quotas", "plan_name string, field_name string, category string, crossed string, quota bigint")
    for b, block in enumerate(_blocks(asked)):
        heads, pieces = _pieces(block)
        short, per_cell = solve_block(pieces, np.random.default_rng([seed, b]))
        results.add([(r["target_id"], r["plan_name"], p.have, sum(q), s) for r, p, q, s in zip(heads, pieces, per_cell, short)])
        chosen.add([(r["plan_name"], r["field_name"], r["category"], m, q) for r, p, own in zip(heads, pieces, per_cell) for (m, _), q in zip(p.cells, own) if q])
    report = _report(results.table(), wanted)
    return report, _pick(once, bucket, _cells(counted, fields, ("bucket",)), chosen.table(), fields) if with_rows else spark.createDataFrame([], "plan_name string, image_id bigint, category string")


RESULT = "target_id bigint, plan_name string, available bigint, drawn bigint, shortfall bigint"


def _report(results: DataFrame, wanted: DataFrame) -> DataFrame:
    sums = results.groupBy("target_id", "plan_name").agg(*[F.sum(c).alias(c) for c in ("available", "drawn", "shortfall")])
    return wanted.join(sums, ["target_id", "plan_name"]).select("target_id", "plan_name", "field_name", "category", "target_share", F.col("need").alias("needed"), "available", "quota", "drawn", "shortfall", (F.col("shortfall") == 0).alias("met"))


def _pick(once: DataFrame, bucket: Column, counted: DataFrame, quotas: DataFrame, fields: list[str]) -> DataFrame:
    """The ``quota`` records of each cell with the least hashes. Counts per cell and hash bucket give the bucket in which
    the quota ends; whole buckets below it are taken, and only that bucket, a 1,024th of the cell, is ranked."""
    by = ["field_name", "category", "crossed"]
    got = quotas.groupBy("plan_name", *by).agg(F.max("quota").alias("quota"))
    keyed = counted.join(got, by)
    cell = Window.partitionBy("plan_name", *by)
    before = F.coalesce(F.sum("n").over(cell.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = cut(keyed.withColumn("before", before).where("before < quota AND before + n >= quota").select("plan_name", *by, F.col("bucket").alias("edge"), (F.col("quota") - F.col("before")).alias("rest")), "edges")
    records = once.select("image_id", bucket, F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).alias("category"), F.coalesce(CROSSED[f], F.lit("")).alias("crossed")) for f in fields])).alias("c")).select("image_id", "bucket", "c.*")
    near = records.join(edge, by).where("bucket <= edge")  # a row per cell with a quota; the join picks its own way
    rank = F.row_number().over(cell.orderBy(F.xxhash64(F.lit(3), "image_id"), "image_id"))
    last = near.where("bucket = edge").withColumn("rank", rank).where("rank <= rest").drop("rank")
    return near.where("bucket < edge").unionByName(last).select("plan_name", "image_id", "category")


def unmet(metadata: DataFrame, targets: DataFrame) -> DataFrame:
    """The targets that the records cannot meet: those whose slack arcs carry flow."""
    return draw(metadata, targets, with_rows=False)[0].where(~F.col("met")).select("target_id")
