"""Mixing sources to target weights by Pfair scheduling (DataFrame functions on the data path)."""

from __future__ import annotations

import heapq
import json
from bisect import bisect_left
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from functools import reduce
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import saved


def pfair_cycle(units: Sequence[int]) -> list[tuple[int, int]]:
    """Slot order of one cycle in which source i gets ``units[i]`` of ``q = sum(units)`` slots.

    Block j of source i is released at slot floor(j q / u_i) and due by slot ceil((j + 1) q / u_i);
    among the released blocks the one due first takes the slot (ties: lower source). The shares add
    up to 1, so every block meets its window: after t slots each source has had more than
    u_i t / q - 1 and fewer than u_i t / q + 1 blocks."""
    q = sum(units)
    released = [[] for _ in range(q + 1)]
    for i, u in enumerate(units):
        for j in range(u):
            released[j * q // u].append((-(-(j + 1) * q // u), i, j))
    ready: list[tuple[int, int, int]] = []
    order = []
    for t in range(q):
        for job in released[t]:
            heapq.heappush(ready, job)
        _, i, j = heapq.heappop(ready)
        order.append((i, j))
    return order


def exact_slots(blocks: Sequence[int], weights: Sequence[float]) -> Iterator[tuple[int, int]]:
    """(source, block) of every slot, for all blocks of all sources, by the weights as they are.

    Fluid target: source i gets w_i / (weights of the sources not yet used up) of every slot until its
    blocks[i] blocks are used up, and T(v) is the slot by which each source has had min(v w_i, blocks[i]).
    Block j of source i is released at slot floor(T(j / w_i)) and due by slot ceil(T((j + 1) / w_i)); among
    the released blocks the one due first takes the slot (ties: lower source). The fluid shares fill every
    slot, so all blocks meet their windows and after every slot each source is less than one block from
    its target. Integers only (weights to 53 bits); one block a source is held at a time.

    Where no source has more than one block there are no shares to hold: source order."""
    live = [i for i, m in enumerate(blocks) if m]
    if all(blocks[i] == 1 for i in live):
        yield from ((i, 0) for i in live)
        return
    top = max(weights[i] for i in live)
    p = [max(1, round(w / top * 2**53)) for w in weights]
    order = sorted(live, key=lambda i: Fraction(blocks[i], p[i]))  # in which the sources are used up
    ends = [blocks[i] / p[i] for i in order]
    gone, rate = [0], [sum(p[i] for i in live)]
    for i in order:
        gone.append(gone[-1] + blocks[i])
        rate.append(rate[-1] - p[i])

    def at(i: int, j: int) -> tuple[int, int]:
        """T(j / w_i) as a whole number and a remainder."""
        k = min(bisect_left(ends, j / p[i]), len(order) - 1)
        while k and blocks[order[k - 1]] * p[i] > j * p[order[k - 1]]:
            k -= 1
        while blocks[order[k]] * p[i] < j * p[order[k]]:
            k += 1
        whole, rest = divmod(j * rate[k], p[i])
        return gone[k] + whole, rest

    future, ready = [(0, i, 0) for i in live], []
    for t in range(gone[-1]):
        while future and future[0][0] <= t:
            _, i, j = heapq.heappop(future)
            whole, rest = at(i, j + 1)
            heapq.heappush(ready, (whole + (rest > 0), i, j))
            if j + 1 < blocks[i]:
                heapq.heappush(future, (whole, i, j + 1))
        _, i, j = heapq.heappop(ready)
        yield i, j


def cycle_units(counts: Sequence[int], weights: Sequence[float], cycle: int) -> list[int]:
    """Target weights as whole blocks per cycle of about ``cycle`` slots, one at least."""
    total = sum(w for w, n in zip(weights, counts) if n > 0)
    return [max(1, round(cycle * w / total)) for w in weights]


def plan_cycles(counts: Sequence[int], units: Sequence[int], block: int) -> list[dict]:
    """The runs of equal cycles. In cycle c source i has blocks c u_i .. (c + 1) u_i - 1, as far as it
    has any; a source that ends leaves its slots to the others. Each run lists its slots with the
    number of rows before them in the cycle, the rows of a cycle and of all cycles before the run."""
    blocks = [-(-n // block) for n in counts]
    ends = [(m - 1) // u for m, u in zip(blocks, units) if m]  # the cycle of a source's last block, which may be short
    cuts = sorted({0, *ends, *(c + 1 for c in ends)})
    runs, base = [], 0
    for c0, c1 in zip(cuts, cuts[1:] + [None]):
        has = [max(0, min(u, m - c0 * u)) for m, u in zip(blocks, units)]
        if not sum(has):
            continue
        rows, slots = 0, []
        for slot, (i, j) in enumerate(pfair_cycle(has)):
            slots.append((i, j, slot, rows))
            rows += min(block, counts[i] - (c0 * units[i] + j) * block)
        runs.append({"start": c0, "base": base, "rows": rows, "slots": slots})
        base += rows * ((c1 or c0 + 1) - c0)
    return runs


def _literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table that the driver has worked out, as a literal in the plan."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def _slot_table(spark: SparkSession, counts: Sequence[int], weights: Sequence[float], block: int,
                chunk: int = 1 << 20) -> DataFrame:
    """(_i, block, _slot, _off) of :func:`exact_slots`, written in chunks; _off: rows before the slot."""
    slots, off, slot, parts = exact_slots([-(-n // block) for n in counts], weights), 0, 0, []
    while (some := list(islice(slots, chunk))) or not parts:
        offs = []
        for i, j in some:
            offs.append(off)
            off += min(block, counts[i] - j * block)
        cols = [pa.array([i for i, _ in some], pa.int32()), pa.array([j for _, j in some], pa.int64()),
                pa.array(range(slot, slot + len(some)), pa.int64()), pa.array(offs, pa.int64())]
        parts.append(saved(spark.createDataFrame(pa.Table.from_arrays(cols, ["_i", "block", "_slot", "_off"]))))
        slot += len(some)
    return reduce(DataFrame.union, parts)


def source_ranks(docs: DataFrame, id_col: str, source_col: str, seed: int) -> DataFrame:
    """(doc_id, source, _rank): rows numbered 0, 1, ... within their source in a seeded random order.

    Rows are range-sorted by (source, hash), so a large source spreads over many partitions; the
    sorted rows are written once and numbered from the row counts of the (partition, source) runs,
    of which there are fewer than partitions + sources."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"))
    rows = rows.withColumn("_h", F.xxhash64("doc_id", F.lit(seed)))
    rows = rows.repartitionByRange("source", "_h", "doc_id").sortWithinPartitions("source", "_h", "doc_id")
    mid = F.monotonically_increasing_id()  # the partition above bit 33, the place in it below
    rows = saved(rows.select("doc_id", "source", mid.alias("_m"))).select(
        "doc_id", "source", F.shiftright("_m", 33).alias("_p"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_at"))
    runs = rows.groupBy("_p", "source").agg(F.min("_at").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("source").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(F.col("_p").alias("_rp"), F.col("source").alias("_rs"),
                       (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_lo")).alias("_shift"))
    same = (F.col("_p") == F.col("_rp")) & F.col("source").eqNullSafe(F.col("_rs"))
    return rows.join(F.broadcast(runs), same).select("doc_id", "source", (F.col("_at") + F.col("_shift")).alias("_rank"))


def mix_sources(docs: DataFrame, weights: Mapping[str | None, float] | None = None, temperature: float = 0.5,
                cycle: int | None = None, block: int = 16, seed: int = 17, max_sources: int = 5000, id_col: str = "doc_id",
                source_col: str = "source") -> DataFrame:
    """(doc_id, source, source_rank, block, cycle, slot, position) for every row; position is 0 .. N - 1.

    Target weights: ``weights`` by source (1 for a source not in it), or rows ** ``temperature``.
    The rows of a source, in a seeded random order, form blocks of ``block`` rows. The blocks get Pfair
    windows from the weights as they are and are dealt by earliest deadline (:func:`exact_slots`), so at
    any slot each source is less than one block from its target. No row is dropped or repeated: when a
    source ends, the others share its slots. ``cycle`` and ``slot`` count the slots by 256.

    With ``cycle`` given, the weights are rounded to whole blocks, one at least, of a cycle of about
    ``cycle`` slots, which repeats (:func:`cycle_units`); the deviation is then bounded against the
    rounded weights only.

    A null source is a source of its own. A null id is numbered like any other; rows that repeat an
    id get a position each. An empty table gives no rows. More than ``max_sources`` sources raise
    ValueError: the driver holds one count per source. It deals the slots one by one (one per block)
    and writes them in chunks; with ``cycle`` it broadcasts at most (2 sources + 1) x slots of a cycle."""
    spark = docs.sparkSession
    found = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count(F.lit(1)).alias("n"))
    counted = sorted(found.limit(max_sources + 1).collect(), key=lambda r: (r["source"] is not None, r["source"]))
    if len(counted) > max_sources:
        raise ValueError(f"mix_sources: more than {max_sources} sources")
    names, counts = [r["source"] for r in counted], [r["n"] for r in counted]
    share = [float((weights or {}).get(s, 1.0)) if weights is not None else n ** temperature
             for s, n in zip(names, counts)]
    if any(not w > 0 for w in share):
        raise ValueError("mix_sources: weights must be positive")
    ranked = source_ranks(docs, id_col, source_col, seed)
    if cycle is None:
        source = _literal_table(spark, [{"_name": s, "_i": i} for i, s in enumerate(names)], "_name string, _i int")
        b = ranked.join(F.broadcast(source), F.col("source").eqNullSafe(F.col("_name")))
        b = b.withColumn("block", F.expr(f"_rank div {int(block)}")).join(_slot_table(spark, counts, share, block), ["_i", "block"])
        return b.select("doc_id", "source", F.col("_rank").alias("source_rank"), "block", F.expr("_slot div 256").alias("cycle"),
                        (F.col("_slot") % 256).alias("slot"), (F.col("_off") + F.col("_rank") % F.lit(int(block))).alias("position"))
    units = cycle_units(counts, share, cycle) if counts else []
    runs = plan_cycles(counts, units, block)
    slots = _literal_table(spark, [
        {"_run": r, "_i": i, "_j": j, "slot": s, "_off": off}
        for r, run in enumerate(runs) for i, j, s, off in run["slots"]], "_run int, _i int, _j long, slot int, _off long")
    source = _literal_table(spark, [{"_name": s, "_i": i, "_u": u} for i, (s, u) in enumerate(zip(names, units))],
                            "_name string, _i int, _u long")
    starts, base, rows = ([run[k] for run in runs] for k in ("start", "base", "rows"))

    def longs(xs: list[int]) -> Column:
        return F.from_json(F.lit(json.dumps(xs)), "array<bigint>")

    b = ranked.join(F.broadcast(source), F.col("source").eqNullSafe(F.col("_name"))).drop("_name")
    b = b.withColumn("block", F.expr(f"_rank div {int(block)}")).withColumn("cycle", F.expr("block div _u"))
    b = b.withColumn("_j", F.col("block") % F.col("_u"))
    b = b.withColumn("_run", F.size(F.filter(longs(starts), lambda x: x <= F.col("cycle"))) - 1)
    b = b.join(F.broadcast(slots), ["_run", "_i", "_j"])
    at = (F.get(longs(base), F.col("_run")) + (F.col("cycle") - F.get(longs(starts), F.col("_run")))
          * F.get(longs(rows), F.col("_run")) + F.col("_off") + F.col("_rank") % F.lit(int(block)))
    return b.select("doc_id", "source", F.col("_rank").alias("source_rank"), "block", "cycle",
                    F.col("slot").cast("long").alias("slot"), at.alias("position"))


def mixed_order(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` with all rows and columns, globally sorted into the mixed order (no column is added).

    Rows that repeat an id stand together at the first of their positions; rows without an id come
    last."""
    place = mix_sources(docs, id_col=id_col, **options).where(F.col("doc_id").isNotNull())
    place = place.groupBy(F.col("doc_id").alias("_mix_id")).agg(F.min("position").alias("_mix_at"))
    both = docs.join(place, F.col(id_col) == F.col("_mix_id"), "left")
    return both.orderBy(F.col("_mix_at").asc_nulls_last()).drop("_mix_id", "_mix_at")


def with_position(docs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The columns of ``docs`` (or some of them) and position, 0 .. N - 1: the order in which a sorted table was written.

    Spark reads part files in an order of its own, so the place is taken from the number of the part file
    and the row's index in it. A frame that is not a plain read of files is written once and numbered by
    its partitions."""
    names = list(columns or docs.columns)
    if docs._jdf.queryExecution().analyzed().children().isEmpty() and docs.inputFiles():
        rows = docs.select(*(F.col(f"`{c}`") for c in names), F.col("_metadata.file_name").alias("_f"), F.col("_metadata.row_index").alias("_at"))
        part = F.regexp_extract("_f", r"part-(\d+)", 1).try_cast("long")
    else:
        mid = F.monotonically_increasing_id()  # the partition above bit 33, the place in it below
        rows = saved(docs).select(*(F.col(f"`{c}`") for c in names), mid.alias("_m")).select(
            *(F.col(f"`{c}`") for c in names), F.shiftright("_m", 33).cast("string").alias("_f"), F.col("_m").bitwiseAND((1 << 33) - 1).alias("_at"))
        part = F.col("_f").cast("long")
    runs = rows.groupBy("_f").agg(F.count(F.lit(1)).alias("_n"))  # one row a file
    before = Window.orderBy(part.asc_nulls_last(), "_f").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("_f", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(runs), "_f").select(*(rows[f"`{c}`"] for c in names), (F.col("_before") + F.col("_at")).alias("position"))
