"""Mixing sources to target weights by Pfair scheduling, in DataFrame functions alone.

Each source is a task whose share of ``frame`` slots is its target weight. Its
documents, in the order of a hash of their ids, make blocks of ``block_chars``
characters; a document belongs to the block in which it begins. Block ``j``
(from 0) of a source with ``n`` of ``D`` slots is released at ``floor(j D / n)``
and due at ``ceil((j + 1) D / n)``. Of the blocks released by a slot, the one
due first gets it, so after any number of slots every source is less than one
block away from its weight. The schedule repeats every D slots: one frame is
worked out by a fold over its slots, and every block finds its slot from its
number alone. When a source has no blocks left, the others go on in their
proportions; no document is dropped or repeated.

Any number of sources is mixed, in two levels. The ``OWN`` sources of greatest
weight have a lane each. All others are dealt by hash to ``GROUPS`` lanes; a
lane's weight is that of its sources, and the lane's slots are shared out among
them by the same schedule. A source in a group is less than one block away from
its part of the group's slots, so less than one block and that part away from its
weight. A frame has 16 slots for each of its members at least, so that small
weights are told apart.

Positions within a source are running sums in two levels, within buckets of
bounded size and over the buckets, so no source is ever one task.

The default weights temper the sizes: a source's weight is the square root of
its characters. Weights of given sources are a table ``source, weight``, of
any length; others have none given and count as 1; of repeated ones the greatest
counts. A null source is a source. Null and empty texts have size 0 and
stay with the block they fall in. Rows with one id follow each other, by size;
null ids come last. Other columns are carried along under any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import kept_table

BLOCK_CHARS = 1 << 16
FRAME = 1000
MEMBER_SLOTS = 16        # of a frame for each member, at least
OWN, GROUPS = 512, 512   # lanes of single sources, and of groups
BUCKET_ROWS = 4_096

_PLACE = 1 << 20      # sources per deadline in a sort key


def _group(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("null"))


def units_of(sizes: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """``task, unit``: whole weights of ``sizes (task, size)``."""
    if weights is None:
        return sizes.select("task", F.greatest(F.floor(F.sqrt("size")).cast("long"), F.lit(1)).alias("unit"))
    given = weights.groupBy(_group(F.col("source")).alias("task")).agg(F.max("weight").cast("double").alias("weight"))
    unit = F.round(F.coalesce("weight", F.lit(1.0)) * 1_000_000).cast("long")
    return sizes.join(given, "task", "left").select("task", F.greatest(unit, F.lit(1)).alias("unit"))


def shares(units: DataFrame, frame: int = FRAME) -> DataFrame:
    """``lane, task, number, share`` of ``units (lane, task, unit)``; shares of a lane's frame are whole slots, at least one each."""
    every = Window.partitionBy("lane")
    sized = units.withColumn("total", F.sum("unit").over(every)).withColumn("members", F.count("*").over(every))
    sized = sized.withColumn("frame", F.when(F.col("members") == 1, 1).otherwise(F.greatest(F.lit(frame), MEMBER_SLOTS * F.col("members"))))
    parts = sized.select("lane", "task", "frame", F.expr("frame * unit div total").alias("whole"), F.expr("frame * unit % total").alias("left"))
    order = F.row_number().over(Window.partitionBy("lane").orderBy(F.desc("left"), "task"))
    spare = F.col("frame") - F.sum("whole").over(every)
    return parts.select(
        "lane", "task", F.greatest(F.col("whole") + (order <= spare).cast("long"), F.lit(1)).alias("share"),
        F.row_number().over(Window.partitionBy("lane").orderBy("task")).alias("number"))


def frame_slots(parts: DataFrame) -> DataFrame:
    """``lane, task, turn, slot, share, slots``: who gets each slot of a lane's frame, by earliest deadline.

    A fold over the slots in one row per lane; ``turn`` counts a task's slots from 0.
    """
    listed = parts.groupBy("lane").agg(F.array_sort(F.collect_list(F.struct("number", "task", "share"))).alias("tasks"), F.sum("share").alias("slots"))
    pick = f"""array_min(zip_with(acc.taken, tasks, (c, x) -> CASE WHEN c < x.share AND c * slots div x.share <= t
               THEN ((c + 1) * slots + x.share - 1) div x.share * {_PLACE} + x.number END)) % {_PLACE}"""
    fold = f"""aggregate(sequence(0L, slots - 1),
        named_struct('taken', transform(tasks, x -> 0L), 'order', cast(array() as array<bigint>)),
        (acc, t) -> transform(array({pick}), p -> named_struct(
            'taken', transform(acc.taken, (c, i) -> c + if(i + 1 = p, 1L, 0L)), 'order', concat(acc.order, array(p))))[0],
        acc -> acc.order)"""
    slots = listed.select("lane", "slots", "tasks", F.expr(fold).alias("order")).select(
        "lane", "slots", "tasks", F.posexplode("order").alias("slot", "number"))
    own = F.get("tasks", F.col("number").cast("int") - 1)
    turn = F.row_number().over(Window.partitionBy("lane", "number").orderBy("slot")) - 1
    return slots.select("lane", own["task"].alias("task"), turn.cast("long").alias("turn"), F.col("slot").cast("long").alias("slot"),
                        own["share"].alias("share"), "slots")


def _placed(rows: DataFrame, slots: DataFrame, key: str, tight: bool) -> DataFrame:
    """``slot, release, deadline`` counted in the slots of a frame that repeats, of rows that have them in the slots of one task of it."""
    hint = F.broadcast if tight else (lambda side: side)
    tasks = slots.select(F.col("task").alias(key), "share", "slots").distinct()
    turns = slots.select(F.col("task").alias(key), "turn", F.col("slot").alias("own"))
    known = rows.join(hint(tasks), key).withColumn("turn", F.expr("slot % share")).join(hint(turns), [key, "turn"])
    return known.withColumns({
        "slot": F.expr("slot div share * slots + own"), "release": F.expr("release * slots div share"),
        "deadline": F.expr("(deadline * slots + share - 1) div share")}).drop("turn", "own", "share", "slots")


def schedule(docs: DataFrame, weights: DataFrame | None = None, block_chars: int = BLOCK_CHARS, frame: int = FRAME,
             most: int = OWN, bucket_rows: int = BUCKET_ROWS, size: Column | None = None, groups: int = GROUPS) -> DataFrame:
    """``row`` (struct of all columns of ``docs``) with its place in the mix.

    ``block``: number in the source from 0; ``release``, ``deadline`` and
    ``slot``; ``start``: characters of the source before the document. The mix
    is the order of ``slot, start``. ``size`` stands for the length of ``text``,
    so that rows without their text can be scheduled. ``most`` sources have a
    lane of their own, the others are dealt to ``groups`` lanes.
    """
    buckets = max(1, -(-docs.count() // bucket_rows))
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _group(F.col("source")).alias("task"),
        F.coalesce(F.length("text") if size is None else size, F.lit(0)).cast("long").alias("size"), key.alias("key"),
        F.floor(F.conv(F.substring(key, 1, 8), 16, 10).cast("long") * buckets / (1 << 32)).alias("bucket"))
    sizes = rows.groupBy("task").agg(F.sum("size").alias("size"))
    units = kept_table(units_of(sizes, weights), "mix-units")
    own = kept_table(units.orderBy(F.desc("unit"), "task").limit(most).select("task", F.lit(True).alias("alone")), "mix-own")
    lane = F.when(F.col("alone"), F.concat(F.lit("="), "task")).otherwise(F.concat(F.lit("#"), F.pmod(F.xxhash64("task"), F.lit(groups)).cast("string")))
    members = units.join(F.broadcast(own), "task", "left").select(lane.alias("lane"), "task", "unit", F.coalesce("alone", F.lit(False)).alias("alone"))
    lanes = members.groupBy("lane").agg(F.sum("unit").alias("unit")).select(F.lit("").alias("lane"), F.col("lane").alias("task"), "unit")
    outer = kept_table(frame_slots(shares(lanes, frame)), "mix-frame")              # of most + groups lanes
    grouped = members.where(~F.col("alone"))
    inner = None if grouped.isEmpty() else kept_table(frame_slots(shares(grouped.select("lane", "task", "unit"), frame)), "mix-groups")

    held = rows.groupBy("task", "bucket").agg(F.sum("size").alias("held"))
    earlier = Window.partitionBy("task").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = held.select("task", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("task", "bucket").orderBy("key", F.col("row.doc_id").asc_nulls_last(), "size")
    running = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    placed = running.join(before, ["task", "bucket"]).withColumn("start", F.col("before") + F.col("inside"))
    blocks = placed.select("row", "task", "start", F.expr(f"start div {block_chars}").alias("block"))
    blocks = blocks.join(F.broadcast(own), "task", "left").withColumn("lane", lane)
    # a block's place in the slots of its source; then in those of its lane, then in the mix
    blocks = blocks.withColumns({"slot": F.col("block"), "release": F.col("block"), "deadline": F.col("block") + 1})
    if inner is not None:
        blocks = blocks.where("alone").unionByName(_placed(blocks.where("alone is null"), inner, "task", False))
    return _placed(blocks, outer, "lane", True).select("row", "block", "release", "deadline", "slot", "start")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """``docs`` laid out in the order of the mix: partitions ascend, and rows in them."""
    placed = schedule(docs, **options)
    ordered = placed.repartitionByRange("slot", "start").sortWithinPartitions("slot", "start")
    return ordered.select(*[F.col("row")[c].alias(c) for c in docs.columns])
