"""Near duplicates by SetSketch registers, banded, estimated and verified.

A document is the set of its distinct word shingles. Documents whose Jaccard
similarity reaches a threshold are linked, and linked documents form groups.

1. One pass makes a SetSketch of every set: 128 registers, each the largest
   exponentially spaced level of any shingle (base 1.001, 16 bits). Sketches of
   parts merge by maximum, and equal registers are about as likely as the sets
   are similar. Documents with one and the same set become one node.
2. Registers are banded in fours: 32 bands miss a link at 0.85 with probability
   below 1e-10, at 0.8 below 1e-7. In a bucket every node is paired with the
   bucket's smallest, so pairs grow with the rows and not with their square.
3. A pair's similarity is estimated from all registers and both set sizes
   jointly by likelihood; pairs that can reach the threshold are verified on
   full sets, texts at hand.
4. Buckets that still hold several components are worked through whole: small
   ones pair by pair, large ones in blocks of bounded size, where a task
   compares two blocks by one product of their shingle matrices and returns only
   links that join components. So no link is lost to the star of step 2.

Within a very large bucket step 4 grows with the number of nodes outside its
largest component times the bucket's size, which only such a bucket costs.

Defined results: null and empty texts, or such without words, have no shingles,
are linked with nothing and kept. A text with fewer words than a shingle has
its whole word sequence as the one shingle. Copies and rows with one id are
rows of one group. Ids order the group, null ids last; the first row is kept.
An empty table gives no rows. Other columns are carried along under any name.
"""

from __future__ import annotations

import math
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices
from .components import components, kept_table
from .words import GOLD, mix, shingle_sets

REGISTERS, BASE, RATE = 128, 1.001, 20.0      # of a sketch
BAND = 4                                      # registers per band, together one 64-bit value
UNLIKELY = 16.0                               # log likelihood ratio beyond which a pair is not verified
SMALL_BUCKET = 64                             # nodes that may be paired one by one
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 20    # of a block of a large bucket
COLUMNS = 4096                                # shingles of one matrix product
SKETCH_KEYS = 1 << 20                         # shingles sketched at a time


def sketches(keys: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Registers (rows x REGISTERS, 16 bits) of sets given as ``shingle_sets`` returns them.

    A shingle draws ascending exponential times and gives each to another
    register; it stops once its level is below every register of its set, so a
    large set costs little more than one draw per shingle.
    """
    rows = len(ends) - 1
    held = np.zeros((rows, REGISTERS), dtype=np.uint16)
    at = 0
    while at < rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + SKETCH_KEYS, side="right")) - 1)
        for lo in range(int(ends[at]), int(ends[to]), SKETCH_KEYS):
            hi = min(lo + SKETCH_KEYS, int(ends[to]))
            row = np.searchsorted(ends[at:to + 1], np.arange(lo, hi), side="right") - 1
            part = _sketch(keys[lo:hi], row, to - at)
            np.maximum(held[at:to], part, out=held[at:to])      # parts of a long set merge
        at = to
    return held


def _sketch(keys: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    held = np.zeros((rows, REGISTERS), dtype=np.uint16)
    flat = held.reshape(-1)
    place = mix(keys + GOLD)
    first = (place & np.uint64(REGISTERS - 1)).astype(np.int64)
    stride = (place >> np.uint64(20) & np.uint64(REGISTERS - 1)).astype(np.int64) | 1     # odd: visits every register
    time = np.zeros(len(keys))
    scale = 1.0 / math.log(BASE)
    for draw in range(REGISTERS):
        keys = mix(keys + GOLD)
        unit = ((keys >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        time = time - np.log(unit) / (RATE * (REGISTERS - draw))
        level = np.clip(np.floor(1.0 - np.log(time) * scale), 0, 65535).astype(np.uint16)
        np.maximum.at(flat, row * REGISTERS + ((first + draw * stride) & (REGISTERS - 1)), level)
        live = np.flatnonzero(level > held.min(axis=1)[row])
        if not len(live):
            break
        keys, row, first, stride, time = keys[live], row[live], first[live], stride[live], time[live]
    return held


def _more(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1.0) / BASE) / math.log(BASE)


def may_reach(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, similarity: float, grid: int = 48) -> np.ndarray:
    """Whether pairs of sketches with set sizes ``na, nb`` may have a Jaccard similarity of ``similarity``.

    The likelihood of the counts of greater, smaller and equal registers is
    maximised over similarities on both sides of the threshold and compared.
    """
    more = (a > b).sum(axis=1)[:, None]
    less = (a < b).sum(axis=1)[:, None]
    same = a.shape[1] - more - less
    u = (na / (na + nb))[:, None]
    v = 1.0 - u
    most = np.minimum(na, nb)[:, None] / np.maximum(na, nb)[:, None]
    steps = np.linspace(0.0, 1.0, grid)[None, :]

    def best(low, high):
        j = low + (high - low) * steps
        p, q = _more(np.maximum(u - v * j, 0.0)), _more(np.maximum(v - u * j, 0.0))
        tiny = 1e-12
        return (more * np.log(p + tiny) + less * np.log(q + tiny) + same * np.log(np.maximum(1 - p - q, tiny))).max(axis=1)

    possible = most[:, 0] >= similarity - 1e-9
    high = np.maximum(most, similarity)
    return possible & (best(similarity, high) >= best(0.0, np.minimum(most, similarity)) - UNLIKELY)


def _ratio(similarity: float) -> tuple[int, int]:
    return Decimal(str(similarity)).as_integer_ratio()


def sketch_documents(docs: DataFrame, shingle_words: int) -> DataFrame:
    """``node, text, row, n, set1, set2, sketch`` per row; ``row`` holds the other columns, (set1, set2) names the set."""
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    source = docs.select(F.monotonically_increasing_id().alias("node"), "text", others.alias("row"))
    schema = T.StructType([*source.schema.fields, T.StructField("n", T.LongType()), T.StructField("set1", T.LongType()),
                           T.StructField("set2", T.LongType()), T.StructField("sketch", T.BinaryType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                keys, ends = shingle_sets(part.column(1), shingle_words)
                raw = sketches(keys, ends).tobytes()
                width = 2 * REGISTERS
                names = []
                for salt in (1, 2):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(keys ^ mix(np.array([salt], np.uint64))))])
                    names.append(pa.array((total[ends[1:]] - total[ends[:-1]]).view(np.int64)))
                sketch = pa.array([raw[i * width:(i + 1) * width] for i in range(part.num_rows)], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(ends)), *names, sketch], names=schema.names)

    return source.mapInArrow(run, schema)


def _bands(nodes: DataFrame) -> DataFrame:
    """``bucket, node``: 32 rows per node of ``(node, sketch)``."""
    count = REGISTERS // BAND

    def run(batches):
        salt = mix(np.arange(1, count + 1, dtype=np.uint64))
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                part = batch.slice(at, 10_000)
                values = np.frombuffer(b"".join(part.column(1).to_pylist()), dtype=np.uint64).reshape(-1, count)
                buckets = mix(values ^ salt).view(np.int64).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets), pa.array(np.repeat(part.column(0).to_numpy(), count))], names=["bucket", "node"])

    return nodes.select("node", "sketch").mapInArrow(run, "bucket long, node long")


def _verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold."""
    top, under = _ratio(similarity)

    def likely(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                x, y = (np.frombuffer(b"".join(part.column(i).to_pylist()), dtype=np.uint16).reshape(-1, REGISTERS) for i in (2, 4))
                na, nb = (part.column(i).to_numpy().astype(np.float64) for i in (3, 5))
                keep = pa.array(may_reach(x, y, na, nb, similarity))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["a", "b"])

    def exact(batches):
        for batch in batches:
            for left in slices(batch, "text_a"):
                for part in slices(left, "text_b"):
                    (x, xe), (y, ye) = (shingle_sets(part.column(i), shingle_words) for i in (2, 3))
                    keep = np.zeros(part.num_rows, dtype=bool)
                    for i in range(part.num_rows):
                        own, other = x[xe[i]:xe[i + 1]], y[ye[i]:ye[i + 1]]
                        both = len(np.intersect1d(own, other, assume_unique=True))
                        keep[i] = both * under >= top * (len(own) + len(other) - both)
                    mask = pa.array(keep)
                    yield pa.RecordBatch.from_arrays([part.column(0).filter(mask), part.column(1).filter(mask)], names=["a", "b"])

    side = nodes.select("node", "sketch", "n")
    one = side.toDF("a", "sketch_a", "n_a")
    two = side.toDF("b", "sketch_b", "n_b")
    able = pairs.join(one, "a").join(two, "b").select("a", "b", "sketch_a", "n_a", "sketch_b", "n_b").mapInArrow(likely, "a long, b long")
    full = able.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")
    return full.mapInArrow(exact, "a long, b long")


def _blocks(members: DataFrame) -> DataFrame:
    """Deal ``(cluster, node, label, n)`` into blocks of bounded size and pair the blocks that need it.

    Returns ``tile, node, label``. A component that fills blocks has its own and
    they are not compared with each other; small components share blocks.
    """
    def parts(count, size):
        return F.greatest(F.ceil(F.col(count) / BLOCK_NODES), F.ceil(F.col(size) / BLOCK_SHINGLES), F.lit(1))

    labels = members.groupBy("cluster", "label").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    labels = labels.withColumn("own", (F.col("c") >= BLOCK_NODES // 4) | (F.col("s") >= BLOCK_SHINGLES // 4))
    shared = labels.where(~F.col("own")).groupBy("cluster").agg(F.sum("c").alias("sc"), F.sum("s").alias("ss"))
    labels = labels.join(shared, "cluster", "left").select(
        "cluster", "label", F.when(F.col("own"), F.col("label")).otherwise(-1).alias("owner"),
        F.when(F.col("own"), parts("c", "s")).otherwise(parts("sc", "ss")).alias("parts"))
    spread = F.when(F.col("owner") < 0, F.xxhash64("label")).otherwise(F.xxhash64("node"))
    dealt = members.join(labels, ["cluster", "label"]).withColumn("part", F.pmod(spread, F.col("parts")))
    block = F.struct("owner", "part")
    blocks = dealt.select("cluster", block.alias("block")).distinct()
    tiles = blocks.join(blocks.toDF("cluster", "other"), "cluster").where("block <= other").where(
        "block.owner <> other.owner or block.owner < 0")
    sides = tiles.select("cluster", F.explode(F.array_distinct(F.array("block", "other"))).alias("block"),
                         F.concat_ws("/", "cluster", "block.owner", "block.part", "other.owner", "other.part").alias("tile"))
    return dealt.select("cluster", "node", "label", block.alias("block")).join(sides, ["cluster", "block"]).select("tile", "node", "label")


def _tile_links(tiles: DataFrame, texts: DataFrame, shingle_words: int, similarity: float) -> DataFrame:
    """Links that join components within a tile (at most two blocks)."""
    top, under = _ratio(similarity)

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        text, node = table.column("text").combine_chunks(), table.column("node").to_numpy()
        label = table.column("label").to_numpy()
        keys, ends = shingle_sets(text, shingle_words)
        sizes, row = np.diff(ends), np.repeat(np.arange(len(node)), np.diff(ends))
        values, column, seen = np.unique(keys, return_inverse=True, return_counts=True)
        common = np.flatnonzero(seen > 1)
        number = np.full(len(values), -1)
        number[common] = np.arange(len(common))
        column = number[column]
        row, column = row[column >= 0], column[column >= 0]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(node), len(node)), dtype=np.float32)
        for at in range(0, len(common), COLUMNS):
            lo, hi = np.searchsorted(column, [at, at + COLUMNS])
            block = np.zeros((len(node), COLUMNS), dtype=np.float32)
            block[row[lo:hi], column[lo:hi] - at] = 1.0
            both += block @ block.T
        both = both.astype(np.int64)
        linked = (both * under >= top * (sizes[:, None] + sizes[None, :] - both)) & (label[:, None] < label[None, :])
        root = {v: v for v in np.unique(label).tolist()}

        def find(v):
            while root[v] != v:
                v = root[v] = root[root[v]]
            return v

        links = []
        for i, j in zip(*map(np.ndarray.tolist, np.nonzero(linked))):
            x, y = find(int(label[i])), find(int(label[j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                links.append((int(node[i]), int(node[j])))
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return tiles.join(texts, "node").groupBy("tile").applyInArrow(compare, "a long, b long")


def group_nodes(nodes: DataFrame, texts_of, shingle_words: int, similarity: float) -> DataFrame | None:
    """``node, label`` of nodes with links, for ``(node, n, sketch)`` with different sets; None without any.

    ``texts_of`` returns the texts ``(node, text)`` of a frame of nodes.
    """
    bands, count = _bands(nodes), nodes.count()
    hubs = bands.groupBy("bucket").agg(F.min("node").alias("hub"), F.count("*").alias("size")).where("size > 1")
    members = kept_table(bands.join(hubs, "bucket"), "near-buckets", count * (REGISTERS // BAND))
    texts = kept_table(texts_of(members.select("node").distinct()), "near-texts", compression="zstd")
    star = members.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    links = kept_table(_verified(star, nodes, texts, shingle_words, similarity), "near-links")
    labels = components(links)

    labelled = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    rows = members.count()
    labelled = kept_table(labelled, "near-labelled", rows)      # read twice
    mixed = labelled.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    open_buckets = kept_table(labelled.join(mixed.select("bucket"), "bucket", "left_semi"), "near-open", rows)
    small = open_buckets.where(F.col("size") <= SMALL_BUCKET).where("node <> hub")      # pairs with the hub are known
    pairs = small.select("bucket", F.col("node").alias("a"), F.col("label").alias("la")).join(
        small.select("bucket", F.col("node").alias("b"), F.col("label").alias("lb")), "bucket").where("a < b and la <> lb")
    more = kept_table(_verified(pairs.select("a", "b").distinct(), nodes, texts, shingle_words, similarity), "near-links")
    found = labels.select(F.col("node").alias("a"), F.col("label").alias("b")).where("a <> b").union(more)
    large = open_buckets.where(F.col("size") > SMALL_BUCKET)
    if not large.isEmpty():
        clusters = components(large.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")))
        inside = large.select("node", "label").distinct().join(nodes.select("node", "n"), "node").join(
            clusters.select("node", F.col("label").alias("cluster")), "node")
        tiles = _blocks(kept_table(inside, "near-clusters", count))
        found = found.union(kept_table(_tile_links(tiles, texts, shingle_words, similarity), "near-links"))
    elif more.isEmpty():
        return labels
    return components(found)


def near_duplicates(docs: DataFrame, shingle_words: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` as ``text, row, n_shingles, component_id, kept``.

    ``row`` is a struct of the columns other than ``text``; ``component_id`` is
    the smallest ``doc_id`` of the group, ``kept`` marks one row of each group.
    """
    rows = kept_table(sketch_documents(docs, shingle_words), "near-rows", compression="zstd")
    doc_id = F.col("row.doc_id")
    head = F.struct(doc_id.isNull().alias("unnamed"), doc_id.alias("doc_id"), F.col("node").alias("first"))
    sets = rows.where("n > 0").select("set1", "set2", "n", head.alias("head"), "node").groupBy("set1", "set2").agg(
        F.min("node").alias("node"), F.min("head").alias("head"), F.first("n").alias("n"))
    sets = kept_table(sets, "near-sets", rows.count())
    nodes = kept_table(rows.select("node", "n", "sketch").join(sets.select("node"), "node", "left_semi"), "near-nodes")

    def texts_of(wanted: DataFrame) -> DataFrame:
        return rows.select("node", "text").join(wanted, "node", "left_semi")

    labels = group_nodes(nodes, texts_of, shingle_words, similarity)
    grouped = sets.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    heads = grouped.groupBy("label").agg(F.min("head").alias("head"))
    heads = grouped.select("set1", "set2", "label").join(heads, "label").select("set1", "set2", "head")
    joined = rows.join(heads, ["set1", "set2"], "left")
    alone = F.col("n") == 0
    return joined.select(
        "text", "row", F.col("n").alias("n_shingles"),
        F.when(alone, doc_id).otherwise(F.col("head.doc_id")).alias("component_id"),
        (alone | (F.col("head.first") == F.col("node"))).alias("kept"))
