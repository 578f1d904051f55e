"""Alignment of two tokenizers' tokens by the bytes they cover, corpus-wide.

Every text is encoded twice, with a blank before it: by a byte-level model (A)
and by a piece model with byte fallback (B), which adds the blank itself. A
task works on whole batches as Arrow columns. Token lengths, summed up over the
batch, give every token the byte where it ends; since all texts lie one behind
the other, such a place names document and end at once. A full outer hash join
of the places of A and B, sorted, with the gaps filled from behind, yields the
links: each stretch between neighbouring ends belongs to one A and one B token,
and two tokens overlap in one stretch at most. Ends that both sides have close
the groups.

The ids of each link are one key. Links are written aside, a document's in rows
of at most ``RUN``, so that a batch of rows is bounded however long the texts;
the first row of a document holds what else is known of it. Their counts are
partial ``group_by`` sums of Arrow tables, merged by Spark. Counts come back to
the documents in two tiers: the ``PAIRS`` most frequent pairs, as far as whole
powers of two of their counts fit, are broadcast, and so is the highest count
of each B id, bounded by its vocabulary; links of rarer pairs are joined by a
shuffle. One sum over both tiers joins the documents.

Null and empty texts, and texts that B's pieces do not spell exactly (those
with U+2581), have no tokens: zeros and an empty grouping. Strings of special
tokens are plain text. Rows are treated one by one, so copies and rows with one
id all stay. Long texts are slices of their own; other columns are ignored; an
empty table gives none.
"""

from __future__ import annotations

import hashlib
import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, strings
from .components import kept_table
from .tokens import Remembered, UnitEncoder, id_bytes
from .worker import forget, kept

PAIRS = 1 << 20           # pairs whose counts are broadcast
BLANK = "▁"
SHIFT = 32                # key of a pair: A id above, B id below
RUN = 1 << 8              # links in a row; Arrow sends 10,000 rows at a time
LINKS = 1 << 18           # links looked up at a time
SLICE = 1 << 18           # text bytes aligned at a time
UNITS = 1 << 10           # unknown units of a text encoded at a time
REMEMBERED = 150_000      # pieces, and units, of each of two generations in a worker

# Blanks with the word behind them, or a line end with the word behind it: pieces hold blanks at their start only, and no line end.
_UNITS = re.compile(" +[^ \n]*|\n[^ \n]*")


class PieceEncoder:
    """Ids of texts by a piece model, unit by unit, with a cache."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.apart = not any(BLANK in p.lstrip(BLANK) or "\n" in p for p in pieces)
        self.blank = self.library.piece_to_id(BLANK)
        self.lengths = np.array([1 if self.library.is_byte(i) else len(p.replace(BLANK, " ").encode()) for i, p in enumerate(pieces)], dtype=np.int64)
        self.raw = [bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.units = Remembered(REMEMBERED)

    def whole(self, text: str) -> list[int]:
        return self.library.encode(text, num_threads=1)

    def exact(self, ids: list[int], spelled: str) -> bool:
        return b"".join(map(self.raw.__getitem__, ids)) == spelled.encode()

    def each(self, units: list[str]):
        """Ids of every unit; None where they do not spell it."""
        for unit, ids in zip(units, self.library.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)):
            if unit[0] != " ":
                if ids[0] != self.blank:
                    yield None
                    continue
                ids = ids[1:]
            yield id_bytes(ids) if self.exact(ids, unit) else None

    def ids(self, text: str) -> bytes | None:
        """Ids of a text as ``id_bytes``; None if they do not spell it behind a blank."""
        if BLANK in text:
            return None
        if not self.apart:
            ids = self.whole(text)
            return id_bytes(ids) if self.exact(ids, " " + text) else None
        units = _UNITS.findall(" " + text)
        found, missing = self.units.get_all(units)
        for at in range(0, len(missing), UNITS):
            some = missing[at:at + UNITS]
            for i, value in zip(some, self.each([units[i] for i in some])):
                if value is None:
                    ids = self.whole(text)
                    return id_bytes(ids) if self.exact(ids, " " + text) else None
                found[i] = value
                self.units.put(units[i], value)
        return b"".join(found)


class Pair:
    """Both encoders, token lengths, and the decimal ids with each separator before them."""

    def __init__(self, byte_path: str, piece_path: str):
        from .tokens import BYTE_NAMES

        self.a = UnitEncoder(byte_path, True, id_bytes, b"".join)
        self.a.library.encode_special_tokens = True
        self.a.pieces = Remembered(REMEMBERED)
        self.b = PieceEncoder(piece_path)
        vocab = self.a.library.get_vocab(with_added_tokens=True)
        named = {chr(c) for c in BYTE_NAMES.values()}
        self.a_lengths = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for piece, i in vocab.items():      # one character a byte, special strings aside
            self.a_lengths[i] = len(piece.encode()) if piece in self.a.special and not set(piece) & named else len(piece)
        n = max(len(self.a_lengths), len(self.b.lengths))
        self.width = n
        self.written = pa.array([s + str(i) for s in (",", ";", "|") for i in range(n)], pa.large_string())

    def encode(self, text: str) -> tuple[bytes, bytes]:
        if not text:
            return b"", b""
        b = self.b.ids(text)
        if b is None:
            return b"", b""
        a = self.a.encode(" " + text)
        if int(self.a_lengths[np.frombuffer(a, "<u4")].sum()) != len(text.encode()) + 1:
            return b"", b""
        return a, b


def _flat(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All ids, and the offsets of the documents' ids."""
    return np.frombuffer(b"".join(parts), "<u4").astype(np.int64), np.cumsum([0, *[len(p) // 4 for p in parts]])


def aligned(pair: Pair, texts: list[str]) -> dict:
    """Arrow columns of a batch: ``n_a, n_b, n_groups, n_links, groups_sha256, links``."""
    a_parts, b_parts = zip(*[pair.encode(t) for t in texts])
    (a, a_at), (b, b_at) = _flat(a_parts), _flat(b_parts)
    n = len(texts)
    # A token's end, over the whole batch; a document's last end is the same on both sides
    a_ends, b_ends = np.cumsum(pair.a_lengths[a]), np.cumsum(pair.b.lengths[b])
    if len(a) and a_ends[-1] != b_ends[-1]:
        raise ValueError("the two encoders cover different bytes")
    left = pa.table({"end": a_ends, "i": np.arange(len(a))})
    right = pa.table({"end": b_ends, "j": np.arange(len(b))})
    joined = left.join(right, "end", join_type="full outer", use_threads=False).sort_by("end").combine_chunks()
    i, j = joined.column("i"), joined.column("j")
    common = pc.and_(pc.is_valid(i), pc.is_valid(j)).to_numpy()
    i, j = (pc.fill_null_backward(x).to_numpy() for x in (i, j))
    links = (a[i] << SHIFT) | b[j]
    # parent indices: the document of each link, from the offsets of the A side
    link_at = np.searchsorted(i, a_at, side="left")
    closed = np.concatenate([[0], np.cumsum(common)])
    # groups: behind each common end the next begins; its A ids come first, then its B ids
    a_last, b_last = i[common], j[common]
    a_first, b_first = np.concatenate([[0], a_last + 1])[:-1], np.concatenate([[0], b_last + 1])[:-1]
    a_group = np.repeat(np.arange(len(a_last)), a_last - a_first + 1)
    b_group = np.repeat(np.arange(len(b_last)), b_last - b_first + 1)
    codes = np.empty(len(a) + len(b), dtype=np.int64)
    a_codes, b_codes = a.copy(), b.copy()
    a_codes[a_first] += pair.width
    b_codes[b_first] += 2 * pair.width
    codes[np.arange(len(a)) + b_first[a_group]] = a_codes
    codes[np.arange(len(b)) + a_last[b_group] + 1] = b_codes
    spelled = pair.written.take(pa.array(codes))
    starts = np.frombuffer(spelled.buffers()[1], np.int64)[a_at + b_at] if len(codes) else np.zeros(n + 1, np.int64)
    data = memoryview(spelled.buffers()[2]) if len(codes) else memoryview(b"")
    digests = ["" if s == e else hashlib.sha256(data[s + 1:e]).hexdigest() for s, e in zip(starts[:-1].tolist(), starts[1:].tolist())]
    return {
        "n_a": pa.array(np.diff(a_at), pa.int64()), "n_b": pa.array(np.diff(b_at), pa.int64()),
        "n_groups": pa.array(closed[link_at[1:]] - closed[link_at[:-1]], pa.int64()), "n_links": pa.array(np.diff(link_at), pa.int64()),
        "groups_sha256": pa.array(digests, pa.string()),
        "links": pa.ListArray.from_arrays(pa.array(link_at, pa.int32()), pa.array(links, pa.int64()))}


def in_runs(links: pa.ListArray, most: int = RUN) -> tuple[pa.Array, pa.Array, pa.ListArray]:
    """Each row's links cut into runs: the row, null but for its first run; the row; the runs. A row without links is one empty run."""
    at = links.offsets.to_numpy().astype(np.int64)
    runs = np.maximum(1, -(-np.diff(at) // most))
    row = np.repeat(np.arange(len(links)), runs)
    place = np.arange(len(row)) - np.repeat(np.cumsum(runs) - runs, runs)
    starts = np.append(at[:-1][row] + most * place, at[-1])
    return pa.array(row, mask=place > 0), pa.array(row), pa.ListArray.from_arrays(pa.array(starts, pa.int32()), links.values)


def links_of(docs: DataFrame, byte_tokenizer: str, piece_tokenizer: str) -> DataFrame:
    """``node, first, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, links``; a link is its pair's key.

    A document is as many rows as its links are runs; the columns from ``doc_id``
    to ``groups_sha256`` are those of its ``first``, null in the others.
    """
    source = docs.select(F.monotonically_increasing_id().alias("node"), "doc_id", "text")
    doc_id = T.StructField("doc_id", source.schema["doc_id"].dataType)
    schema = T.StructType([source.schema["node"], T.StructField("first", T.BooleanType()), doc_id, *[T.StructField(c, T.LongType()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                           T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.ArrayType(T.LongType()))])

    def run(batches):
        pair = kept(f"alignment {byte_tokenizer} {piece_tokenizer}", lambda: Pair(byte_tokenizer, piece_tokenizer))
        for batch in batches:
            for part in slices(batch, most=SLICE):
                found = aligned(pair, strings(part))
                first, row, links = in_runs(found.pop("links"))
                yield pa.RecordBatch.from_arrays([part.column(0).take(row), first.is_valid(), part.column(1).take(first), *[
                    found[f].take(first) for f in schema.names[3:-1]], links], names=schema.names)

    return source.mapInArrow(run, schema)


def link_slices(batch: pa.RecordBatch, most: int = LINKS):
    """Runs of rows with about ``most`` links each; a row with more is a run of its own."""
    ends, at = batch.column(batch.schema.get_field_index("links")).offsets.to_numpy().astype(np.int64), 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def pair_counts(linked: DataFrame) -> DataFrame:
    """``pair, count, b`` over the whole corpus: links with this pair, and its B id."""
    def run(batches):
        forget("alignment ")      # the encoders, whose work is done
        for whole in batches:
            for batch in link_slices(whole):
                keys = pa.table({"pair": pc.list_flatten(batch.column(0))})
                counted = keys.group_by("pair", use_threads=False).aggregate([("pair", "count")])
                yield from counted.select(["pair", "pair_count"]).rename_columns(["pair", "n"]).combine_chunks().to_batches()

    partial = linked.select("links").mapInArrow(run, "pair long, n long")
    return partial.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << SHIFT) - 1)))


def _least_count(counts: DataFrame, most: int) -> int:
    """The smallest power of two such that at most ``most`` pairs have this count or more."""
    sizes = {r.power: r.n for r in counts.groupBy(F.floor(F.log2("count")).cast("int").alias("power")).agg(F.count("*").alias("n")).collect()}
    held = 0
    for power in sorted(sizes, reverse=True):
        held += sizes[power]
        if held > most:
            return 1 << (power + 1)
    return 1


def align(docs: DataFrame, byte_tokenizer: str, piece_tokenizer: str, pairs: int = PAIRS) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``."""
    linked = kept_table(links_of(docs, byte_tokenizer, piece_tokenizer), "alignment-links", compression="zstd")
    counts = kept_table(pair_counts(linked), "alignment-counts")
    best = counts.groupBy("b").agg(F.max("count").alias("best"))                # a row for each id of B at most
    least = _least_count(counts, pairs)
    frequent = counts.where(F.col("count") >= least).join(F.broadcast(best), "b").select("pair", "count", (F.col("count") == F.col("best")).alias("is_best"))
    held = frequent.sort("pair").toArrow()
    shared, version = docs.sparkSession.sparkContext.broadcast(tuple(
        held.column(c).to_numpy().tobytes() for c in ("pair", "count", "is_best"))), uuid.uuid4().hex

    def table() -> tuple:
        forget("pairs ")
        forget("alignment ")
        keys, number, top = (np.frombuffer(raw, kind) for raw, kind in zip(shared.value, (np.int64, np.int64, np.bool_)))
        return np.append(keys, -1), np.append(number, 0), np.append(top, False)

    def looked_up(batch) -> tuple:
        """Keys, their documents' offsets, and the places in the table; the last place is for what it lacks."""
        keys, number, top = kept(f"pairs {version}", table)
        links = batch.column(batch.schema.get_field_index("links"))
        offsets = links.offsets.to_numpy().astype(np.int64)
        coded = pc.dictionary_encode(pc.list_flatten(links))
        own = coded.dictionary.to_numpy()
        place = np.searchsorted(keys[:-1], own)
        place = np.where(keys[place] == own, place, len(keys) - 1)
        return own[coded.indices.to_numpy()], offsets - offsets[0], place[coded.indices.to_numpy()], number, top

    def summed(values: np.ndarray, at: np.ndarray) -> pa.Array:
        sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return pa.array(sums[at[1:]] - sums[at[:-1]], pa.int64())

    def score(batches):
        for whole in batches:
            for batch in link_slices(whole):
                _, at, place, number, top = looked_up(batch)
                node = batch.column(0).to_numpy()
                ends = np.append(np.flatnonzero(node[1:] != node[:-1]) + 1, len(node))       # runs of one document follow each other
                at = at[np.concatenate([[0], ends])]
                yield pa.RecordBatch.from_arrays([pa.array(node[ends - 1]), summed(top[place], at), summed(number[place], at)], names=["node", "n_best", "count_sum"])

    def rare(batches):
        for whole in batches:
            for batch in link_slices(whole):
                own, at, place, number, _ = looked_up(batch)
                node = np.repeat(batch.column(0).to_numpy(), np.diff(at))
                lacking = place == len(number) - 1
                rest = pa.table({"node": node[lacking], "pair": own[lacking]}).group_by(["node", "pair"], use_threads=False).aggregate([([], "count_all")])
                yield from rest.select(["node", "pair", "count_all"]).rename_columns(["node", "pair", "n"]).combine_chunks().to_batches()

    held_links = linked.select("node", "links")
    sums = held_links.mapInArrow(score, "node long, n_best long, count_sum long")
    if least > 1:
        rest = held_links.mapInArrow(rare, "node long, pair long, n long")
        known = kept_table(counts.where(F.col("count") < least).join(F.broadcast(best), "b").select(
            "pair", "count", (F.col("count") == F.col("best")).alias("is_best")), "alignment-rare")
        sums = sums.union(rest.join(known, "pair").select(
            "node", F.when(F.col("is_best"), F.col("n")).otherwise(0).alias("n_best"), (F.col("n") * F.col("count")).alias("count_sum")))
    sums = sums.groupBy("node").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    scored = linked.where("first").drop("first", "links").join(sums, "node")
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
