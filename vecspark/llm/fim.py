"""Fill-in-the-middle documents, cut at token ends that are found eight bytes at a time.

A token is a run of white space with the word after it, or the white space at
the end of a text. All texts of a batch lie in one UTF-8 buffer, which is read
as 64-bit words. Arithmetic on whole words marks the top bit of each byte that
ends a token; ``bitwise_count`` gives the ends per word, their running sum is
searched for the word that holds the wanted end, and a product of prefix sums
selects the end inside it. Code points are counted the same way. Bytes from 128
on are never white space here, so characters are never cut.

Two cuts and the form of a document come from the SHA-256 of seed and id, so
they are the same in every run and task. A null text is empty; empty texts, and
those that hold a sentinel, stay plain, with n counted. A null id counts as the
empty string. Rows are treated one by one, so copies and rows with one id all
stay. Long texts are slices of their own, other columns are not read by
``fill_in_middle``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, text_bytes, text_offsets

SENTINELS = ("<P>", "<S>", "<M>")     # before prefix, suffix and middle
PLAIN, PSM, SPM = "plain", "psm", "spm"

_ONES, _TOPS, _LOWS = (np.uint64(int(x * 8, 16)) for x in ("01", "80", "7f"))
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def _repeated(byte: int) -> np.uint64:
    return np.uint64(int(f"{byte:02x}" * 8, 16))


def space_marks(words: np.ndarray) -> np.ndarray:
    """The top bit of every byte that is a blank or one of the controls 9 to 13."""
    low = words & _LOWS
    other = (low ^ _repeated(0x20)) + _LOWS                       # top bit unless the byte is a blank
    control = (low + _repeated(0x80 - 9)) & ~(low + _repeated(0x80 - 14))
    return (~other | control) & ~words & _TOPS


class Marks:
    """Marked bytes of a buffer, with rank and select."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        self.upto = np.concatenate([[0], np.cumsum(np.bitwise_count(marks), dtype=np.int64)])

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Marked bytes before each place."""
        word, byte = places >> 3, (places & 7).astype(np.uint64)
        below = (np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1)
        held = np.append(self.marks, np.uint64(0))[word]
        return self.upto[word] + np.bitwise_count(held & below)

    def select(self, numbers: np.ndarray) -> np.ndarray:
        """The place of the mark with each number, from 1."""
        word = np.searchsorted(self.upto, numbers, side="left") - 1
        left = (numbers - self.upto[word]).astype(np.uint64)      # 1 to 8
        sums = (self.marks[word] >> np.uint64(7)) * _ONES         # marks up to and with each byte
        before = (((left - np.uint64(1)) * _ONES | _TOPS) - sums) & _TOPS
        return word * 8 + np.bitwise_count(before)


def marked(data: np.ndarray, offsets: np.ndarray) -> tuple[Marks, Marks]:
    """Token ends and starts of code points, of the texts between ``offsets`` (from 0) in ``data``."""
    padded = np.zeros(-(-len(data) // 8) * 8, dtype=np.uint8)
    padded[:len(data)] = data
    words = padded.view("<u8").astype(np.uint64, copy=False)
    spaces = space_marks(words)
    following = spaces >> np.uint64(8)
    following[:-1] |= spaces[1:] << np.uint64(56)
    ends = ~spaces & following & _TOPS
    last = np.unique(offsets[1:][np.diff(offsets) > 0]) - 1       # the next byte is another text's
    np.bitwise_or.at(ends, last >> 3, np.uint64(0x80) << ((last & 7) * 8).astype(np.uint64))
    inside = words & ~(words << np.uint64(1)) & _TOPS             # 10xxxxxx
    return Marks(ends), Marks(~inside & _TOPS)


def _hashes(seed: int) -> list[Column]:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80,
                   sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """``doc_id, text, n, form, prefix_chars, middle_chars, output`` for every row of ``docs``.

    ``rate`` per cent of the documents are cut, ``spm_rate`` per cent of these have the suffix first.
    """
    before, behind, between = (s.encode() for s in sentinels)
    held = F.greatest(*[F.contains("text", F.lit(s)) for s in sentinels])
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *_hashes(seed))
    # 0 plain, 1 prefix first, 2 suffix first
    form = F.when((F.length("text") == 0) | held | (F.col("h3") % 100 >= rate), 0).when(F.col("h4") % 100 < spm_rate, 2).otherwise(1)
    source = source.select("doc_id", "text", "h1", "h2", form.alias("kind"))
    schema = T.StructType([
        source.schema["doc_id"], source.schema["text"], T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                texts = part.column(1)
                at = text_offsets(texts)
                data = text_bytes(texts)[at[0]:at[-1]]
                at = at - at[0]
                ends, starts = marked(data, at)
                first = ends.rank(at)
                n = np.diff(first)
                cuts = np.sort(np.stack([part.column(i).to_numpy() % (n + 1) for i in (2, 3)]), axis=0)
                kinds = part.column(4).to_numpy()
                wanted = np.where(kinds > 0, cuts, 0)
                places = [np.where(w > 0, 0, at[:-1]) for w in wanted]
                for place, w in zip(places, wanted):
                    some = np.flatnonzero(w)
                    place[some] = ends.select(first[some] + w[some]) + 1
                one, two = places
                chars = [starts.rank(p) for p in (at[:-1], one, two)]
                raw, out = data.tobytes(), []
                for kind, a, b, c, z in zip(kinds.tolist(), at[:-1].tolist(), one.tolist(), two.tolist(), at[1:].tolist()):
                    if kind == 0:
                        out.append(raw[a:z])
                    elif kind == 1:
                        out.append(b"".join((before, raw[a:b], behind, raw[c:z], between, raw[b:c])))
                    else:
                        out.append(b"".join((behind, raw[c:z], before, raw[a:b], between, raw[b:c])))
                plain = kinds == 0
                yield pa.RecordBatch.from_arrays([
                    part.column(0), texts, pa.array(n, pa.int64()),
                    pa.array(np.array([PLAIN, PSM, SPM], dtype=object)[kinds], pa.string()),
                    pa.array(chars[1] - chars[0], pa.int64(), mask=plain), pa.array(chars[2] - chars[1], pa.int64(), mask=plain),
                    pa.array(out, pa.binary()).cast(pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)


def restored(output: str = "output", form: str = "form", sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text again, from an output and its form."""
    pattern = "|".join(f"\\Q{s}\\E" for s in sentinels)
    parts = F.split(F.col(output), pattern)
    order = F.when(F.col(form) == PSM, F.array(F.lit(1), F.lit(3), F.lit(2))).otherwise(F.array(F.lit(2), F.lit(3), F.lit(1)))
    return F.when(F.col(form) == PLAIN, F.col(output)).otherwise(F.array_join(F.transform(order, lambda i: F.get(parts, i)), ""))
