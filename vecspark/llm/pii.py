"""Personal data: base patterns, and identifiers found by bootstrapped context.

Base kinds are e-mail addresses, IPv4 addresses, payment cards and phone
numbers, each found leftmost and without overlap by its pattern; matches that
fail the kind's condition are dropped.

Around them, contexts are learned. A mention is a base span, which makes it a
seed, or a candidate: neighbouring tokens with a digit or an ``@``, of any
length, that no punctuation, line end or key parts. A mention has lexical
patterns: the word before it, the two words before it, the words on both sides,
and the key of ``key=value``. Distinct (pattern, instance) pairs make a graph
that Spark scores in rounds: a pattern is as reliable as the mean of its
instances, with one doubtful instance added and with every plain word that
stands in the same context anywhere in the table; an instance as its patterns
together; seeds stay at 1. Patterns with enough distinct seeds and high
confidence are trusted. What they point at counts as a seed in the next rounds,
so that it opens further contexts, until no pattern is new. What trusted
patterns point at becomes a span of kind ``context``. Instances of passages that
repeat count once, plain words each time.

Positions are code points, ends exclusive. Null and empty texts have no spans.
Every step is linear in a text, whatever it holds, and so are runs of digits or
of letters without a blank. Numbers of any length fail their kind's condition.
Rows with one id are treated one by one. Other columns are carried along by
``redact`` under any name and ignored by ``find``.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import slices, strings
from .components import kept_table

# The base kinds in order, and their patterns.
KINDS = ("email", "ip", "card", "phone")
# [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ is found from its @: the characters before it, and the domain behind it
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+) are four parts of a run of parts
PARTS = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CONTEXT = "context"

ROUNDS = 3
MIN_SEEDS = 3              # distinct seed instances of a trusted pattern
MIN_CONFIDENCE = 0.75
WHOLE_CHARS = 64           # of a word or an instance in the graph; a longer one stands there by its hash
ASKED = 1 << 20            # contexts whose plain words are counted in one pass over the texts
FILTER_BITS = 22           # of the table that most other contexts are dropped by before the search

_FACTORS = ((0x9E3779B97F4A7C15, 0), (0xC2B2AE3D27D4EB4F, 0x9FB21C651E98DF25), (0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD))
_DIGITS = re.compile("[^0-9]+")
_DOTTED = re.compile("[0-9][.][0-9]")
_MARK = re.compile("[0-9@]")
_TOKEN = re.compile(r"\S+")
_ENDS = ",;:!?."
_EDGES = "\"'`.,;:!?()[]{}<>"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        total += digit if place % 2 == 0 else digit * 2 - 9 * (digit > 4)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the base kinds, in order."""
    found, reach, at = [], 0, text.find("@")
    while at >= 0:
        start = reach + len(text[reach:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        reach = domain.end() if domain else at + 1
        if domain:
            found.append((start, 0, reach))
        at = text.find("@", reach)
    if _DOTTED.search(text):
        for m in PARTS.finditer(text):
            parts, start = m.group().split("."), m.start()
            for i in range(0, len(parts) - 3, 4):
                own = parts[i:i + 4]
                end = start + sum(map(len, own)) + 3
                if all(len(p) < 4 or len(p.lstrip("0")) < 4 for p in own) and all(int(p[-3:]) <= 255 for p in own):
                    found.append((start, 1, end))
                start = end + 1
    for m in CARD.finditer(text):
        digits = _DIGITS.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m.group())) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def _short(word: str) -> str:
    """``word`` itself, or a stand-in of bounded size for a long one."""
    return word if len(word) <= WHOLE_CHARS else f"{word[:32]}#{hashlib.md5(word.encode('utf-8', 'surrogatepass')).hexdigest()}"


def _runs(text: str, tokens: list, spans: list) -> list[tuple[int, int, int, int, bool]]:
    """``(first, last, start, end, seed)``: token runs that are mentions, with their characters.

    Base spans come first, those that share a token as one; then runs of
    neighbouring tokens with a mark that no punctuation, line end or key parts.
    """
    runs, at = [], 0
    for start, _, end in spans:
        while tokens[at][1] <= start:
            at += 1
        last = at
        while last + 1 < len(tokens) and tokens[last + 1][0] < end:
            last += 1
        if runs and at <= runs[-1][1]:
            first, before, left, right, _ = runs[-1]
            runs[-1] = (first, max(before, last), left, max(right, end), True)
        else:
            runs.append((at, last, start, end, True))
    taken = {i for first, last, *_ in runs for i in range(first, last + 1)}
    own = None
    for i, (start, end) in enumerate(tokens):
        if i in taken or _MARK.search(text, start, end) is None:
            own = None
            continue
        parted = own is None or text[tokens[i - 1][1] - 1] in _ENDS or "=" in text[start:end] or "\n" in text[tokens[i - 1][1]:start]
        if parted:
            own = len(runs)
            runs.append((i, i, start, end, False))
        else:
            runs[own] = (runs[own][0], i, runs[own][2], end, False)
    return sorted(runs)


def mentions(text: str, spans: list) -> list[dict]:
    """Base spans, and runs of tokens with a digit or an ``@``, each with its patterns."""
    if _MARK.search(text) is None:
        return []
    tokens = [m.span() for m in _TOKEN.finditer(text)]

    def word(i: int) -> str:
        return _short(text[slice(*tokens[i])].lower()) if 0 <= i < len(tokens) else ""

    found = []
    for first, last, start, end, seed in _runs(text, tokens, spans):
        left = tokens[first][0]
        while left < end and text[left] in _EDGES:
            left += 1
        if not seed:
            start = left
            while end > start and text[end - 1] in _EDGES:
                end -= 1
        key = text.find("=", left, start if seed else end)
        if key > left:
            patterns = ["key " + _short(text[left:key].lower())]
            if not seed:
                start = key + 1
                while start < end and text[start] in _EDGES:
                    start += 1
        elif first:
            patterns = [f"after {word(first - 1)}", f"between {word(first - 1)} {word(last + 1)}"]
            if first > 1:
                patterns.append(f"after {word(first - 2)} {word(first - 1)}")
        else:
            patterns = []
        if end > start:
            found.append({"start": start, "end": end, "instance": _short(text[start:end].lower()), "seed": seed, "patterns": patterns})
    return found


def scan(docs: DataFrame, with_rows: bool = False) -> DataFrame:
    """One row per document: ``node, doc_id, spans, mentions`` (and ``text, row``)."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    source = docs.select(F.monotonically_increasing_id().alias("node"), "doc_id", "text", *([row.alias("row")] if with_rows else []))
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("end", T.LongType())])
    mention = T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("instance", T.StringType()),
        T.StructField("seed", T.BooleanType()), T.StructField("patterns", T.ArrayType(T.StringType()))])
    kept = [f for f in source.schema.fields if with_rows or f.name != "text"]
    schema = T.StructType([*kept, T.StructField("spans", T.ArrayType(span)), T.StructField("mentions", T.ArrayType(mention))])
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())]))
    mentions_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("instance", pa.string()), ("seed", pa.bool_()),
                                        ("patterns", pa.list_(pa.string()))]))

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                spans, found = [], []
                for text in strings(part):
                    own = base_spans(text)
                    spans.append([{"start": s, "kind": k, "end": e} for s, k, e in own])
                    found.append(mentions(text, own))
                columns = [part.column(part.schema.get_field_index(f.name)) for f in kept]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(spans, spans_type), pa.array(found, mentions_type)], names=schema.names)

    return source.mapInArrow(run, schema)


def _code(word: str) -> int:
    """63 bits of a word's hash above one bit that tells whether it holds a mark; 0 for no word."""
    if not word:
        return 0
    return xxhash.xxh3_64_intdigest(_short(word).encode("utf-8", "surrogatepass")) & ~1 | (_MARK.search(word) is not None)


def _context(number: int, one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """64-bit hashes of contexts of one kind (0 one word before, 1 two, 2 both sides), by the codes of their words."""
    first, second = (np.uint64(_FACTORS[number][i]) for i in range(2))
    mixed = (one >> np.uint64(1)) * first + (two >> np.uint64(1)) * second
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(_FACTORS[0][0])
    return mixed ^ (mixed >> np.uint64(29))


def _hashed(patterns: DataFrame) -> DataFrame:
    """``key, pattern`` of the patterns that a plain word can stand in."""
    def run(batches):
        for batch in batches:
            names, keys = [], []
            for pattern in batch.column(0).to_pylist():
                kind, *words = pattern.split(" ")
                if kind != "key":
                    number = 2 if kind == "between" else len(words) - 1
                    one, two = (np.array([_code(w)], dtype=np.uint64) for w in (words * 2)[:2])
                    names.append(pattern)
                    keys.append(_context(number, one, two).view(np.int64)[0])
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(names, pa.string())], names=["key", "pattern"])

    return patterns.select("pattern").mapInArrow(run, "key long, pattern string")


def _key_counts(docs: DataFrame, keys: np.ndarray) -> DataFrame:
    """``key, plain``: how often a plain word stands in each of the contexts ``keys`` (sorted), one row per task and key."""
    shared = docs.sparkSession.sparkContext.broadcast(keys.tobytes())

    def run(batches):
        asked = np.frombuffer(shared.value, dtype=np.uint64)
        counts = np.zeros(len(asked), dtype=np.int64)
        shift = np.uint64(64 - FILTER_BITS)
        maybe = np.zeros(1 << FILTER_BITS, dtype=bool)                     # spares most contexts the search
        maybe[asked >> shift] = True
        codes = {}
        for batch in batches:
            for part in slices(batch):
                for text in strings(part):
                    words = text.lower().split()
                    for w in words:
                        if w not in codes:
                            codes[w] = _code(w)
                    coded = np.array([codes[w] for w in words] + [0], dtype=np.uint64)
                    here = np.flatnonzero((coded[1:-1] & np.uint64(1)) == 0) + 1             # plain words with a word before them
                    later = here[here > 1]
                    found = np.concatenate([_context(0, coded[here - 1], coded[here - 1]), _context(1, coded[later - 2], coded[later - 1]),
                                            _context(2, coded[here - 1], coded[here + 1])])
                    found = found[maybe[found >> shift]]
                    place = np.minimum(np.searchsorted(asked, found), len(asked) - 1)
                    np.add.at(counts, place[asked[place] == found], 1)
                    if len(codes) > 500_000:
                        codes.clear()
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(asked[some].view(np.int64)), pa.array(counts[some])], names=["key", "plain"])

    return docs.select("text").mapInArrow(run, "key long, plain long")


def plain_counts(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """``pattern, plain``: how often a word without a mark stands in the context, over all of ``docs``.

    Contexts are told apart by 64-bit hashes. Tasks count those that are asked
    for against a sorted table, at most ``ASKED`` of them in one pass over the
    texts, and send one row for each that they met.
    """
    hashed = kept_table(_hashed(patterns), "pii-asked")
    passes = -(-hashed.count() // ASKED)
    counted = None
    for turn in range(passes):
        own = hashed.where(F.pmod("key", F.lit(passes)) == turn).select("key").distinct().toArrow()
        if own.num_rows:
            found = kept_table(_key_counts(docs, np.sort(own.column("key").to_numpy().view(np.uint64))).groupBy("key").agg(F.sum("plain").alias("plain")), "pii-counts")
            counted = found if counted is None else counted.unionAll(found)
    if counted is None:
        return hashed.select("pattern", F.lit(0).cast("long").alias("plain"))
    return hashed.join(counted, "key").select("pattern", "plain")


def _bootstrapped(edges: DataFrame, rounds: int, min_seeds: int, min_confidence: float) -> tuple[DataFrame, DataFrame]:
    """All patterns with a seed, and the trusted ones; what these point at is a seed from then on, until no pattern is new."""
    trusted_before, rows = 0, edges.count()
    while True:
        known = edges.withColumn("belief", F.col("seed").cast("double"))
        for turn in range(rounds):
            patterns = known.groupBy("pattern").agg(
                (F.sum("belief") / (F.count("*") + F.max("plain") + 1)).alias("confidence"), F.sum(F.col("seed").cast("long")).alias("seeds"))
            patterns = kept_table(patterns.where(F.col("seeds") >= 1), "pii-patterns", rows)
            if turn < rounds - 1:
                scored = edges.join(patterns, "pattern", "left")
                belief = scored.groupBy("instance").agg(
                    F.max("seed").alias("any_seed"), F.sum(F.log1p(-F.least(F.coalesce("confidence", F.lit(0.0)), F.lit(0.999)))).alias("doubt"))
                # written first: a side that an aggregation has dealt out keeps the join from splitting a common instance
                belief = kept_table(belief.select("instance", F.when(F.col("any_seed"), 1.0).otherwise(1 - F.exp("doubt")).alias("belief")), "pii-belief", rows)
                known = kept_table(edges.join(belief, "instance"), "pii-beliefs", rows)
        trusted = patterns.where((F.col("seeds") >= min_seeds) & (F.col("confidence") >= min_confidence)).select("pattern", "confidence")
        number = trusted.count()
        if number == trusted_before:
            return patterns, trusted
        trusted_before = number
        reached = edges.join(trusted, "pattern", "left_semi").select("instance", F.lit(True).alias("reached")).distinct()
        edges = edges.join(reached, "instance", "left").withColumn("seed", F.col("seed") | F.coalesce("reached", F.lit(False))).drop("reached")
        edges = kept_table(edges, "pii-graph", rows)


def trusted_patterns(scanned: DataFrame, docs: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS,
                     min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``pattern, confidence`` of the patterns that point at identifiers reliably."""
    edges = scanned.select(F.explode("mentions").alias("m")).select(
        F.explode("m.patterns").alias("pattern"), F.col("m.instance").alias("instance"), F.col("m.seed").alias("seed"))
    edges = edges.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"))
    # a seed's instance is one in all its contexts
    seeds = edges.where("seed").select("instance", F.lit(True).alias("known")).distinct()
    edges = edges.join(seeds, "instance", "left").select("pattern", "instance", F.coalesce("known", F.lit(False)).alias("seed"), F.lit(0).cast("long").alias("plain"))
    edges = kept_table(edges, "pii-graph")
    patterns, trusted = _bootstrapped(edges, rounds, min_seeds, min_confidence)
    if trusted.isEmpty():              # plain words only lower a confidence
        return trusted
    counts = kept_table(plain_counts(docs, patterns), "pii-plain")
    counted = edges.drop("plain").join(counts, "pattern", "left").withColumn("plain", F.coalesce("plain", F.lit(0)).cast("long"))
    return _bootstrapped(kept_table(counted, "pii-graph"), rounds, min_seeds, min_confidence)[1]


def discovered(scanned: DataFrame, trusted: DataFrame) -> DataFrame:
    """``node, extra``: per row the candidate spans that a trusted pattern points at."""
    candidates = scanned.select("node", F.explode(F.filter("mentions", lambda m: ~m["seed"])).alias("m")).select(
        "node", "m.start", "m.end", F.explode("m.patterns").alias("pattern"))
    hits = candidates.join(trusted.select("pattern"), "pattern").select("node", "start", "end").distinct()
    kind = F.lit(len(KINDS)).alias("kind")
    return hits.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("start", kind, "end"))).alias("extra"))


def _found(docs: DataFrame, with_rows: bool) -> DataFrame:
    scanned = kept_table(scan(docs, with_rows), "pii-rows", compression="zstd")
    extra = discovered(scanned, trusted_patterns(scanned, docs))
    none = F.array().cast(scanned.schema["spans"].dataType)
    return scanned.drop("mentions").join(extra, "node", "left").withColumn(
        "all_spans", F.array_sort(F.concat("spans", F.coalesce("extra", none))))


def _written(spans) -> Column:
    names = F.array(*[F.lit(k) for k in (*KINDS, CONTEXT)])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, n_context, base_sha256, spans`` for every row of ``docs``."""
    def number(kind: int):
        return F.size(F.filter("all_spans", lambda s: s["kind"] == kind)).cast("long")

    return _found(docs, False).select(
        "doc_id", *[number(i).alias(f"n_{k}") for i, k in enumerate((*KINDS, CONTEXT))],
        F.sha2(_written("spans").cast("binary"), 256).alias("base_sha256"), _written("all_spans").alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` as ``row`` (struct of the other columns) and ``text`` with every span replaced by its kind in brackets.

    Overlapping spans are replaced together, under the kind of the first. A null text stays null.
    """
    found = _found(docs, True).select("text", "row", "all_spans")
    schema = T.StructType([found.schema["text"], found.schema["row"], T.StructField("replaced", T.LongType())])
    names = [f"[{k.upper()}]" for k in (*KINDS, CONTEXT)]

    def clean(text, spans):
        if not spans:
            return text
        out, reach = [], 0
        for span in spans:
            if span["start"] >= reach:
                out += [text[reach:span["start"]], names[span["kind"]]]
            reach = max(reach, span["end"])
        return "".join(out) + text[reach:]

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                spans = part.column(2).to_pylist()
                texts = [clean(t, s) for t, s in zip(part.column(0).to_pylist(), spans)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()), part.column(1), pa.array([len(s) for s in spans], pa.int64())], names=schema.names)

    return found.mapInArrow(run, schema)
