"""Named, key-protected collections of items on a shared folder.

A collection is a set of immutable parquet segments, partitioned by list id,
plus removal files: ids whose older rows no longer count. An upsert or delete
writes only its own rows; reads drop removed rows with an anti-join. When files pile
up, ``fold`` merges the small ones and ``compact`` rewrites everything. No file
is ever changed, so a running read keeps its version; ``vacuum`` deletes files
that are out of use.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import protect
from ..functions.distance import EUCLIDEAN, check_metric
from ..functions.embed import detect_dimension
from ..functions.filters import PROMOTABLE, compile_filter, promote, pushed_filter
from ..operators import merge, pq, search, train, validate
from ..operators.train import SPLIT_FACTOR
from ..sources.items import from_arrays, item_rows
from .catalog import Catalog, VersionConflict
from .workspace import scratch_path, spread_small, written

INDEX_TYPES = ("ivf", "ivfflat", "ivfpq")
DEFAULT_TYPE = "ivfflat"
DEFAULT_INCLUDE = ("distance", "metadata")
DEFAULT_RETRAIN_MULTIPLIER = 2.0
DEFAULT_MIN_TRAIN_ROWS = 10_000
MAX_REMOVALS = 2_000_000     # removed ids that a read broadcasts; beyond that they are shuffled until compact()
MAX_SEGMENTS = 64
MAX_FILES = 10_000           # files named in a read; when ids lie in more of them, their segments are read
COMMIT_TRIES = 20


class CollectionExists(ValueError):
    pass


class NoSuchCollection(LookupError):
    pass


def normalize_config(config: dict | None) -> dict:
    """Type, dimension and PQ settings from either spelling, checked."""
    config = dict(config or {})
    kind = config.get("type") or DEFAULT_TYPE
    if kind not in INDEX_TYPES:
        raise ValueError(f"unknown index type {kind!r}; expected one of {', '.join(INDEX_TYPES)}")
    dimension = config.get("dimension") or None
    if dimension is not None and (not isinstance(dimension, int) or dimension < 0):
        raise ValueError("dimension must be a positive integer")
    out = {"type": kind, "dimension": dimension, "pq_dim": None, "pq_bits": None}
    if kind == "ivfpq":
        pick = lambda a, b, default: next((config[k] for k in (a, b) if config.get(k) is not None), default)
        out["pq_dim"] = pick("pq_dim", "pqDim", pq.DEFAULT_PQ_DIM)
        out["pq_bits"] = pick("pq_bits", "pqBits", pq.DEFAULT_PQ_BITS)
        pq.check_pq(dimension, out["pq_dim"], out["pq_bits"])
    return out


class VectorStore:
    """Entry point: the collections below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.catalog = Catalog(spark, root)

    def create(
        self,
        name: str,
        key: bytes,
        config: dict | None = None,
        metric: str | None = None,
        embedding_model: str | None = None,
        embedder=None,
        seal: bool = True,
        metadata_columns: dict[str, str] | None = None,
        retrain_multiplier: float = DEFAULT_RETRAIN_MULTIPLIER,
        min_train_rows: int = DEFAULT_MIN_TRAIN_ROWS,
    ) -> "Collection":
        """New collection; ``metadata_columns`` (path to type) repeats metadata in plain typed columns."""
        if not isinstance(name, str) or not name.strip():
            raise ValueError("the index name cannot be empty")
        protect.check_key(key)
        config = normalize_config(config)
        check_metric(metric or EUCLIDEAN)
        for kind in (metadata_columns or {}).values():
            if kind not in PROMOTABLE:
                raise ValueError(f"metadata columns are one of {', '.join(PROMOTABLE)}")
        before = self.catalog.state(name)
        if before is not None and not before.get("dropped"):
            raise CollectionExists(f"index {name!r} already exists")
        salt = protect.new_salt()
        state = {
            "index_name": name, "version": before["version"] if before else 0, "dropped": False,
            "index_type": config["type"], "is_trained": False, "metric": metric or EUCLIDEAN,
            "embedding_model": embedding_model, "dimension": config["dimension"], "element": None,
            "pq_dim": config["pq_dim"], "pq_bits": config["pq_bits"], "n_lists": None, "n_probes": None, "reach": None, "density": None,
            "n_at_train": None, "sealed": seal, "key_salt": salt, "key_fingerprint": protect.fingerprint(key, salt),
            "folder": f"{self.catalog.root}/collections/{uuid.uuid4().hex}", "seq": 0, "segments": [],
            "removals": [], "centroids": None, "codebooks": None, "metadata_columns": metadata_columns or {},
            "retrain_multiplier": float(retrain_multiplier), "min_train_rows": min_train_rows,
            "training": None, "applied": {},
        }
        try:
            self.catalog.commit(state)
        except VersionConflict as error:
            raise CollectionExists(f"index {name!r} already exists") from error
        return Collection(self, name, key, embedder)

    def load(self, name: str, key: bytes, embedder=None) -> "Collection":
        state = self.catalog.live(name)
        if state is None:
            raise NoSuchCollection(f"index {name!r} does not exist")
        protect.require_key(key, state["key_salt"], state["key_fingerprint"])
        return Collection(self, name, key, embedder)

    def open_or_create(self, name: str, key: bytes, embedder=None, config: dict | None = None, **options) -> "Collection":
        """Load when the name exists, else create; the embedder tells the dimension when none is given."""
        if self.catalog.live(name) is not None:
            return self.load(name, key, embedder)
        config = dict(config or {})
        if embedder is not None and not config.get("dimension"):
            config["dimension"] = detect_dimension(self.spark, embedder)
        return self.create(name, key, config, embedder=embedder, **options)

    def list(self) -> DataFrame:
        return self.catalog.table().select("index_name")

    def describe(self, name: str) -> DataFrame:
        return self.catalog.table().where(F.col("index_name") == name).select(
            "index_name", "index_type", "is_trained",
            F.struct(F.col("index_type").alias("type"), "dimension", "metric", "pq_dim", "pq_bits", "n_lists")
            .alias("index_config"))

    def drop(self, name: str, key: bytes, if_exists: bool = False) -> bool:
        """Delete a collection and its files; False when it was already gone and ``if_exists``."""
        state = self.catalog.live(name)
        if state is None:
            if if_exists:
                return False
            raise NoSuchCollection(f"index {name!r} does not exist")
        protect.require_key(key, state["key_salt"], state["key_fingerprint"])
        self.catalog.commit(dict(state, dropped=True))
        self.catalog.remove(state["folder"])
        return True


class Collection:
    """Handle of one collection; every call reads the newest committed version."""

    def __init__(self, store: VectorStore, name: str, key: bytes, embedder=None):
        self.store = store
        self.spark = store.spark
        self.catalog = store.catalog
        self.name = name
        self.embedder = embedder
        self._key = key

    # -- description --------------------------------------------------------

    def state(self) -> dict:
        state = self.catalog.live(self.name)
        if state is None:
            raise NoSuchCollection(f"index {self.name!r} does not exist")
        protect.require_key(self._key, state["key_salt"], state["key_fingerprint"])
        return state

    @property
    def index_type(self) -> str:
        return self.state()["index_type"]

    @property
    def is_trained(self) -> bool:
        return self.state()["is_trained"]

    @property
    def config(self) -> dict:
        state = self.state()
        out = {"type": state["index_type"], "dimension": state["dimension"], "metric": state["metric"]}
        if state["index_type"] == "ivfpq":
            out.update(pq_dim=state["pq_dim"], pq_bits=state["pq_bits"])
        return out

    def describe(self) -> DataFrame:
        return self.store.describe(self.name)

    def drop(self, if_exists: bool = False) -> bool:
        return self.store.drop(self.name, self._key, if_exists)

    # -- rows -----------------------------------------------------------------

    def _promoted(self, state: dict) -> dict[str, tuple[str, str]]:
        return {path: (f"m{i}", kind) for i, (path, kind) in enumerate(sorted(state["metadata_columns"].items()))}

    def _schema(self, state: dict) -> T.StructType:
        kinds = ["id string", f"vector array<{state['element'] or 'float'}>", "contents binary", "is_text boolean",
                 "metadata " + ("binary" if state["sealed"] else "variant")]
        kinds += [f"{column} {kind}" for column, kind in self._promoted(state).values()]
        if state["index_type"] == "ivfpq":
            kinds.append("codes array<smallint>")
        return T.StructType.fromDDL(", ".join(kinds + ["list_id int", "seg string"]))

    def _stored(self, state: dict, segments: list[dict] | None = None, files: list[str] | None = None) -> DataFrame:
        """Live rows as stored (sealed columns still sealed), of all or of the given segments, or of some of their files."""
        schema = self._schema(state)
        segments = state["segments"] if segments is None else segments
        if not segments:
            return self.spark.createDataFrame([], schema).drop("seg")
        folder = f"{state['folder']}/items"
        rows = (self.spark.read.schema(schema).option("basePath", folder)
                .parquet(*(files if files is not None else [f"{folder}/seg={s['name']}" for s in segments])))
        for gone in {tuple(s.get("gone") or ()) for s in segments} - {()}:      # lists that were split since
            names = [s["name"] for s in segments if tuple(s.get("gone") or ()) == gone]
            rows = rows.where(~(F.col("seg").isin(names) & F.col("list_id").isin(list(gone))))
        removals = [r for r in state["removals"] if r["seq"] > min(s["seq"] for s in segments)]
        if not removals:
            return rows.drop("seg")
        gone = self._removed(state, removals).select(F.col("id").alias("_id"), F.col("until").alias("_until"))
        if sum(r["n"] for r in removals) <= MAX_REMOVALS:
            gone = F.broadcast(gone)
        dead = (F.col("id") == F.col("_id")) & (_lookup("seg", segments) < F.col("_until"))
        return rows.join(gone, dead, "left_anti").drop("seg")

    def _segments_of(self, state: dict, extent) -> list[dict]:
        """Segments whose ids can be among those between ``extent.lo`` and ``extent.hi``."""
        return [s for s in state["segments"] if extent.lo is not None and (s.get("lo") is None or s["lo"] <= extent.hi and extent.lo <= s["hi"])]

    def _near(self, state: dict, ids: DataFrame, lists: list[int] | None = None) -> DataFrame:
        """Live rows of the files that hold any of the ids: other files give their id column at most.

        Segments are left out by their bounds, row groups by the statistics of
        the sorted ids, files by a look at the ids alone. Of ``lists``, if the
        ids are known to lie in them, other folders are not even looked at.
        """
        extent = ids.agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
        segments = self._segments_of(state, extent)
        if not segments:
            return self._stored(state, [])
        between = F.col("id").between(extent.lo, extent.hi)
        folder = f"{state['folder']}/items"
        looked = self.spark.read.schema("id string, list_id int, seg string").option("basePath", folder).parquet(*[f"{folder}/seg={s['name']}" for s in segments])
        where = (search.within_lists(looked, lists)
                 .select("id", F.regexp_extract("_metadata.file_path", "(seg=[^/]+/.*)$", 1).alias("file")).where(between))
        wanted = F.broadcast(ids.select("id")) if extent.n <= merge.MAX_BROADCAST_IDS else ids.select("id")
        files = [f"{folder}/{r.file}" for r in where.join(wanted, "id", "left_semi").select("file").distinct().limit(MAX_FILES + 1).collect()]
        if not files:
            return self._stored(state, [])
        return search.within_lists(self._stored(state, segments, files if len(files) <= MAX_FILES else None), lists).where(between)

    def _removed(self, state: dict, removals: list[dict]) -> DataFrame:
        """``(id, until)``: rows of the id older than ``until`` no longer count."""
        folder = f"{state['folder']}/removals"
        gone = (self.spark.read.schema("id string, until long, seg string").option("basePath", folder)
                .parquet(*[f"{folder}/seg={r['name']}" for r in removals]))
        return gone.select("id", F.coalesce("until", _lookup("seg", removals)).alias("until"))

    def _open(self, rows: DataFrame, state: dict, columns=("contents", "metadata")) -> DataFrame:
        """Unseal the named columns that are there."""
        if not state["sealed"]:
            return rows
        key = protect.key_column(self.spark, self._key)
        if "contents" in columns and "contents" in rows.columns:
            rows = rows.withColumn("contents", protect.unseal(F.col("contents"), key, F.col("id")))
        if "metadata" in columns and "metadata" in rows.columns:
            text = protect.unseal(F.col("metadata"), key, F.col("id")).cast("string")
            rows = rows.withColumn("metadata", F.parse_json(text))
        return rows

    def _filtered(self, rows: DataFrame, state: dict, filters: dict | None) -> DataFrame:
        if not filters:
            return rows
        promoted = {path: (F.col(column), kind) for path, (column, kind) in self._promoted(state).items()}
        rows = rows.where(pushed_filter(filters, promoted))
        if not state["sealed"]:
            return rows.where(compile_filter(filters, F.col("metadata")))
        key = protect.key_column(self.spark, self._key)
        opened = F.parse_json(protect.unseal(F.col("metadata"), key, F.col("id")).cast("string"))
        # a column of its own: the key is a subquery, which a lambda cannot hold
        return rows.withColumn("_opened", opened).where(compile_filter(filters, F.col("_opened"))).drop("_opened")

    def items(self, filters: dict | None = None) -> DataFrame:
        """Live rows ``(id, vector, contents, is_text, metadata)``."""
        state = self.state()
        rows = self._open(self._filtered(self._stored(state), state, filters), state)
        return rows.select("id", "vector", "contents", "is_text", "metadata")

    def get(self, ids, include=("vector", "contents", "metadata")) -> DataFrame:
        """Rows of the requested ids in request order (``pos``); unknown ids give no row.

        ``ids`` is a list or a frame ``(pos, id)``; unknown include names are ignored.
        """
        state = self.state()
        wanted = merge.id_frame(self.spark, ids) if isinstance(ids, (list, tuple)) else ids
        keep = [c for c in ("vector", "contents", "metadata") if c in include]
        found = merge.get_by_ids(self._near(state, wanted), wanted)
        extra = ["is_text"] if "contents" in keep else []
        return self._open(found.select("pos", "id", *keep, *extra), state).orderBy("pos")

    def payload(self, rows: DataFrame, columns, lists: list[int] | None = None) -> DataFrame:
        """``rows`` (with ``id``) with stored columns attached; ``lists`` as far as it is known where they lie."""
        state = self.state()
        extra = ["is_text"] if "contents" in columns and "is_text" not in columns else []
        stored = self._near(state, rows, lists).select("id", *columns, *extra)
        return self._open(stored.join(merge.bounded(rows), "id"), state)

    def list_ids(self, filters: dict | None = None) -> DataFrame:
        state = self.state()
        return self._filtered(self._stored(state), state, filters).select("id")

    def num_vectors(self) -> DataFrame:
        return merge.num_vectors(self._stored(self.state()))

    # -- writing --------------------------------------------------------------

    def upsert(self, items: DataFrame, mode: str = "fail", order: Column | None = None,
               auto_train: bool = True, applied: tuple[str, int] | None = None,
               rejects: str | None = None) -> DataFrame | None:
        """Add or replace rows. Of rows with one id the last (by ``order``) counts.

        ``mode="fail"`` stops at the first bad row and stores nothing;
        ``mode="split"`` stores the good rows and returns the bad ones with
        their errors, having written them to the folder ``rejects`` if given.
        Every row is judged before rows of one id are made one. ``applied``
        names a (stream, batch): a batch already committed is skipped.
        """
        if mode not in ("fail", "split"):
            raise ValueError("mode is 'fail' or 'split'")
        _, bad = self._upsert(items, mode, order, applied, rejects)
        self._tidy(auto_train)
        return bad

    def write_batch(self, items: DataFrame, auto_train: bool = True) -> str | None:
        """Upsert, and tell the folder that holds exactly the rows of this batch (None when empty)."""
        folder, _ = self._upsert(items, "fail", None, None, None)
        self._tidy(auto_train)
        return folder

    def _upsert(self, items, mode, order, applied, rejects):
        for _ in range(COMMIT_TRIES):
            state = self.state()
            if applied and state["applied"].get(applied[0], -1) >= applied[1]:
                return None, None
            try:
                return self._upsert_once(state, items, mode, order, applied, rejects)
            except VersionConflict:
                continue
        raise VersionConflict(self.name)

    def upsert_arrays(self, frame: DataFrame, ids: str = "ids", vectors: str = "vectors", **options):
        return self.upsert(from_arrays(frame, ids, vectors), **options)

    def _upsert_once(self, state, items, mode, order, applied, rejects):
        """One try: the batch is written aside, judged, made one row per id, and committed."""
        rows = item_rows(items.withColumn("_order", F.monotonically_increasing_id() if order is None else order), ("_order",))
        if self.embedder is not None:
            rows = spread_small(rows)
            text = F.when(F.col("vector").isNull() & F.col("is_text"), F.col("contents").cast("string"))
            rows = rows.withColumn("vector", F.coalesce(F.col("vector"), self.embedder(text)))
        # source and embedder run once; what follows knows the size of its input
        aside = f"{state['folder']}/aside/{uuid.uuid4().hex}"
        try:
            rows.write.parquet(aside)
            return self._upsert_rows(state, self.spark.read.schema(rows.schema).parquet(aside), mode, applied, rejects)
        finally:
            self.catalog.remove(aside)

    def _upsert_rows(self, state, rows, mode, applied, rejects):
        state = self._shaped(state, rows)
        rows = rows.withColumn("vector", F.col("vector").cast(f"array<{state['element']}>"))
        good, bad = validate.split_valid(rows, state["dimension"])
        bad = bad.drop("_order")
        if mode == "split":
            folder = rejects if rejects is not None else scratch_path(self.spark, "rejects")
            bad.write.mode("overwrite").parquet(folder)
            bad = self.spark.read.schema(bad.schema).parquet(folder)
        elif (first := bad.select("id", "errors").first()) is not None:
            raise ValueError(f"Invalid item (id: {first['id']}): {'; '.join(first['errors'])}")
        last = merge.latest_per_id(good, F.col("_order")).drop("_order")
        name = self._write_segment(self._coded(last, state), state)
        folder = f"{state['folder']}/items/seg={name}"
        extent = self._extent(folder)
        if extent.n == 0:
            self.catalog.remove(folder)
            return None, bad
        ids = self.spark.read.schema("id string").parquet(folder).select("id")
        removal = self._note_removals(ids, extent, state)
        self._commit_rows(state, name, extent, removal, applied)
        return folder, bad

    def _shaped(self, state: dict, rows: DataFrame) -> dict:
        """The dimension and element type, taken from the first rows when not known yet."""
        kind = rows.schema["vector"].dataType.elementType.simpleString()
        state = dict(state, element=state["element"] or kind)
        if state["dimension"] is None:
            first = rows.where(F.size("vector") > 0).select(F.size("vector").alias("n")).first()
            state["dimension"] = first["n"] if first else None
            if state["index_type"] == "ivfpq":
                pq.check_pq(state["dimension"], state["pq_dim"], state["pq_bits"])
        return state

    def _coded(self, rows: DataFrame, state: dict) -> DataFrame:
        """Typed metadata columns, list ids and codes for new rows, then sealing."""
        for path, (column, kind) in self._promoted(state).items():
            rows = rows.withColumn(column, promote(F.col("metadata"), path, kind))
        if state["is_trained"]:
            centroids = self._centroids(state)
            rows = train.assign_lists(rows, centroids, state["metric"])
        else:
            rows = rows.withColumn("list_id", F.lit(train.UNASSIGNED))
        if state["index_type"] == "ivfpq":
            codes = pq.pq_codes(rows, self._codebooks(state), state["metric"]) if state["is_trained"] \
                else F.lit(None).cast("array<smallint>")
            rows = rows.withColumn("codes", codes)
        if state["sealed"]:
            key = protect.key_column(self.spark, self._key)
            rows = rows.withColumn("contents", protect.seal(F.col("contents"), key, F.col("id")))
            rows = rows.withColumn("metadata", protect.seal(F.to_json("metadata"), key, F.col("id")))
        return rows

    def _write_segment(self, rows: DataFrame, state: dict) -> str:
        name = uuid.uuid4().hex
        if state["is_trained"]:
            # few files per list; adaptive execution cuts a large list into several
            rows = rows.hint("rebalance", "list_id")
        folder = f"{state['folder']}/items/seg={name}"
        try:
            # sorted by id, so that statistics tell row groups apart
            rows.sortWithinPartitions("list_id", "id").write.partitionBy("list_id").parquet(folder)
        except Exception:
            self.catalog.remove(folder)
            raise
        return name

    def _count(self, folder: str, schema: str) -> int:
        return self.spark.read.schema(schema).parquet(folder).count()

    def _extent(self, folder: str):
        """``n, lo, hi``: number and bounds of the ids below a folder."""
        ids = self.spark.read.schema("id string").parquet(folder)
        return ids.agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()

    def _note_removals(self, ids: DataFrame, extent, state: dict) -> dict | None:
        """A removal file for those of the given ids that exist; None when none does.

        Only segments whose bounds meet those of the ids are read, and of these
        the row groups that do.
        """
        segments = self._segments_of(state, extent)
        if not segments:
            return None
        given = F.broadcast(ids) if extent.n <= merge.MAX_BROADCAST_IDS else ids
        stored = self._stored(state, segments).select("id").where(F.col("id").between(extent.lo, extent.hi))
        ids = stored.join(given, "id", "left_semi")
        name = uuid.uuid4().hex
        folder = f"{state['folder']}/removals/seg={name}"
        # the commit decides the sequence number, so the file leaves it open
        ids.withColumn("until", F.lit(None).cast("long")).write.parquet(folder)
        n = self._count(folder, "id string")
        if n == 0:
            self.catalog.remove(folder)
            return None
        return {"name": name, "n": n}

    def _commit_rows(self, state, name, extent, removal, applied) -> None:
        """Append a segment and a removal; a lost race is repeated unless rows or lists changed meanwhile."""
        for _ in range(COMMIT_TRIES):
            seq = state["seq"] + 1
            new = dict(state, seq=seq)
            if name is not None:
                new["segments"] = state["segments"] + [{"name": name, "seq": seq, "n": extent.n, "lo": extent.lo, "hi": extent.hi}]
            if removal is not None:
                new["removals"] = state["removals"] + [dict(removal, seq=seq)]
            if applied:
                new["applied"] = dict(state["applied"], **{applied[0]: applied[1]})
            try:
                self.catalog.commit(new)
                return
            except VersionConflict:
                latest = self.state()
                # the other job's rows may hold ids that were not there to be noted as removed
                if latest["centroids"] != state["centroids"] or latest["segments"] != state["segments"]:
                    raise
                state = dict(latest, dimension=latest["dimension"] or state["dimension"],
                             element=latest["element"] or state["element"])
        raise VersionConflict(self.name)

    def delete(self, ids) -> None:
        """Remove the listed ids (list or frame); unknown ids are ignored."""
        frame = merge.id_frame(self.spark, ids) if isinstance(ids, (list, tuple)) else ids
        for _ in range(COMMIT_TRIES):
            state = self.state()
            if not state["segments"]:
                return
            extent = frame.agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi")).first()
            removal = self._note_removals(frame.select("id"), extent, state)
            if removal is None:
                return
            try:
                self._commit_rows(state, None, extent, removal, None)
                break
            except VersionConflict:
                continue
        else:
            raise VersionConflict(self.name)
        self._tidy(auto_train=False)

    def _tidy(self, auto_train: bool) -> None:
        """After a write: train when the row count asks for it, else fold piled-up files.

        The first training fits all lists, later ones split those that have outgrown
        the others. Never a full rewrite; ``compact`` is for the caller to plan.
        A lost race is left to the next write.
        """
        state = self.state()
        written = sum(s["n"] for s in state["segments"])
        rule = (state["n_at_train"], state["retrain_multiplier"], state["min_train_rows"])
        try:
            if auto_train and train.needs_training(written, *rule) and self.needs_training():
                if state["is_trained"]:
                    self.split_lists()
                else:
                    self.train()
            elif max(len(state["segments"]), len(state["removals"])) > MAX_SEGMENTS:
                self.fold()
        except VersionConflict:
            pass

    def compact(self) -> None:
        """Rewrite everything as one segment without removals."""
        state = self.state()
        if state["segments"]:
            name = self._write_segment(self._stored(state), state)
            self._replace(state, state["segments"], [self._entry(state, name, state["seq"])], {}, state["seq"])

    def fold(self) -> None:
        """Merge the small segments and the removal files; large segments stay as they are.

        A segment that outweighs all smaller ones together is not touched, so
        that a row is rewritten a logarithmic number of times.
        """
        state = self.state()
        small = sorted(state["segments"], key=lambda s: -s["n"])
        while len(small) > 1 and small[0]["n"] > sum(s["n"] for s in small[1:]):
            small.pop(0)
        new, old = [], []
        if len(small) > 1:
            name = self._write_segment(self._stored(state, small), state)
            new, old = [self._entry(state, name, max(s["seq"] for s in small))], small
        merged = None
        if len(state["removals"]) > 1:
            name = uuid.uuid4().hex
            folder = f"{state['folder']}/removals/seg={name}"
            self._removed(state, state["removals"]).groupBy("id").agg(F.max("until").alias("until")).write.parquet(folder)
            merged = {"name": name, "seq": max(r["seq"] for r in state["removals"]), "n": self._count(folder, "id string")}
        self._replace(state, old, new, {}, None, merged)

    def _entry(self, state: dict, name: str, seq: int) -> dict:
        extent = self._extent(f"{state['folder']}/items/seg={name}")
        return {"name": name, "seq": seq, "n": extent.n, "lo": extent.lo, "hi": extent.hi}

    def _replace(self, state: dict, old: list[dict], new: list[dict], changes: dict, settled: int | None,
                 merged: dict | None = None, convert=None) -> None:
        """Commit ``new`` in place of the ``old`` segments of ``state``.

        Segments that others appended meanwhile stay (run through ``convert``
        when given). Removals up to ``settled`` are done with; ``merged``
        stands for all removals of ``state``.
        """
        gone, known = {s["name"] for s in old}, {r["name"] for r in state["removals"]}
        converted: dict[str, dict] = {}
        for _ in range(COMMIT_TRIES):
            latest = self.state()
            if not gone <= {s["name"] for s in latest["segments"]} or latest["centroids"] != state["centroids"]:
                raise VersionConflict(self.name)
            kept = [s for s in latest["segments"] if s["name"] not in gone]
            if convert is not None:
                for s in kept:
                    if s["name"] not in converted:
                        converted[s["name"]] = convert(s)
                kept = [converted[s["name"]] for s in kept]
            removals = latest["removals"]
            if settled is not None:
                removals = [r for r in removals if r["seq"] > settled]
            elif merged is not None:
                removals = [merged] + [r for r in removals if r["name"] not in known]
            segments = sorted(new + kept, key=lambda s: s["seq"])
            try:
                self.catalog.commit(dict(latest, seq=latest["seq"] + 1, segments=segments, removals=removals, **changes))
                return
            except VersionConflict:
                continue
        raise VersionConflict(self.name)

    def vacuum(self, older_than_seconds: float = 7 * 24 * 3600) -> int:
        """Delete files that the newest version does not use; returns how many folders went.

        The age keeps readers of older versions and writers that have not
        committed yet; choose it longer than the longest job.
        """
        state = self.state()
        used = {s["name"] for s in state["segments"]} | {r["name"] for r in state["removals"]}
        gone = 0
        for kind in ("items", "removals"):
            for name, age in self.catalog.ages(f"{state['folder']}/{kind}"):
                if name.startswith("seg=") and name[4:] not in used and age >= older_than_seconds:
                    self.catalog.remove(f"{state['folder']}/{kind}/{name}")
                    gone += 1
        return gone

    # -- training ---------------------------------------------------------------

    def needs_training(self) -> bool:
        state = self.state()
        n = self.num_vectors().first()["num_vectors"]
        return train.needs_training(n, state["n_at_train"], state["retrain_multiplier"], state["min_train_rows"])

    def train(self, n_lists: int | None = None, batch_size: int = train.DEFAULT_BATCH_SIZE,
              max_iters: int = train.DEFAULT_MAX_ITERS, tolerance: float = train.DEFAULT_TOLERANCE,
              max_memory: int = 0, seed: int = 17, sample_rows: int | None = None,
              initial: DataFrame | None = None, initial_codes: DataFrame | None = None,
              calibration_rows: int = train.CALIBRATION_QUERIES, calibration: DataFrame | None = None,
              calibration_k: int = search.DEFAULT_TOP_K) -> None:
        """Fit the lists (and codebooks), move every row to its list, calibrate automatic probes.

        ``sample_rows`` bounds the rows that are fitted on; all of them by default.
        Many lists are fitted in two levels (see ``train_lists``).
        ``initial`` (list_id, centroid) is where the fit of the lists starts, and
        ``initial_codes`` (sub, code, centroid) that of the codes. The queries
        ``calibration`` (query_id, qv), or so many stored rows as ``calibration_rows``
        says, decide how many lists automatic probes read for ``calibration_k`` hits.
        """
        state = self.state()
        rows = self._stored(state)
        n = rows.count()
        if n == 0:
            raise ValueError("cannot train an empty collection")
        metric = state["metric"]
        centroids = train.train_lists(rows, metric, n, n_lists, max_iters, tolerance, max_memory, seed, sample_rows, state["dimension"],
                                      None if initial is None else train.centroid_array(initial), train.FLAT_LISTS)
        generation = uuid.uuid4().hex
        self._write_centroids(state, generation, centroids)
        books = None
        if state["index_type"] == "ivfpq":
            books = pq.train_codebooks(rows, metric, n, state["dimension"], state["pq_dim"], state["pq_bits"],
                                       max_iters, tolerance, seed, sample_rows,
                                       None if initial_codes is None else pq.codebook_array(initial_codes))
            errors = pq.codebook_errors(rows, books, metric)      # kept beside the codes
            pq.codebook_frame(self.spark, books).join(errors, ["sub", "code"], "left").fillna(0, ["n", "error"]) \
                .write.parquet(f"{state['folder']}/codebooks/{generation}")
        changes = {
            "is_trained": True, "n_at_train": n, "n_lists": len(centroids), "density": len(centroids) / n ** 0.5, "centroids": generation,
            "codebooks": generation if books is not None else None,
            "training": f"batch_size={batch_size} max_iters={max_iters} tolerance={tolerance} max_memory={max_memory} "
                        f"calibration_rows={calibration_rows if calibration is None else calibration.count()} "
                        f"calibration={'stored' if calibration is None else 'given'} calibration_k={calibration_k}"}
        trained = dict(state, **changes)

        def listed(source: DataFrame, seq: int) -> dict:
            moved = train.assign_lists(source, centroids, metric)
            if books is not None:
                moved = pq.pq_encode(moved, books, metric)
            return self._entry(state, self._write_segment(moved, trained), seq)

        def convert(segment: dict) -> dict:
            """A segment appended during training: its rows, as written, in the new lists."""
            return listed(self._stored(dict(state, removals=[]), [segment]), segment["seq"])

        base = listed(rows, state["seq"])
        known = dict(trained, segments=[base], removals=[])
        moved = self._stored(known)
        asked = train.calibration_queries(moved, n, seed, calibration_rows) if calibration is None else calibration.select("query_id", "qv")
        changes |= self._calibrated(state, generation, moved, asked, centroids, calibration_k)
        self._replace(state, state["segments"], [base], changes, state["seq"], convert=convert)

    def split_lists(self, factor: float = SPLIT_FACTOR) -> int:
        """Split the lists with more than ``factor`` times their share of the rows; how many lists are new.

        Only rows of these lists are written anew, as a segment of their own. All
        other files stay; older segments just leave out the split lists, until
        they are folded. Rows of other lists are not moved. Nothing is split
        when the centroids would outgrow their bound. The commit fails with
        VersionConflict when others wrote meanwhile.
        """
        state = self.state()
        if not state["is_trained"]:
            raise ValueError("only a trained collection has lists to split")
        centroids, metric = self._centroids(state), state["metric"]
        stored = self._stored(state)
        sizes = train.size_array(stored, len(centroids))
        n = stored.count()
        density = state["density"] or len(centroids) / max(state["n_at_train"], 1) ** 0.5
        parts = train.grown_lists(sizes, density, factor)
        if (len(centroids) + sum(parts.values())) * centroids.shape[1] * 8 > train.MAX_CENTROID_BYTES:
            parts = {}
        rows = stored.where(F.col("list_id").isin(list(parts)))
        new = train.split_grown(rows, centroids, metric, parts) if parts else centroids
        if len(new) == len(centroids):
            self.catalog.commit(dict(state, n_at_train=n))
            return 0
        split = [x for x in parts if (new[x] != centroids[x]).any()]      # copies of one row stay together
        rows = stored.where(F.col("list_id").isin(split))
        generation = uuid.uuid4().hex
        self._write_centroids(state, generation, new)
        changes = {"n_at_train": n, "n_lists": len(new), "centroids": generation, "seq": state["seq"] + 1}
        name = self._write_segment(train.assign_lists(rows, new, metric), state)
        try:
            kept = [dict(s, gone=sorted({*(s.get("gone") or ()), *split})) for s in state["segments"]]
            changes["segments"] = kept + [self._entry(state, name, changes["seq"])]
            moved = self._stored(dict(state, **changes))
            changes |= self._calibrated(state, generation, moved, train.calibration_queries(moved, n), new, search.DEFAULT_TOP_K)
            self.catalog.commit(dict(state, **changes))
        except Exception:
            self.catalog.remove(f"{state['folder']}/items/seg={name}")
            raise
        return len(new) - len(centroids)

    def _calibrated(self, state, generation, moved, asked, centroids, k) -> dict:
        """Probe count and reach that the queries ``asked`` need for ``k`` hits; the radii of the lists are kept."""
        metric = state["metric"]
        truth = written(train.stored_neighbours(moved, asked, metric, k), "neighbours")
        radii = train.list_radii(moved, centroids, metric)
        self.spark.createDataFrame(list(enumerate(radii.tolist())), "list_id int, radius double") \
            .write.parquet(f"{state['folder']}/radii/{generation}")
        return {"n_probes": train.auto_probe_count(train.calibrate_probes(moved, asked, centroids, metric, truth=truth)),
                "reach": train.auto_reach(train.calibrate_reach(moved, asked, centroids, radii, metric, truth=truth))}

    def _write_centroids(self, state: dict, generation: str, centroids) -> None:
        lists = self.spark.createDataFrame(
            [(i, row.tolist()) for i, row in enumerate(centroids)], "list_id int, centroid array<double>")
        lists.write.parquet(f"{state['folder']}/centroids/{generation}")

    def _centroids(self, state: dict):
        return train.centroid_array(self.spark.read.parquet(f"{state['folder']}/centroids/{state['centroids']}"))

    def _radii(self, state: dict):
        rows = self.spark.read.schema("list_id int, radius double").parquet(f"{state['folder']}/radii/{state['centroids']}")
        return rows.orderBy("list_id").select("radius").toArrow().column("radius").to_numpy()      # as many as centroids

    def codebook_errors(self) -> DataFrame:
        """``(sub, n, error)`` of the trained codes: rows fitted and their summed squared error in each sub-space."""
        state = self.state()
        codes = self.spark.read.parquet(f"{state['folder']}/codebooks/{state['codebooks']}")
        return codes.groupBy("sub").agg(F.sum("n").alias("n"), F.sum("error").alias("error"))

    def _codebooks(self, state: dict):
        return pq.codebook_array(self.spark.read.parquet(f"{state['folder']}/codebooks/{state['codebooks']}"))

    # -- search -------------------------------------------------------------------

    def query(
        self,
        queries=None,
        contents=None,
        top_k: int = search.DEFAULT_TOP_K,
        n_probes: int | None = None,
        filters: dict | None = None,
        include=DEFAULT_INCLUDE,
        greedy: bool = False,
    ) -> DataFrame:
        """Nearest items of each query: ``(query_id, rank, id, *include)``.

        ``queries`` is a frame ``(query_id, qv)``, one vector or a list of
        vectors; or ``contents`` is a text, or a frame ``(query_id, text)``.
        Without training every item is compared. After it, ``n_probes`` lists
        hold the candidates. By default each query probes the lists within the
        reach that calibration found; with filters, whose hits lie further off,
        as many lists as it found to be enough for most.
        """
        state = self.state()
        frame = self._query_frame(state, queries, contents)
        stored = self._stored(state)
        rows = self._filtered(stored, state, filters)
        scan, rerank = None, None
        if state["is_trained"]:
            frame, scan, rerank = self._plan_probes(state, frame, rows, top_k, n_probes, greedy, not filters)
        include = [c for c in ("distance", "metadata", "vector", "contents") if c in include]
        include += ["is_text"] if "contents" in include else []
        payload = tuple(c for c in include if c != "distance")
        if not payload and not rerank:
            return search.only_included(search.search(frame, rows, top_k, state["metric"], (), scan, stored), include)
        if "probes" in frame.columns:
            frame = written(frame, "queries")      # probes are asked for more than once
        # written, so that the search runs once; vectors and payload are fetched for the hits alone, in one read
        hits = written(search.search(frame, rows, top_k * (rerank or 1), state["metric"], (), scan, stored), "hits")
        lists = search.probed_lists(frame)
        if not rerank:
            return search.only_included(self.payload(hits, payload, lists), include)
        found = pq.exact_hits(hits, frame, self._near(state, hits, lists), top_k, state["metric"], payload)
        return search.only_included(self._open(found, state), include)

    def _plan_probes(self, state, frame, rows, top_k, n_probes, greedy, everything=True):
        n_lists, metric = state["n_lists"], state["metric"]
        probes = n_probes if n_probes is not None else state["n_probes"]
        if probes < 1:
            raise ValueError("n_probes must be at least 1")
        scan, rerank = None, None
        if state["index_type"] == "ivfpq":
            scan, rerank = pq.scan_codes(self._codebooks(state)), None if greedy else pq.DEFAULT_RERANK
        if greedy and n_probes is None:
            centroids = self._centroids(state)
            sizes = train.greedy_sizes(frame, centroids, metric, rows, top_k)      # of the rows that may be hits
            frame = search.probe_lists(frame, centroids, metric, sizes=sizes, k=top_k)
        elif n_probes is None and everything and state["reach"] is not None:
            frame = search.probe_lists(frame, self._centroids(state), metric, radii=self._radii(state), reach=state["reach"])
        elif probes < n_lists:
            frame = search.probe_lists(frame, self._centroids(state), metric, probes)
        return frame, scan, rerank

    def _query_frame(self, state, queries, contents) -> DataFrame:
        if queries is None and contents is None:
            raise ValueError("queries or contents are needed")
        if queries is None:
            if self.embedder is None:
                raise ValueError("this collection handle has no embedder for contents")
            if isinstance(contents, str):
                contents = self.spark.createDataFrame([(0, contents)], "query_id long, text string")
            return contents.select("query_id", self.embedder(F.col("text")).alias("qv"))
        if isinstance(queries, DataFrame):
            kind = queries.schema["qv"].dataType.simpleString()
            # single precision stays: half as many bytes to move, and the same distances
            return queries.select("query_id", F.col("qv").cast(kind if kind == "array<float>" else "array<double>").alias("qv"))
        many = [queries] if queries and not isinstance(queries[0], (list, tuple)) else list(queries)
        if not many or any(len(q) == 0 for q in many):
            raise ValueError("query vectors cannot be empty")
        wrong = [len(q) for q in many if state["dimension"] and len(q) != state["dimension"]]
        if wrong:
            raise ValueError(f"query dimension {wrong[0]} differs from the collection's {state['dimension']}")
        return self.spark.createDataFrame(
            [(i, [float(x) for x in q]) for i, q in enumerate(many)], "query_id long, qv array<double>")


def _lookup(column: str, entries: list[dict]) -> Column:
    """Segment name to sequence number, as a literal map of at most MAX_SEGMENTS entries."""
    pairs = [F.lit(x) for e in entries for x in (e["name"], e["seq"])]
    return F.element_at(F.create_map(*pairs), F.col(column)).cast("long")
