"""A document collection as a directory of Parquet data.

The layout follows merge-on-read: ``base/`` holds whole documents, ``log/`` one
effect per key and batch. Applying a batch only writes its own effects, however
large the collection is; reading folds the log over the base. ``tidy`` keeps the
log short: recent entries are folded into one, and only when the log has grown
to a good share of the base are both rewritten. A version is a small manifest
file; a batch counts as applied when its manifest exists.

The base lies in files of disjoint key ranges, sorted by key; ``index/`` holds
the first and the last key of each. Reading some keys or a range of them looks
up the files when the plan is built, and the scans get the condition, too, so
that they skip row groups. Log entries are sorted inside their files and know
their first and last key.

Several jobs may write to a collection at a time. Each writes its data into
folders of its own; what decides is who creates the next manifest first, which
only one can. The other reads the new version and tries again on top of it. That
is right without looking at keys, as effects say what a batch does to any
collection: the order of versions is the order of the batches. Folding a log and
compacting it replace the entries they have read, and later ones stay; if
another job was faster, its work counts and theirs is dropped.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field, replace
from functools import reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink.functions.names import literal, quote
from docsink.operators.applying import apply_effect_runs, apply_effects
from docsink.operators.effects import EFFECT_COLUMNS, fold_effects
from docsink.operators.outcomes import OUTCOME_COLUMNS, REFUSED

# Rows and bytes that Spark lets a broadcast have at most.
BROADCAST_ROWS = 100_000_000
ROW_BYTES = 64  # of a row in memory besides its values

# A log this many times longer than wanted is compacted, whatever its size.
MIXED_LOG = 4


@dataclass(frozen=True)
class LogEntry:
    """Effects of one batch; ``rows``, ``memory`` and the first and last key were taken when it was written."""

    version: int
    doc_schema: str
    effect_schema: str
    size: int
    rows: int | None = None
    memory: int | None = None
    low: str | None = None
    high: str | None = None
    part: str | None = None  # folder inside that of the version

    @property
    def schemas(self) -> tuple[str, str]:
        return self.doc_schema, self.effect_schema


@dataclass(frozen=True)
class KeyRange:
    """Some keys, or all between two (both included); nothing given means all documents."""

    keys: tuple[str, ...] | None = None
    low: str | None = None
    high: str | None = None

    @property
    def condition(self) -> Column | None:
        found = [] if self.keys is None else [F.col("_key").isin(*self.keys)]
        found += [] if self.low is None else [F.col("_key") >= self.low]
        found += [] if self.high is None else [F.col("_key") <= self.high]
        return reduce(Column.__and__, found) if found else None

    def meets(self, low: str, high: str) -> Column:
        """Condition on rows with a first and last key: whether any wanted key can lie between."""
        first, last = F.col(low), F.col(high)
        found = [] if self.low is None else [last >= self.low]
        found += [] if self.high is None else [first <= self.high]
        if self.keys is not None:
            within = [(first <= key) & (last >= key) for key in self.keys]
            found.append(reduce(Column.__or__, within, F.lit(False)))
        return reduce(Column.__and__, found, F.lit(True))

    def may_meet(self, entry: LogEntry) -> bool:
        if entry.low is None:
            return True
        # Bytes of UTF-8 are ordered as Spark orders strings.
        low, high = entry.low.encode(), entry.high.encode()
        if self.keys is not None and not any(low <= key.encode() <= high for key in self.keys):
            return False
        return (self.low is None or self.low.encode() <= high) and (self.high is None or low <= self.high.encode())


@dataclass(frozen=True)
class OpenBulks:
    """Changes of a source whose bulks are not full yet; ``tick`` is the last timer tick it has seen."""

    tick: int
    version: str | None = None
    schema: str | None = None


@dataclass(frozen=True)
class Manifest:
    """State of a collection: the base, the log since, and the last batch and the open bulks of each source."""

    version: int = 0
    base_version: int | str | None = None
    base_schema: str | None = None
    base_size: int = 0
    base_buckets: int | None = None
    base_indexed: bool = False
    log: list[LogEntry] = field(default_factory=list)
    batches: dict[str, int] = field(default_factory=dict)
    open: dict[str, OpenBulks] = field(default_factory=dict)
    outcomes: dict[str, int] = field(default_factory=dict)


_OF_BASE = ("base_version", "base_schema", "base_size", "base_buckets", "base_indexed")


class Collection:
    """Documents under ``path``.

    With ``buckets`` the base is kept as Spark bucketed files by ``_key``: a log
    of any size is then joined to it without shuffling the base. Choose about
    one bucket per gigabyte; a compaction applies a changed number.

    ``tidy`` forgets versions beyond the last ``keep_versions`` once they are
    ``keep_seconds`` old, so that readers that began before can finish.
    ``broadcast_limit`` bounds a broadcast log, in bytes; None is Spark's own bound.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        buckets: int | None = None,
        *,
        keep_versions: int = 100,
        keep_seconds: int = 3600,
        broadcast_limit: int | None = None,
    ) -> None:
        if buckets is not None and buckets < 1:
            raise ValueError("buckets must be at least 1")
        self.spark = spark
        self.path = path.rstrip("/")
        if keep_versions < 1:
            raise ValueError("keep_versions must be at least 1")
        self.buckets = buckets
        self.keep_versions = keep_versions
        self.keep_seconds = keep_seconds
        self.broadcast_limit = broadcast_limit
        self._files = _Files(spark)

    def manifest(self) -> Manifest | None:
        """The latest version, or None when the collection does not exist yet."""
        numbers = self._version_numbers()
        if not numbers:
            return None
        raw = json.loads(self._files.read(self._manifest_path(max(numbers))))
        opened = {source: OpenBulks(**o) for source, o in raw.get("open", {}).items()}
        return Manifest(**{**raw, "log": [LogEntry(**e) for e in raw["log"]], "open": opened})

    def exists(self) -> bool:
        return self.manifest() is not None

    def create(self, documents: DataFrame | None = None) -> None:
        """Create the collection if it is missing, empty or with first documents."""
        if self.exists():
            return
        try:
            self._commit(Manifest() if documents is None else self._with_base(Manifest(), documents))
        except FileExistsError:
            # Another job created it meanwhile.
            if documents is not None:
                raise

    def read(
        self, *, keys: Sequence[str] | None = None, low: str | None = None, high: str | None = None
    ) -> DataFrame:
        """Documents, ``_key`` and the attributes: all, those of some ``keys``, or those from ``low`` to ``high``.

        The files that can hold them are looked up now; the others are not read.
        """
        manifest = self.manifest()
        if manifest is None:
            raise FileNotFoundError(f"no collection at {self.path}")
        wanted = KeyRange(None if keys is None else tuple(dict.fromkeys(keys)), low, high)
        return self._read(manifest, wanted)

    def applied(self, source: str, batch_id: int) -> bool:
        """Whether a batch of a source is already part of the collection."""
        manifest = self.manifest()
        return manifest is not None and manifest.batches.get(source, -1) >= batch_id

    def append(
        self,
        effects: DataFrame,
        doc_type: T.StructType,
        *,
        source: str | None = None,
        batch_id: int | None = None,
        opened: tuple[DataFrame | None, int] | None = None,
        outcomes: Callable[[], DataFrame] | None = None,
    ) -> bool:
        """Add the effects of one batch; False if that batch was applied before.

        A batch that failed halfway left no manifest and is written again from
        the start. ``opened`` is what the batch leaves in
        open bulks and its last timer tick; it replaces the source's open bulks
        in the same version that holds the effects. ``outcomes`` makes, for the
        collection as it is, what becomes of the changes per key (``resolve_outcomes``): totals are added up in
        the manifest, keys with refused changes are written beside the log.
        """
        def known(manifest: Manifest) -> bool:
            return source is not None and batch_id is not None and manifest.batches.get(source, -1) >= batch_id

        manifest = self.manifest() or Manifest()
        if known(manifest):
            return False
        entry = self._log_entry(manifest.version + 1, effects, doc_type.json())
        left = None if opened is None else self._open_entry(*opened)

        def added(manifest: Manifest) -> Manifest | None:
            if known(manifest):
                return None
            placed = self._placed(entry, manifest.version + 1)
            # A batch that only fills open bulks is no entry of the log.
            log = manifest.log if left is not None and entry.rows == 0 else [*manifest.log, placed]
            new = replace(manifest, version=placed.version, log=log)
            if source is not None and batch_id is not None:
                new = replace(new, batches={**manifest.batches, source: batch_id})
            if left is not None:
                new = replace(new, open={**manifest.open, source or "": left})
            if outcomes is not None:
                counts = self._write_outcomes(placed, outcomes())
                new = replace(new, outcomes={n: manifest.outcomes.get(n, 0) + (c or 0) for n, c in counts.items()})
            return new

        return self._commit_change(added, lambda version: self._drop_outcomes(entry, version))

    def refused(self) -> DataFrame:
        """Keys with refused changes, ``commit, _key`` and the counts, of all batches that reported them."""
        schema = ", ".join(["commit long", "_key string", *[f"{name} long" for name in OUTCOME_COLUMNS], "present boolean"])
        manifest = self.manifest()
        commits = [] if manifest is None else self._files.names(f"{self.path}/outcomes")
        # A batch that failed after it wrote its outcomes left no version.
        done = [c for c in commits if "=" in c and int(c.split("=")[1]) <= manifest.version]
        if not done:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.path}/outcomes/{c}/{part}" for c in done for part in self._files.names(f"{self.path}/outcomes/{c}")]
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/outcomes").parquet(*paths)

    def _write_outcomes(self, entry: LogEntry, outcomes: DataFrame) -> dict[str, int]:
        seen = Observation()
        sums = [F.sum(name).alias(name) for name in OUTCOME_COLUMNS]
        kept = outcomes.observe(seen, *sums).where(" + ".join(REFUSED) + " > 0")
        kept.write.mode("overwrite").parquet(self._outcome_path(entry, entry.version))
        return seen.get

    def _drop_outcomes(self, entry: LogEntry, version: int) -> None:
        self._files.delete(self._outcome_path(entry, version))

    def forget(self, sources: Sequence[str]) -> None:
        """Drop sources that will not deliver again, so that manifests stay small."""
        def without(manifest: Manifest) -> Manifest | None:
            left = {s: b for s, b in manifest.batches.items() if s not in set(sources)}
            if len(left) == len(manifest.batches):
                return None
            return replace(manifest, version=manifest.version + 1, batches=left)

        if self.exists():
            self._commit_change(without)

    def opened(self, source: str | None) -> tuple[DataFrame | None, int | None]:
        """Changes in the open bulks of a source, if any, and its last timer tick."""
        manifest = self.manifest()
        found = None if manifest is None else manifest.open.get(source or "")
        if found is None:
            return None, None
        if found.version is None:
            return None, found.tick
        schema = T.StructType.fromJson(json.loads(found.schema))
        return self.spark.read.schema(schema).parquet(self._open_path(found.version)), found.tick

    def sources_with_open_bulks(self) -> list[str]:
        manifest = self.manifest()
        return [] if manifest is None else [s for s, o in manifest.open.items() if o.version is not None]

    def tidy(self, max_log: int, ratio: float) -> None:
        """Shorten a log of ``max_log`` entries or more.

        The base is rewritten only when the log holds ``ratio`` of its size;
        until then recent entries are folded together, an older one joining in
        when it is not much larger than those after it. So an entry takes part
        in few foldings, and the cost of a batch does not grow with the base.
        Entries of different document types cannot be folded together; a log
        that stays long because of them is compacted after all.
        """
        self._shorten(max_log, ratio)
        # Some slack, so that old versions go several at a time.
        if len(self._version_numbers()) > self.keep_versions + self.keep_versions // 4:
            self.vacuum(self.keep_versions, self.keep_seconds)

    def _shorten(self, max_log: int, ratio: float) -> None:
        manifest = self.manifest()
        if manifest is None or len(manifest.log) < max_log:
            return
        sizes = [entry.size for entry in manifest.log]
        if sum(sizes) >= ratio * manifest.base_size or len(sizes) >= MIXED_LOG * max_log:
            self.compact()
            return
        start = max(len(sizes) - max(2, max_log // 2), 0)
        while start > 0 and sizes[start - 1] <= 2 * sum(sizes[start:]):
            start -= 1
        # One entry has one document type.
        while start < len(sizes) and any(e.schemas != manifest.log[-1].schemas for e in manifest.log[start:]):
            start += 1
        self.fold_log(len(sizes) - start)

    def fold_log(self, entries: int) -> None:
        """Fold the last ``entries`` of the log, all of one type, into one."""
        manifest = self.manifest()
        if manifest is None or entries < 2:
            return
        recent = manifest.log[-entries:]
        if any(e.schemas != recent[-1].schemas for e in recent):
            raise ValueError("log entries of different document types cannot be folded")
        # It stands where the last of them stood, before entries that come meanwhile.
        entry = self._log_entry(recent[-1].version, self._log_effects(recent), recent[-1].doc_schema)

        def folded(current: Manifest) -> Manifest | None:
            start = len(manifest.log) - entries
            if current.log[start : start + entries] != recent:
                return None
            log = [*current.log[:start], entry, *current.log[start + entries :]]
            return replace(current, version=current.version + 1, log=log)

        self._commit_change(folded)

    def compact(self) -> None:
        """Store the folded documents as the new base."""
        manifest = self.manifest()
        if manifest is None or not manifest.log:
            return
        based = self._with_base(manifest, self._read(manifest), f"{manifest.version + 1}-{uuid.uuid4().hex}")

        def compacted(current: Manifest) -> Manifest | None:
            taken = len(manifest.log)
            if current.base_version != manifest.base_version or current.log[:taken] != manifest.log:
                return None
            of_base = {name: getattr(based, name) for name in _OF_BASE}
            return replace(current, version=current.version + 1, log=current.log[taken:], **of_base)

        self._commit_change(compacted)

    def vacuum(self, keep: int = 2, seconds: int = 0) -> None:
        """Delete versions before the last ``keep`` that are ``seconds`` old, and data no other version uses."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        numbers = sorted(self._version_numbers())
        before = time.time() - seconds
        gone = [n for n in numbers[:-keep] if self._files.modified(self._manifest_path(n)) <= before]
        kept = [json.loads(self._files.read(self._manifest_path(n))) for n in numbers if n not in set(gone)]
        used = {f"version={m['base_version']}" for m in kept}
        used_log = {f"commit={e['version']}" for m in kept for e in m["log"]}
        used_open = {f"version={o['version']}" for m in kept for o in m.get("open", {}).values()}
        for number in gone:
            self._files.delete(self._manifest_path(number))
        for folder, names in (("base", used), ("index", used), ("log", used_log), ("open", used_open)):
            for name in self._files.names(f"{self.path}/{folder}"):
                data = f"{self.path}/{folder}/{name}"
                # What is young may belong to a job that has not committed yet.
                if "=" in name and name not in names and self._files.modified(data) <= before:
                    self._files.delete(data)

    def _read(self, manifest: Manifest, wanted: KeyRange = KeyRange()) -> DataFrame:
        documents = None
        if manifest.base_version is not None:
            documents = self._base(manifest, wanted)
        # Batches with the same document type are folded together; the folded runs
        # of different types meet the base in one join.
        log = [entry for entry in manifest.log if wanted.may_meet(entry)]
        small = self._broadcastable(log)
        buckets = None if small else manifest.base_buckets
        runs = []
        for (doc_schema, _), entries in groupby(manifest.log, key=lambda e: e.schemas):
            # Attributes count even where no document is wanted.
            entries = list(entries)
            met = [entry for entry in entries if entry in log] or entries[:1]
            effects = self._log_effects(met, buckets, wanted)
            runs.append((effects, T.StructType.fromJson(json.loads(doc_schema))))
        if documents is None and runs:
            documents, runs = apply_effects(None, *runs[0]), runs[1:]
        if runs:
            documents = apply_effect_runs(documents, runs, small_effects=small, buckets=buckets)
        if documents is None:
            return self.spark.createDataFrame([], "_key string")
        return documents

    def _base(self, manifest: Manifest, wanted: KeyRange = KeyRange()) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(manifest.base_schema))
        path = self._base_path(manifest.base_version)
        if wanted.condition is not None:
            paths = self._files_with(manifest, wanted) if manifest.base_indexed else [path]
            if not paths:
                return self.spark.createDataFrame([], schema)
            if manifest.base_buckets is None:
                return self.spark.read.schema(schema).parquet(*paths).where(wanted.condition)
            return self._bucketed(path, schema, manifest.base_buckets).where(wanted.condition)
        if manifest.base_buckets is None:
            return self.spark.read.schema(schema).parquet(path)
        return self._bucketed(path, schema, manifest.base_buckets)

    def _files_with(self, manifest: Manifest, wanted: KeyRange) -> list[str]:
        """Files of the base that can hold a wanted key."""
        index = self.spark.read.parquet(self._index_path(manifest.base_version))
        names = index.where(wanted.meets("low", "high")).select("file").collect()
        return [f"{self._base_path(manifest.base_version)}/{row.file}" for row in names]

    def _write_index(self, version: int | str) -> None:
        """First and last key of each file, from the column of keys alone."""
        rows = self.spark.read.schema("_key string").parquet(self._base_path(version))
        ranges = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(
            F.min("_key").alias("low"), F.max("_key").alias("high"), F.count(F.lit(1)).alias("rows")
        )
        ranges.write.mode("overwrite").parquet(self._index_path(version))

    def _bucketed(self, path: str, schema: T.StructType, buckets: int) -> DataFrame:
        # Only a table can tell Spark about buckets. It is an external one and
        # needed just long enough to be resolved.
        name = f"docsink_{uuid.uuid4().hex}"
        self.spark.sql(
            f"create table {name} ({schema.toDDL()}) using parquet "
            f"clustered by (_key) into {buckets} buckets location {literal(path)}"
        )
        try:
            documents = self.spark.table(name)
            documents.schema  # noqa: B018  resolves the table
            return documents
        finally:
            self.spark.sql(f"drop table {name}")

    def _log_effects(
        self, run: list[LogEntry], buckets: int | None = None, wanted: KeyRange = KeyRange()
    ) -> DataFrame:
        """One effect per key for consecutive entries of one type, placed like the base if it has buckets."""
        schema = T.StructType.fromJson(json.loads(run[0].effect_schema)).add("commit", "long")
        paths = [self._log_path(e.version, e.part) for e in run]
        effects = self.spark.read.schema(schema).option("basePath", f"{self.path}/log").parquet(*paths)
        if wanted.condition is not None:
            effects = effects.where(wanted.condition)
        if buckets is not None:
            effects = effects.repartition(buckets, "_key")
        if len(run) > 1:
            effects = fold_effects(effects, ("_key",), "commit", T.StructType.fromJson(json.loads(run[0].doc_schema)))
        return effects.select("_key", *EFFECT_COLUMNS)

    def _log_entry(self, version: int, effects: DataFrame, doc_schema: str) -> LogEntry:
        part = uuid.uuid4().hex
        path = self._log_path(version, part)
        seen = Observation()
        count, memory = F.count(F.lit(1)).alias("rows"), F.sum(bytes_in_memory(effects)).alias("memory")
        low, high = F.min("_key").alias("low"), F.max("_key").alias("high")
        effects.observe(seen, count, memory, low, high).sortWithinPartitions("_key").write.mode("overwrite").parquet(path)
        return LogEntry(
            version,
            doc_schema,
            effects.schema.json(),
            self._files.size(path),
            seen.get["rows"],
            seen.get["memory"] or 0,
            seen.get["low"],
            seen.get["high"],
            part,
        )

    def _placed(self, entry: LogEntry, version: int) -> LogEntry:
        """The entry in the folder of ``version``, by which entries are ordered."""
        target = self._log_path(version, entry.part)
        for held in (entry.version, *range(entry.version + 1, version)):
            # An attempt that lost may have moved it already.
            if held != version and self._files.exists(self._log_path(held, entry.part)):
                self._files.move(self._log_path(held, entry.part), target)
        return replace(entry, version=version)

    def _open_entry(self, rows: DataFrame | None, tick: int) -> OpenBulks:
        if rows is None:
            return OpenBulks(tick)
        seen, version = Observation(), uuid.uuid4().hex
        path = self._open_path(version)
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        return OpenBulks(tick, version, rows.schema.json()) if seen.get["rows"] else OpenBulks(tick)

    def _with_base(self, manifest: Manifest, documents: DataFrame, folder: str | None = None) -> Manifest:
        version = folder or manifest.version + 1
        path = self._base_path(version)
        if self.buckets is None:
            ranges = documents.repartitionByRange("_key").sortWithinPartitions("_key")
            ranges.write.mode("overwrite").parquet(path)
            self._write_index(version)
        else:
            self._write_buckets(documents, path, aligned=manifest.base_buckets == self.buckets)
        return replace(
            manifest,
            version=manifest.version + 1,
            base_version=version,
            base_schema=documents.schema.json(),
            base_size=self._files.size(path),
            base_buckets=self.buckets,
            base_indexed=self.buckets is None,
            log=[],
        )

    def _write_buckets(self, documents: DataFrame, path: str, aligned: bool) -> None:
        # Documents folded over a base of as many buckets already lie in them.
        if not aligned:
            documents = documents.repartition(self.buckets, "_key")
        name = f"docsink_{uuid.uuid4().hex}"
        self._files.delete(path)
        documents.write.bucketBy(self.buckets, "_key").option("path", path).saveAsTable(name, format="parquet")
        self.spark.sql(f"drop table {name}")

    def _broadcastable(self, run: list[LogEntry]) -> bool:
        """Whether what the rows take in memory, not on disk, is within Spark's own limit."""
        if any(e.rows is None for e in run):
            return False
        rows, memory = sum(e.rows for e in run), sum(e.memory for e in run)
        limit = self._files.broadcast_limit() if self.broadcast_limit is None else self.broadcast_limit
        return rows <= BROADCAST_ROWS and memory <= limit

    def _commit_change(
        self, change: Callable[[Manifest], Manifest | None], undo: Callable[[int], None] = lambda version: None
    ) -> bool:
        """Commit a change of the latest version, again if another job was faster; False if it is not wanted any more."""
        while True:
            new = change(self.manifest() or Manifest())
            if new is None:
                return False
            try:
                self._commit(new)
            except FileExistsError:
                undo(new.version)
            else:
                return True

    def _commit(self, manifest: Manifest) -> None:
        self._files.write(self._manifest_path(manifest.version), json.dumps(asdict(manifest)))

    def _version_numbers(self) -> list[int]:
        names = self._files.names(f"{self.path}/_versions")
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith(".")]

    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/_versions/{version:020d}.json"

    def _base_path(self, version: int | str) -> str:
        return f"{self.path}/base/version={version}"

    def _index_path(self, version: int | str) -> str:
        return f"{self.path}/index/version={version}"

    def _open_path(self, version: str) -> str:
        return f"{self.path}/open/version={version}"

    def _log_path(self, version: int, part: str | None) -> str:
        return f"{self.path}/log/commit={version}" + (f"/{part}" if part else "")

    def _outcome_path(self, entry: LogEntry, version: int) -> str:
        return f"{self.path}/outcomes/commit={version}/{entry.part}"


def bytes_in_memory(frame: DataFrame) -> Column:
    """About what a row takes in memory: its strings and nested values in full."""
    return sum((_bytes(F.col(quote(f.name)), f.dataType) for f in frame.schema.fields), F.lit(ROW_BYTES).cast("long"))


def _bytes(value: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        size = F.octet_length(value)
    elif isinstance(dtype, T.StructType):
        size = sum((_bytes(value.getField(f.name), f.dataType) for f in dtype.fields), F.lit(8))
    elif isinstance(dtype, T.ArrayType):
        zero = F.lit(16).cast("long")
        size = F.aggregate(value, zero, lambda total, x: total + _bytes(x, dtype.elementType))
    elif isinstance(dtype, T.MapType):
        keys = _bytes(F.map_keys(value), T.ArrayType(dtype.keyType))
        size = keys + _bytes(F.map_values(value), T.ArrayType(dtype.valueType))
    else:
        return F.lit(16).cast("long")
    return F.coalesce(size, F.lit(0)).cast("long") + 8


class _Files:
    """The few file operations a manifest needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _open(self, path: str):
        target = self._hadoop.fs.Path(path)
        return target.getFileSystem(self._conf), target

    def names(self, path: str) -> list[str]:
        fs, target = self._open(path)
        return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []

    def size(self, path: str) -> int:
        fs, target = self._open(path)
        return fs.getContentSummary(target).getLength()

    def modified(self, path: str) -> float:
        """Seconds since the epoch."""
        fs, target = self._open(path)
        return fs.getFileStatus(target).getModificationTime() / 1000

    def read(self, path: str) -> str:
        fs, target = self._open(path)
        stream = fs.open(target)
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Put a file where there is none: written aside, so that nobody sees half of it, then given its name.

        Renaming without leave to overwrite is atomic in HDFS; on a local disk a
        second link to the file is. Stores where neither holds need one writer.
        """
        fs, target = self._open(path)
        aside = self._hadoop.fs.Path(target.getParent(), f".{target.getName()}.{uuid.uuid4().hex}.tmp")
        stream = fs.create(aside, True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        taken = FileExistsError(f"{path} was written by another job")
        try:
            if fs.getScheme() == "file":
                os.link(self._local(aside), self._local(target))
            elif fs.exists(target) or not fs.rename(aside, target):
                raise taken
        except FileExistsError:
            raise taken from None
        finally:
            fs.delete(aside, False)

    def exists(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target)

    def move(self, path: str, target: str) -> None:
        fs, source = self._open(path)
        place = self._hadoop.fs.Path(target)
        fs.mkdirs(place.getParent())
        if not fs.rename(source, place):
            raise OSError(f"{path} could not be moved")

    @staticmethod
    def _local(path) -> str:
        return path.toUri().getPath()

    def delete(self, path: str) -> None:
        fs, target = self._open(path)
        fs.delete(target, True)

    def broadcast_limit(self) -> int:
        return self._spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
