"""Sink options: one set of names, defaults and checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

# Option names.
DATABASE = "database"
COLLECTION = "collection"
TRANSACTION_ENABLE = "sink.transaction.enable"
FLUSH_ON_CHECKPOINT = "sink.flush.on-checkpoint"
FLUSH_SIZE = "sink.flush.size"
FLUSH_INTERVAL = "sink.flush.interval"
MAX_IN_FLIGHT = "sink.max.in-flight.flushes"
# Connection settings of a database server. Accepted, so that existing table
# definitions keep working, and unused: a collection is a directory here.
NETWORK = ("host", "port", "user", "password", "use-ssl")


@dataclass(frozen=True)
class SinkOptions:
    """What a sink needs to know about its target and its bulks.

    ``key`` is the primary key column (or columns, see ``key_policy``);
    ``seq_chunk`` is explained in ``roll_bulks``, ``max_log`` and
    ``compact_ratio`` in ``Collection.tidy``, ``buckets``, ``keep_versions`` and
    ``keep_seconds`` in ``Collection``.
    ``arrival`` names a column with the time at which a change arrived, for
    bulks cut by time; without it the time of its micro-batch counts.
    ``report`` keeps what became of changes: totals in the manifest, and the
    keys with refused changes. ``reject`` says what happens to rows that cannot
    be changes (no key, an unknown kind, no place): ``"fail"`` the job, or put
    them ``"aside"``.
    ``mode`` is ``"bulk"`` for exact bulk semantics or ``"lww"`` for last write
    wins, which gives the same result on a well-formed changelog.
    """

    database: str
    collection: str
    key: str | Sequence[str]
    flush_size: int = 1000
    flush_interval_ms: int = 3000
    flush_on_checkpoint: bool = False
    transaction_enable: bool = False
    max_in_flight_flushes: int = 5
    key_policy: str = "single"
    mode: str = "bulk"
    writers: int = 1
    max_log: int = 20
    compact_ratio: float = 0.25
    seq_chunk: int | None = None
    arrival: str | None = None
    report: bool = False
    reject: str = "fail"
    buckets: int | None = None
    keep_versions: int = 100
    keep_seconds: int = 3600

    def __post_init__(self) -> None:
        if not self.database or not self.collection:
            raise ValueError("database and collection must be set")
        if not self.key:
            raise ValueError("a primary key is required")
        if self.transaction_enable and not self.flush_on_checkpoint:
            raise ValueError(f"`{TRANSACTION_ENABLE}` needs `{FLUSH_ON_CHECKPOINT}`")
        if self.flush_size <= 0:
            raise ValueError(f"`{FLUSH_SIZE}` is {self.flush_size}, at least 1 is needed")
        if self.max_in_flight_flushes <= 0:
            raise ValueError(f"`{MAX_IN_FLIGHT}` is {self.max_in_flight_flushes}, at least 1 is needed")
        if self.mode not in ("bulk", "lww"):
            raise ValueError(f"unknown mode {self.mode!r}")
        if self.reject not in ("fail", "aside"):
            raise ValueError(f"unknown way to reject {self.reject!r}")
        if self.report and self.mode != "bulk":
            raise ValueError("only bulks tell what became of a change")
        if self.writers < 1 or self.max_log < 1:
            raise ValueError("writers and max_log must be at least 1")

    @classmethod
    def from_table(cls, options: Mapping[str, object], key: str | Sequence[str], **more: object) -> SinkOptions:
        """Options of a table definition; unknown names are refused."""
        for name in (DATABASE, COLLECTION):
            if not options.get(name):
                raise ValueError(f"missing required option `{name}`")
        known = {DATABASE, COLLECTION, *_SINK_OPTIONS, *NETWORK}
        unknown = sorted(set(options) - known)
        if unknown:
            raise ValueError(f"unsupported options: {', '.join(unknown)}")
        return cls(
            database=str(options[DATABASE]),
            collection=str(options[COLLECTION]),
            key=key,
            **_parsed(options),
            **more,
        )

    @classmethod
    def from_properties(
        cls,
        database: str,
        collection: str,
        key: str | Sequence[str],
        properties: Mapping[str, object],
        **more: object,
    ) -> SinkOptions:
        """Separate arguments and loose properties: the older form, with its own defaults."""
        values = {"flush_size": 100, "flush_interval_ms": 1000, **_parsed(properties), **more}
        return cls(database=database, collection=collection, key=key, **values)

    @property
    def carries_bulks(self) -> bool:
        """Whether a bulk that is not full at the end of a micro-batch stays open."""
        return self.mode == "bulk" and not self.flush_on_checkpoint

    @property
    def trigger(self) -> dict[str, str]:
        """Structured Streaming trigger that matches the flush interval (R2)."""
        if self.flush_on_checkpoint or self.flush_interval_ms <= 0:
            return {}
        return {"processingTime": f"{self.flush_interval_ms} milliseconds"}

    def source_limits(self, source_format: str) -> dict[str, str]:
        """Reader options that bound a micro-batch, in place of a blocking queue."""
        if source_format == "kafka":
            return {"maxOffsetsPerTrigger": str(self.flush_size * self.max_in_flight_flushes)}
        return {"maxFilesPerTrigger": str(self.max_in_flight_flushes)}


def _flag(value: object) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text not in ("true", "false"):
        raise ValueError(f"not a boolean: {value!r}")
    return text == "true"


_SINK_OPTIONS = {
    TRANSACTION_ENABLE: ("transaction_enable", _flag),
    FLUSH_ON_CHECKPOINT: ("flush_on_checkpoint", _flag),
    FLUSH_SIZE: ("flush_size", int),
    FLUSH_INTERVAL: ("flush_interval_ms", int),
    MAX_IN_FLIGHT: ("max_in_flight_flushes", int),
}


def _parsed(options: Mapping[str, object]) -> dict[str, object]:
    return {field: parse(options[name]) for name, (field, parse) in _SINK_OPTIONS.items() if name in options}
