"""What a pipeline is made of, and the checks made before any job starts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from millrace.operators.commits import LAST_SEEN, TRANSACTION
from millrace.operators.routing import Outbox


def parse_position(text: str | int | None) -> int | None:
    """A log position given as a number, decimal text, or ``high/low`` in hexadecimal."""
    if text is None or text == "":
        return None
    if isinstance(text, int):
        return text
    if "/" in text:
        high, low = text.split("/")
        return (int(high, 16) << 32) | int(low, 16)
    return int(text)


@dataclass(frozen=True)
class SourceSpec:
    type: str = "postgres"
    path: str = ""  # folder of the landed log; not needed when a DataFrame is handed over
    format: str = "parquet"
    tables: tuple[str, ...] = ()  # none means all
    start_lsn: str | int | None = None
    ts_mode: str = TRANSACTION
    # "any": every delivery of a change is an event; "first": only the first one, among this and the last
    # ``remember`` batches.
    deliveries: str = "any"
    remember: int = 100
    resume: bool = False  # a batch run goes on where the last one stopped


@dataclass(frozen=True)
class ModuleSpec:
    """A transform found by import path, ``package.module:name``."""

    path: str = ""


@dataclass(frozen=True)
class TransformSpec:
    """``modules`` wins over ``path``; entries are links themselves or ``ModuleSpec``."""

    enabled: bool = False
    type: str = "python"
    path: str = ""
    modules: tuple[Any, ...] = ()


@dataclass(frozen=True)
class SinkSpec:
    type: str = ""
    brokers: tuple[str, ...] = ()
    path: str = ""
    max_size: int = 0  # bytes before a new segment; 0 means no rotation
    max_files: int = 0  # rotated segments kept; 0 means all
    pretty_print: bool = False
    outbox: Outbox | None = None
    options: Mapping[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class MappingSpec:
    table_stream_map: Mapping[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class DlqSpec:
    enabled: bool = False
    sink: SinkSpec = field(default_factory=SinkSpec)


@dataclass(frozen=True)
class RetrySpec:
    max_attempts: int = 3
    backoff_ms: int = 100

    def __post_init__(self):
        if self.max_attempts <= 0:
            object.__setattr__(self, "max_attempts", 3)
        if self.backoff_ms <= 0:
            object.__setattr__(self, "backoff_ms", 100)


@dataclass(frozen=True)
class PipelineSpec:
    source: SourceSpec = field(default_factory=SourceSpec)
    sink: SinkSpec = field(default_factory=SinkSpec)
    transform: TransformSpec | None = None
    mapping: MappingSpec = field(default_factory=MappingSpec)
    dlq: DlqSpec | None = None
    retry: RetrySpec = field(default_factory=RetrySpec)
    work_dir: str = ""  # shared folder for state, ledger and offsets
    on_sink_failure: str = "dlq"  # or "fail": let the batch fail and be run again

    @classmethod
    def from_dict(cls, tree: Mapping[str, Any]) -> PipelineSpec:
        """From nested settings. Settings of servers, logging and database clients are ignored."""
        source, sink = dict(tree.get("source") or {}), dict(tree.get("sink") or {})
        for name in ("dsn", "slot_name", "publication", "ensure_publication"):
            source.pop(name, None)
        source["tables"] = tuple(source.get("tables") or ())
        transform = tree.get("transform")
        if transform is not None:
            transform = dict(transform)
            drop = ("function_name", "alloc_function_name", "enable_logging")
            transform = {k: v for k, v in transform.items() if k not in drop}
            transform["modules"] = tuple(
                ModuleSpec(m.get("path", "")) if isinstance(m, Mapping) else m
                for m in transform.get("modules") or ()
            )
            transform = TransformSpec(**transform)
        dlq = tree.get("dlq")
        if dlq is not None:
            dlq = DlqSpec(bool(dlq.get("enabled")), _sink(dlq.get("sink") or {}))
        rest = {k: tree[k] for k in ("work_dir", "on_sink_failure") if k in tree}
        return cls(
            source=SourceSpec(**source),
            sink=_sink(sink),
            transform=transform,
            mapping=MappingSpec(dict((tree.get("mapping") or {}).get("table_stream_map") or {})),
            dlq=dlq,
            retry=RetrySpec(**(tree.get("retry") or {})),
            **rest,
        )

    def validate(self, custom_sinks: tuple[str, ...] = ()) -> None:
        """Raise ValueError for the first thing that is wrong."""
        if self.source.type != "postgres":
            raise ValueError(f"unsupported source type: {self.source.type}")
        if self.source.ts_mode not in (TRANSACTION, LAST_SEEN):
            raise ValueError(f"unsupported source ts mode: {self.source.ts_mode}")
        if self.source.deliveries not in ("any", "first"):
            raise ValueError(f"unsupported source deliveries: {self.source.deliveries}")
        parse_position(self.source.start_lsn)
        t = self.transform
        if t is not None and t.enabled:
            if t.type != "python":
                raise ValueError(f"unsupported transform type: {t.type}")
            if not t.path and not t.modules:
                raise ValueError("transform.path or transform.modules is required when enabled")
            for i, module in enumerate(t.modules):
                if isinstance(module, ModuleSpec) and not module.path:
                    raise ValueError(f"transform.modules[{i}].path is required")
        _check_sink(self.sink, "sink", custom_sinks)
        if self.dlq is not None and self.dlq.enabled:
            _check_sink(self.dlq.sink, "dlq.sink", custom_sinks)
        if self.on_sink_failure not in ("dlq", "fail"):
            raise ValueError(f"unsupported on_sink_failure: {self.on_sink_failure}")


def _sink(tree: Mapping[str, Any]) -> SinkSpec:
    tree = dict(tree)
    tree["brokers"] = tuple(tree.get("brokers") or ())
    if tree.get("outbox") is not None:
        tree["outbox"] = Outbox(**tree["outbox"])
    return SinkSpec(**tree)


def _check_sink(sink: SinkSpec, prefix: str, custom: tuple[str, ...]) -> None:
    if sink.type == "kafka":
        if not sink.brokers:
            raise ValueError(f"{prefix}.brokers is required for kafka sink")
    elif sink.type in ("file", "topic_log"):
        if not sink.path:
            raise ValueError(f"{prefix}.path is required for {sink.type} sink")
    elif sink.type != "stdout" and sink.type not in custom:
        raise ValueError(f"unsupported {prefix} type: {sink.type}")
