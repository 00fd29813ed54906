import pytest

from millrace.operators.routing import Outbox
from millrace.spec import ModuleSpec, PipelineSpec, RetrySpec, parse_position

BASE = {"source": {"type": "postgres"}, "sink": {"type": "stdout"}}


def problem(**parts):
    try:
        PipelineSpec.from_dict({**BASE, **parts}).validate()
    except ValueError as cause:
        return str(cause)
    return None


@pytest.mark.parametrize(
    "parts, want",
    [
        ({}, None),
        ({"source": {"type": "mysql"}}, "unsupported source type: mysql"),
        ({"sink": {"type": "kafka"}}, "sink.brokers is required for kafka sink"),
        ({"sink": {"type": "kafka", "brokers": ["b:1"]}}, None),
        ({"sink": {"type": "file"}}, "sink.path is required for file sink"),
        ({"sink": {"type": "file", "path": "/tmp/x"}}, None),
        ({"sink": {"type": "rabbitmq"}}, "unsupported sink type: rabbitmq"),
        ({"transform": {"enabled": True, "type": "lua"}}, "unsupported transform type: lua"),
        ({"transform": {"enabled": True, "type": "python"}}, "transform.path or transform.modules is required when enabled"),
        ({"transform": {"enabled": True, "modules": [{"path": "a:b"}, {}]}}, "transform.modules[1].path is required"),
        ({"transform": {"enabled": False, "type": "python"}}, None),
        ({"dlq": {"enabled": True, "sink": {"type": "file"}}}, "dlq.sink.path is required for file sink"),
        ({"dlq": {"enabled": True, "sink": {"type": "nope"}}}, "unsupported dlq.sink type: nope"),
        ({"dlq": {"enabled": False, "sink": {"type": "file"}}}, None),
        ({"on_sink_failure": "shrug"}, "unsupported on_sink_failure: shrug"),
    ],
)
def test_validation(parts, want):
    assert problem(**parts) == want


def test_from_dict():
    spec = PipelineSpec.from_dict(
        {
            "source": {"type": "postgres", "dsn": "ignored", "slot_name": "ignored", "tables": ["users"]},
            "transform": {"enabled": True, "path": "ignored:x", "modules": [{"path": "a:b"}]},
            "sink": {"type": "kafka", "brokers": ["b:1"], "outbox": {"key_field": "aggregate_id"}},
            "mapping": {"table_stream_map": {"users": "u"}},
            "dlq": {"enabled": True, "sink": {"type": "file", "path": "/x", "max_size": 10}},
            "retry": {"max_attempts": 5},
            "logger": {"level": "debug"},
        }
    )
    assert spec.source.tables == ("users",) and spec.transform.modules == (ModuleSpec("a:b"),)
    assert spec.sink.outbox == Outbox("aggregate_id") and spec.mapping.table_stream_map == {"users": "u"}
    assert spec.dlq.sink.max_size == 10 and (spec.retry.max_attempts, spec.retry.backoff_ms) == (5, 100)


def test_defaults():
    assert RetrySpec() == RetrySpec(0, -1) == RetrySpec(3, 100)
    assert PipelineSpec.from_dict(BASE).sink.outbox is None


def test_positions():
    assert parse_position("") is None and parse_position(None) is None
    assert parse_position("16/B374D848") == 0x16B374D848
    assert parse_position("42") == parse_position(42) == 42
