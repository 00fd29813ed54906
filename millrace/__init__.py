"""Change-data pipelines written for Spark: decode, transform, route, deliver, account."""

from millrace.session import configure
from millrace.spec import PipelineSpec
from millrace.streaming.runner import build

__all__ = ["PipelineSpec", "build", "configure"]
