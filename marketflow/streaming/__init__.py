"""Streaming jobs of the three stages."""

from marketflow.streaming.jobs import (
    Pipeline,
    await_any,
    start_direct,
    start_load,
    start_routing,
    start_transform,
)
from marketflow.streaming.latest import read_latest, running_latest, start_latest
from marketflow.streaming.metrics import MetricsListener, metrics_of
from marketflow.streaming.supervise import Outcome, supervise

__all__ = ["MetricsListener", "Outcome", "Pipeline", "await_any", "metrics_of", "read_latest", "running_latest", "start_direct", "start_latest", "start_load", "start_routing", "start_transform", "supervise"]
