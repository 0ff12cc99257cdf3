"""Sources and sinks: input tables, the test-table binding, feature storage."""

from histwise.sources.inputs import Inputs, bounded_broadcast

__all__ = ["Inputs", "bounded_broadcast"]
