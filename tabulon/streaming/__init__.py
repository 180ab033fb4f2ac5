"""Tables as streams: batches of what was appended, each handled once."""

from .source import AppendStream

__all__ = ["AppendStream"]
