"""Continuous operation on Structured Streaming; checkpoints replace polling loops and watermarks."""

from lakeload.streaming.archive import archive_stream
from lakeload.streaming.export import export_stream, exported_rows
from lakeload.streaming.load import load_stream
