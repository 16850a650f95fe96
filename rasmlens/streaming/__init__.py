from rasmlens.streaming.batches import (
    ROW, finished_batches, read_batches, running_accuracy, track_accuracy, write_batches)
from rasmlens.streaming.flow import (
    classify, evaluate_output, read_output, read_stream, run_for, run_stream, stream_accuracy,
    write_console, write_feed, write_stream)

__all__ = [
    "ROW", "classify", "evaluate_output", "finished_batches", "read_batches", "read_output", "read_stream", "run_for",
    "run_stream", "running_accuracy", "stream_accuracy", "track_accuracy", "write_batches", "write_console",
    "write_feed", "write_stream",
]
