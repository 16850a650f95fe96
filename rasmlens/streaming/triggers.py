"""When a streaming query takes its next micro-batch."""


def triggered(writer, interval: str | None):
    """``interval=None`` takes what is there, in micro-batches, and stops."""
    if interval is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval)
