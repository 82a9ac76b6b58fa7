"""Feeds of the stream tests: one file per micro-batch."""

import time


def append_feed_file(chunk, path, value_col="value", pause_s=1.1):
    """Append one frame as one new file of the feed folder.

    The file source orders new files by modification time; the pause keeps the
    files' times apart, so with one file per trigger the i-th appended file is
    the i-th micro-batch.
    """
    chunk.select(value_col).coalesce(1).write.mode("append").text(path)
    time.sleep(pause_s)
