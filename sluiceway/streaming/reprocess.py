"""Reads logged batches again: a dry run that lists them, or a run under new batch ids.

The files are logged anew, as pending files are, so the intake's stream reads them like any
other batch and its ids go on from theirs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.operators.admission import first_by_path
from sluiceway.operators.pending import Pending, PendingFiles
from sluiceway.sources.options import DRY_RUN, IN_ACTION, ReprocessDryRun, ReprocessLocked
from sluiceway.streaming.intake import Intake, Sink

LOCK = "reprocess.lock"


def dry_run(intake: Intake, start: int, end: int) -> tuple[DataFrame, str]:
    """The files of the batches and a summary."""
    files = intake.log.range(start, end)
    return files, f"{end - start + 1} batches, {files.count()} files."


def release_lock(intake: Intake) -> bool:
    return intake.log.folder.delete(LOCK)


def run(intake: Intake, start: int, end: int, sink: Sink) -> list[int]:
    """Reads the files of the batches again, oldest file first, under new ids, which it returns.

    No message is fetched, none is deleted, and no file counts as expired. The lock that it
    takes stays until release_lock(), so that a restarted job doesn't start all over.
    """
    files = first_by_path(intake.log.range(start, end).select("path", "event_ms", "batch_id"), "batch_id", "event_ms")
    if not intake.log.folder.create_new(LOCK):
        raise ReprocessLocked(f"{intake.log.folder.at(LOCK)} is there; remove it to reprocess again")
    again = PendingFiles(max_age_ms=1 << 62)
    for r in files.orderBy("event_ms", "path").toLocalIterator():  # as many as the pending files that the batches were
        again.add(r.path, Pending(r.event_ms))
    issued = []
    while (new_id := intake.admit(again)) is not None:
        issued.append(new_id)
    intake.start(sink).awaitTermination()
    return issued


def by_options(intake: Intake, sink: Sink) -> list[int]:
    """What the intake's options ask for: nothing, a dry run (which ends with its summary as an error), or a run."""
    o = intake.options
    if o.reprocess_state == DRY_RUN:
        files, said = dry_run(intake, o.reprocess_start, o.reprocess_end)
        raise ReprocessDryRun(said)
    return run(intake, o.reprocess_start, o.reprocess_end, sink) if o.reprocess_state == IN_ACTION else []
