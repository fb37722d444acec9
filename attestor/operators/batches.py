"""Runs of batch requests that can be interrupted: what was submitted is on record before anyone waits for it.

A run's state is one JSON file a dataset.  It is written aside and renamed, so it is there whole or not at all.  A run
is taken up again only if it has as many requests as are asked for now; one of another count is submitted anew.  A run
with pending batches stays on record, a finished one is removed once its answers are written.

The requests are cut once: they are written by block, so that a block is read alone however many there are.  A service
that takes many small batches is better served by ``Together``, which submits several blocks by one job.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestor.operators.providers import blocks
from attestor.sources.store import Folder

BLOCK = 90_000
Submit = Callable[[DataFrame], str]  # the requests of a block -> the batch's id
Poll = Callable[[str], str]  # a batch's id -> "ended" or another state


@dataclass(frozen=True)
class Together:
    """Submits several blocks by one job: ``submit`` takes their requests with ``block`` and gives the batches' ids by block.

    They are put on record together, so a driver that is lost in between submits at most ``most`` blocks again.
    A block without requests needs no id.
    """

    submit: Callable[[DataFrame], dict[int, str]]
    most: int = 256


@dataclass
class BatchRun:
    """What is on record of a run."""

    dataset: str
    request_count: int
    batch_ids: list[str] = field(default_factory=list)
    model: str = ""
    complete: bool = False  # whether all blocks were submitted
    resumed: bool = False


class RunStore:
    """Run states in a shared folder."""

    def __init__(self, requests: DataFrame, folder: str) -> None:
        self._files = Folder(requests.sparkSession, folder)

    def load(self, dataset: str) -> BatchRun | None:
        said = self._files.read(f"{dataset}.json")
        return BatchRun(**said) if said else None

    def save(self, run: BatchRun) -> None:
        self._files.put(f"{run.dataset}.json", run.__dict__, replace=True)

    def remove(self, dataset: str) -> None:
        self._files.remove(f"{dataset}.json")


def start(requests: DataFrame, dataset: str, submit: Submit | Together, folder: str, model: str = "", block: int = BLOCK) -> BatchRun:
    """Submit the requests (custom_id, chunk, ...) in blocks, or take up the run on record if its count is equal.

    Every block is put on record as soon as it is submitted.  If the driver is lost between two blocks, the next
    start goes on behind those on record: blocks are cut by the hash of the ids, so they are the same again.
    """
    store, n = RunStore(requests, folder), requests.count()
    run = store.load(dataset)
    if run is not None and run.request_count == n and (run.batch_ids or not n):
        run.resumed = True
    else:
        run = BatchRun(dataset, n, model=model)
    if run.complete or not n:
        return run
    cut, total = blocks(requests, block, n), max(1, -(-n // block))
    most = submit.most if isinstance(submit, Together) else 1
    done, staged = len(run.batch_ids), None
    if total - done > most:
        staged = Folder(requests.sparkSession, f"{folder}/_cut-{uuid.uuid4().hex}")
        left = cut.where(F.col("block") >= done).withColumn("_part", F.floor((F.col("block") - done) / most))
        left.repartition("block").write.partitionBy("_part").parquet(staged.path)
    try:
        for k in range(done, total, most):
            rows = cut.where((F.col("block") >= k) & (F.col("block") < k + most)) if staged is None else _part(staged, (k - done) // most, cut)
            if isinstance(submit, Together):
                ids = submit.submit(rows)
                run.batch_ids += [ids.get(i, "") for i in range(k, min(k + most, total))]
            else:
                run.batch_ids.append(submit(rows.drop("block")))
            store.save(run)
    finally:
        if staged is not None:
            staged.remove("")
    run.complete = True
    store.save(run)
    return run


def _part(staged: Folder, k: int, like: DataFrame) -> DataFrame:
    """The requests of a part of the cut; none where no request fell into it."""
    name = f"_part={k}"
    return like.sparkSession.read.schema(like.schema).parquet(f"{staged.path}/{name}") if staged.has(name) else like.where("false")


def finish(requests: DataFrame, dataset: str, poll: Poll, fetch: Callable[[list[str]], DataFrame], write: Callable[[DataFrame], None], folder: str) -> tuple[str, list[str]]:
    """("pending", ids) while a batch has not ended; else the answers are fetched and written, the record removed: ("ended", ids).

    ("none", []) where no run is on record.  If writing fails the record stays, and a later call does it again.
    """
    store = RunStore(requests, folder)
    run = store.load(dataset)
    if run is None:
        return "none", []
    waiting = [b for b in run.batch_ids if b and poll(b) != "ended"]
    if waiting or not run.complete:
        return "pending", waiting
    ids = [b for b in run.batch_ids if b]
    write(fetch(ids))
    store.remove(dataset)
    return "ended", ids
