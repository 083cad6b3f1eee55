"""Annotators as user functions over documents, or as tables of responses."""

from __future__ import annotations

import ctypes
import multiprocessing
import os
import signal
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .harmonize import make_annotations

_STREAM = "document_id string, source string, ordinal int, span_text string, entity_type string, start int, end int, canonical_id string, canonical_name string, confidence string, status string, annotation_count long, reason string"
_FIELDS = ("span_text", "entity_type", "start", "end", "canonical_id", "canonical_name", "confidence")


#: Seconds that an annotator has for a document, and for loading.
DEADLINE, LOAD_DEADLINE = 600.0, 900.0


class _Child:
    """An annotator in a process of its own: it may hang or die without taking the task along."""

    def __init__(self, loader: Callable, deadline: float, load_deadline: float):
        self.loader, self.deadline, self.load_deadline = loader, deadline, load_deadline
        self.process = self.pipe = None

    def _start(self) -> None:
        context = multiprocessing.get_context("fork")  # the loader may be a closure
        self.pipe, other = context.Pipe()
        self.process = context.Process(target=_serve, args=(self.loader, self.pipe, other), daemon=True)
        self.process.start()
        other.close()
        self._answer(self.load_deadline, "loading")

    def _answer(self, seconds: float, doing: str):
        if not self.pipe.poll(seconds):
            self.stop()
            raise TimeoutError(f"{doing} took more than {seconds:g} s")
        try:
            good, value = self.pipe.recv()
        except (EOFError, ConnectionResetError):
            self.process.join(5)
            code = self.process.exitcode
            self.stop()
            raise ChildProcessError(f"the annotator ended while {doing} (exit code {code})") from None
        if not good:
            if doing == "loading":
                self.stop()
            raise RuntimeError(value)
        return value

    def __call__(self, document: str, text: str) -> list[dict]:
        """Starts the process if none is alive: the first time, and after one hung or died."""
        if self.process is None:
            self._start()
        try:
            self.pipe.send((document, text))
        except (BrokenPipeError, ConnectionResetError):  # it died between two documents
            self.stop()
            self._start()
            self.pipe.send((document, text))
        return self._answer(self.deadline, "annotating")

    def stop(self) -> None:
        if self.process is not None:
            self.process.kill()
            self.process.join()
            self.pipe.close()
        self.process = self.pipe = None


def _serve(loader: Callable, parent, pipe) -> None:
    """The child's loop; it ends with its parent."""
    parent.close()
    try:
        ctypes.CDLL(None).prctl(1, signal.SIGKILL)  # PR_SET_PDEATHSIG, where there is one
    except (OSError, AttributeError):
        pass
    try:
        try:
            annotate = loader()
            pipe.send((True, None))
        except Exception as error:  # noqa: BLE001
            pipe.send((False, str(error) or type(error).__name__))
            return
        while True:
            document, text = pipe.recv()
            try:
                pipe.send((True, list(annotate(document, text))))
            except Exception as error:  # noqa: BLE001
                pipe.send((False, str(error) or type(error).__name__))
    except (EOFError, BrokenPipeError, KeyboardInterrupt):
        pass
    finally:
        os._exit(0)  # the parent's own clean-up is not the child's


def run_annotators(documents: DataFrame, annotators: dict[str, Callable[[], Callable[[str, str], list[dict]]]], known: list[str] | None = None, deadline: float | dict[str, float] | None = DEADLINE, load_deadline: float = LOAD_DEADLINE) -> DataFrame:
    """Every annotator on every document: one stream of annotation rows (status null) and status rows.

    annotators maps a name to a loader that returns ``fn(document_id, text) -> list of dicts``.  Each runs in a
    child process of the Python worker, loaded once and again after it hung or died; deadline is the seconds
    that it has for a document (by name, or one for all).  With None annotators run inside the worker, without
    deadline.  An annotator that fails, hangs or dies gives a failed row with its reason and stops neither the others
    nor the task.  The stream is one narrow stage: cache it once, then split it."""
    if known is not None and (bad := sorted(set(annotators) - set(known))):
        raise ValueError(f"unknown annotators: {', '.join(bad)}")
    names = [x.split()[0] for x in _STREAM.split(", ")]
    types = [{"int": pa.int32(), "long": pa.int64()}.get(x.split()[1], pa.string()) for x in _STREAM.split(", ")]
    seconds = {name: deadline.get(name, DEADLINE) if isinstance(deadline, dict) else deadline for name in annotators}

    def callers() -> dict[str, Callable]:
        if deadline is None:
            return {name: _Loaded(loader) for name, loader in annotators.items()}
        return {name: _Child(loader, seconds[name], load_deadline) for name, loader in annotators.items()}

    def run(batches):
        running = callers()
        try:
            for batch in batches:
                out = []
                for document, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    for name, annotate in running.items():
                        try:
                            rows, reason = list(annotate(document, text)), None
                        except Exception as error:  # noqa: BLE001
                            rows, reason = [], str(error) or type(error).__name__
                        for i, r in enumerate(rows, 1):
                            values = [r.get(f) for f in _FIELDS]
                            out.append((document, name, i, *(v if v is None or f in ("start", "end") else str(v) for f, v in zip(_FIELDS, values, strict=True)), None, None, None))
                        status = "failed" if reason else "produced_annotations" if rows else "no_annotations"
                        out.append((document, name, 0, *[None] * len(_FIELDS), status, len(rows), reason or (None if rows else "No annotations returned.")))
                columns = list(zip(*out, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        finally:
            for annotate in running.values():
                annotate.stop()

    return documents.select("document_id", "text").mapInArrow(run, _STREAM)


class _Loaded:
    """An annotator inside the worker, loaded at its first document; what went wrong then is its answer to all."""

    def __init__(self, loader: Callable):
        self.loader, self.annotate = loader, None

    def __call__(self, document: str, text: str) -> list[dict]:
        if self.annotate is None:
            try:
                self.annotate = self.loader()
            except Exception as error:  # noqa: BLE001
                self.annotate = error
        if isinstance(self.annotate, Exception):
            raise self.annotate
        return self.annotate(document, text)

    def stop(self) -> None:
        self.annotate = None


def split_stream(stream: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(annotations, statuses) of a stream; offsets that are missing are looked up in the text."""
    spans = stream.where("status IS NULL").withColumn("source_rank", F.lit(0)).join(documents.select("document_id", "text"), "document_id")
    statuses = stream.where("status IS NOT NULL").select("document_id", F.col("source").alias("name"), "status", "annotation_count", "reason")
    return make_annotations(spans, "text"), statuses


def annotate_from_payloads(documents: DataFrame, payloads: DataFrame, parser: Callable[[DataFrame, DataFrame], DataFrame], name: str) -> tuple[DataFrame, DataFrame]:
    """(annotations, statuses) where the responses are a table; documents without one have no annotations."""
    annotations = make_annotations(parser(payloads, documents), "text").withColumn("source", F.lit(name))
    counts = annotations.groupBy("document_id").agg(F.count("*").alias("n"))
    df = documents.select("document_id").join(counts, "document_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    status = F.when(F.col("n") > 0, "produced_annotations").otherwise("no_annotations")
    return annotations, df.select("document_id", F.lit(name).alias("name"), status.alias("status"), F.col("n").alias("annotation_count"), F.when(F.col("n") == 0, "No annotations returned.").alias("reason"))
