"""What the operators share: the folder for intermediate tables, and reading a named table."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but the six ASCII blanks.
BLANKS = " \t\n\x0b\f\r"
#: A space inside or at the end of a run of white space (U+00A0 and others too): the byte-level BPE
#: pattern takes such a run as one piece, so the text must not be split at its spaces.
SPACE_IN_RUN = re.compile(r"(?<=\s) (?!\S)")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder, which every executor shares.

    It comes from ``spark.checkpoint.dir``. Only a single-machine session without that setting gets
    a temporary folder; on a cluster its absence is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not (context.master == "local" or context.master.startswith("local[")):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="llm-checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own for one run of an operator, inside the shared one."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def settled(frame: DataFrame) -> DataFrame:
    """The rows, written once to the shared folder, so that later steps start from there."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint()


def written(frame: DataFrame, name: str) -> DataFrame:
    """Like :func:`settled`, as compressed Parquet: for wide rows."""
    folder = new_folder(frame.sparkSession, name)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def give_back() -> None:
    """Give the freed memory of Arrow and of the C library back to the system.

    A worker that a stage leaves behind stays for the next one and would hold it beside that stage's own.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bind(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, inside one expression."""
    return F.element_at(F.transform(F.array(value), body), 1)
