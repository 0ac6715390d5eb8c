"""Helpers that the corpus operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from functools import lru_cache, wraps
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import depotlens
from depotlens.session import new_scratch_path

ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: the white space that the word contracts name: space and \x09-\x0D
WORD_SPACE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """df written once as Parquet in the shared folder and read again: later
    jobs reread files that survive lost executors instead of recomputing."""
    path = new_scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, ASCII_UPPER, ASCII_UPPER.lower())


def text_or_empty(c: str = "text") -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def slots(spark: SparkSession) -> int:
    """Partitions for a shuffle of whole texts."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def with_package(df: DataFrame) -> DataFrame:
    """df; the library's code is sent to the executors once per application,
    so that Python tasks can import it wherever they run."""
    sc = df.sparkSession.sparkContext
    if not getattr(sc, "_depotlens_sent", False):
        root = Path(depotlens.__file__).parent
        archive = Path(tempfile.mkdtemp(prefix="depotlens-code-")) / "depotlens.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, f.relative_to(root.parent))
        sc.addPyFile(str(archive))
        sc._depotlens_sent = True
    return df


_STATES: dict[str, list] = {}


def worker_state(operator: str, most: int = 1) -> Callable:
    """A function whose last results a Python worker keeps for the operator (model,
    vocabulary and their caches). Spark's workers go on from stage to stage: what
    other operators have left there is let go at the next call."""
    def keep(make: Callable) -> Callable:
        held = lru_cache(maxsize=most)(make)
        _STATES.setdefault(operator, []).append(held)

        @wraps(make)
        def get(*args):
            release(operator)
            return held(*args)

        get.cache_info, get.cache_clear = held.cache_info, held.cache_clear
        return get

    return keep


def release(but: str | None = None) -> None:
    """Lets go of the state of all operators but one."""
    for operator, states in _STATES.items():
        if operator != but:
            for held in states:
                held.cache_clear()
