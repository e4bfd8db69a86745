"""What the operators of this folder share: written tables in the shared work folder, and safe column names."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shipping import ship as ship
from ..staging import shared_folder as shared_dir

#: ASCII white space as the contracts of the text operators define it.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


#: Folders that ``written`` made in this process, oldest first.
_WRITTEN: list[str] = []


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _WRITTEN.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mark() -> int:
    """How many folders have been written so far: what ``release`` takes."""
    return len(_WRITTEN)


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the folders written after the mark ``since`` but the newest, for when only that one is read from now on."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    for path in _WRITTEN[since:-1]:
        at = hadoop.Path(path)
        at.getFileSystem(conf).delete(at, True)
        _WRITTEN.remove(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder, for small intermediate tables."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def text_of(column: str | Column) -> Column:
    """A text column with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without columns that clash with ``names`` (in any case): results replace input columns of their names."""
    taken = {n.lower() for n in names}
    return df.select([F.col(quoted(c)) for c in df.columns if c.lower() not in taken])


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with as many leading underscores as it takes not to clash with ``columns`` (in any case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def quoted(name: str) -> str:
    """A column name that is safe with dots and backticks."""
    return "`" + name.replace("`", "``") + "`"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
