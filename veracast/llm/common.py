"""Helpers the operators share: tables, words, per-task arrays and tables kept in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from veracast.session import shared_folder

# Rows worked on at a time inside a task, so that a task's memory does not follow Arrow's batches.
SLICE_ROWS = 1000

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def alnum_words(text: str | None) -> list[bytes]:
    """Words of ASCII letters, digits and characters beyond ASCII, with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split() if text else []


def spaced_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space (space, \\t to \\r), with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER_BYTES).split() if text else []


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a row without an id is in fold 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds, F.lit(0))


def per_row(work: Callable[[], Callable], returns: str):
    """A UDF from arrays to a struct array, evaluated once a row.

    ``work()`` runs once in each task and gives a function from Python columns to a list of dicts,
    which is called for at most SLICE_ROWS rows at a time. Spark joins the struct to the row itself,
    so all other columns of the table, whatever their names, stay as they are.
    """

    def rows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = work()
        for texts in batches:
            out = []
            for at in range(0, len(texts), SLICE_ROWS):
                out += one(texts.slice(at, SLICE_ROWS).to_pylist())
            yield out

    from pyspark.sql.types import StructType

    schema = arrow_type(StructType.fromDDL(returns))

    def typed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for out in rows(batches):
            yield pa.array(out, type=schema)

    return F.arrow_udf(typed, returns).asNondeterministic()


def arrow_type(schema) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(schema)


# Folders named since the innermost open ``scratch`` began, one list for each that is open.
_open: list[list[str]] = []


def new_place(spark: SparkSession, what: str) -> str:
    """A new folder that the driver and all executors reach."""
    place = f"{shared_folder(spark)}/llm/{what}-{uuid.uuid4().hex}"
    if _open:
        _open[-1].append(place)
    return place


def kept(df: DataFrame, what: str, place: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read again.

    Cuts the lineage without keeping anything on executors: a lost one costs a retry of its tasks.
    """
    place = place or new_place(df.sparkSession, what)
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


@contextmanager
def scratch(spark: SparkSession, *keep: str) -> Iterator[list[str]]:
    """Delete the folders that ``new_place`` names inside, except those for the uses ``keep``.

    Kept ones fall to the scratch around this one, if any, and are listed in what this yields.
    """
    _open.append([])
    left: list[str] = []
    try:
        yield left
    finally:
        for place in _open.pop():
            if place.rsplit("/", 1)[1].rsplit("-", 1)[0] in keep:
                left.append(place)
            else:
                remove(spark, place)
        if _open:
            _open[-1].extend(left)


@contextmanager
def recorded() -> Iterator[list[str]]:
    """List the folders that ``new_place`` names inside, for whoever deletes them later."""
    _open.append([])
    places = _open[-1]
    try:
        yield places
    finally:
        _open.pop()
        if _open:
            _open[-1].extend(places)


def remove(spark: SparkSession, place: str) -> None:
    """Delete a folder that ``new_place`` named, once nothing reads it any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first name like it that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def refuse_taken(df: DataFrame, name: str) -> None:
    """Every operator's rule for its result column: a name that the table has already is refused."""
    if name.lower() in {c.lower() for c in df.columns}:
        raise ValueError(f"the table has a column {name} already; give another one as into")
