"""Schema log of a growing dataset: the schema that holds all its writes, kept beside the data, so that reads need no footers.

Under the dataset's path, ``_schema/s-<number>.json`` files hold schemas as Spark's JSON; the highest number rules.  Each write
first records the union of the logged schema and its own: new columns are added (older files show NULL there), and a
column that comes in another type is widened where Parquet files of the narrower type can be read as the wider one
(integers, float to double, decimals, date to timestamp_ntz).  Types that do not widen are an error before anything is
written.  A recorded schema of which the write then failed does no harm: it only has a column more.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql import types as T

FOLDER = "_schema"
_INTEGERS = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


class Incompatible(TypeError):
    """Two types of a column that no wider type can hold."""


def widened(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that values of both can be read as."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    kinds = {type(a), type(b)}
    if kinds <= set(_INTEGERS):
        return max((a, b), key=lambda t: _INTEGERS.index(type(t)))
    if kinds == {T.FloatType, T.DoubleType} or (T.DoubleType in kinds and kinds - {T.DoubleType} <= set(_INTEGERS[:3])):
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    if T.DecimalType in kinds and kinds <= {T.DecimalType, *_INTEGERS}:
        parts = [(t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        whole, scale = max(p[0] for p in parts), max(p[1] for p in parts)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged(a, b)
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widened(a.elementType, b.elementType), True)
    raise Incompatible(f"{a.simpleString()} and {b.simpleString()}")


def merged(a: T.StructType, b: T.StructType) -> T.StructType:
    """All columns of both, ``a``'s first; of common ones the wider type."""
    have = {f.name: f for f in a.fields}
    out = []
    for f in a.fields:
        other = next((g for g in b.fields if g.name == f.name), None)
        try:
            out.append(T.StructField(f.name, f.dataType if other is None else widened(f.dataType, other.dataType), True))
        except Incompatible as e:
            raise Incompatible(f"column {f.name}: {e}") from e
    return T.StructType(out + [T.StructField(g.name, g.dataType, True) for g in b.fields if g.name not in have])


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{FOLDER}")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(n for n in (s.getPath().getName() for s in fs.listStatus(folder)) if n.startswith("s-")) if fs.exists(folder) else []
    return fs, names


def logged(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema that rules now; None for a dataset without a log."""
    fs, names = _files(spark, path)
    if not names:
        return None
    stream = fs.open(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{FOLDER}/{names[-1]}"))
    try:
        return T.StructType.fromJson(json.loads(bytes(stream.readAllBytes()).decode()))
    finally:
        stream.close()


def record(spark: SparkSession, path: str, schema: T.StructType) -> T.StructType:
    """Widen the logged schema by ``schema``; the result.  Nothing is written if it already holds it."""
    now = logged(spark, path)
    new = merged(now, schema) if now is not None else T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
    if now is not None and new.jsonValue() == now.jsonValue():
        return now
    fs, names = _files(spark, path)
    number = int(names[-1][2:-5]) + 1 if names else 1
    jpath = spark._jvm.org.apache.hadoop.fs.Path
    folder = f"{path.rstrip('/')}/{FOLDER}"
    fs.mkdirs(jpath(folder))
    part = jpath(f"{folder}/.writing-{number}")                      # named only once it is whole
    out = fs.create(part, True)
    try:
        out.write(bytearray(new.json().encode()))
    finally:
        out.close()
    if not fs.rename(part, jpath(f"{folder}/s-{number:08d}.json")):
        raise OSError(f"the schema of {path} was written by someone else")
    return new
