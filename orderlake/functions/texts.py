"""Several texts of a row as one, for a shuffle.

A row pays offset, length and padding for each of its texts, which compress badly. What holds a
mark of the packing, or bytes that are no UTF-8 (a text cut within a letter, which would hide the
mark behind it), is packed as its bytes in hex.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PACK = "_texts"
_BETWEEN, _ESCAPE = "\x1f", "\x1b"
_NULL = f"{_ESCAPE}n"


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _names(schema: T.StructType, keys: tuple[str, ...]) -> list[str]:
    """The texts to pack: all but the keys, if they are more than one."""
    texts = [f.name for f in schema.fields if f.dataType == T.StringType() and f.name not in keys]
    return texts if len(texts) > 1 else []


def _spelled(text: Column) -> Column:
    plain = ~text.contains(_BETWEEN) & ~text.contains(_ESCAPE) & F.is_valid_utf8(text)
    spelled = F.when(plain, text).otherwise(F.concat(F.lit(_ESCAPE), F.hex(text)))
    return F.coalesce(spelled, F.lit(_NULL))


def _read(text: Column) -> Column:
    spelled = F.unhex(F.substring(text, 2, 2**31 - 1)).cast("string")
    return F.when(~text.startswith(_ESCAPE), text).when(text != _NULL, spelled)


def packed(frame: DataFrame, *keys: str) -> DataFrame:
    """``frame`` with all texts but ``keys`` in one column."""
    names = _names(frame.schema, keys)
    if not names:
        return frame
    pack = F.concat_ws(_BETWEEN, *[_spelled(_column(name)) for name in names])
    return frame.select(
        *[_column(name) for name in frame.columns if name not in names], pack.alias(_PACK)
    )


def unpacked(frame: DataFrame, schema: T.StructType, *keys: str) -> DataFrame:
    """The columns of ``schema`` as they were before ``packed``, then what came to them since."""
    names = _names(schema, keys)
    if not names:
        return frame
    columns = []
    for field in schema.fields:
        value = _column(field.name)
        if field.name in names:
            place = F.lit(names.index(field.name) + 1)
            value = _read(F.split_part(_column(_PACK), F.lit(_BETWEEN), place))
        columns.append(value.alias(field.name, metadata=field.metadata))
    since = [name for name in frame.columns if name not in (*schema.names, _PACK)]
    return frame.select(*columns, *[_column(name) for name in since])
