"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of the contracts: runs of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def column_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def utf8(column: Column | str) -> Column:
    """The text as bytes, which Python workers then get without decoding; null stays null."""
    return (F.col(column) if isinstance(column, str) else column).cast("binary")


def folded_words(text: bytes | None) -> list[bytes]:
    """Words with A-Z lower-cased; ``bytes`` knows ASCII only, which is what is asked for."""
    return (text or b"").lower().split()


def held_out(id_column: str = "doc_id", folds: int = 3, fold: int = 1) -> Column:
    """True where crc32 of the id as text leaves the remainder of the held-out fold; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % folds == fold, F.lit(False))


def whole_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Regroup sorted batches into tables of whole groups, with the row numbers where groups start.

    The input must be sorted by ``keys`` (whole numbers without null). Holds one batch and one unfinished group.
    """
    kept: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if kept is not None:
            table = pa.concat_tables([kept, table]).combine_chunks()
        if not table.num_rows:
            continue
        starts = _starts(table, keys)
        last = int(starts[-1])
        kept = table.slice(last)
        if last:
            yield table.slice(0, last), starts[:-1]
    if kept is not None and kept.num_rows:
        yield kept, np.zeros(1, dtype=np.int64)


def _starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    new = np.zeros(table.num_rows, dtype=bool)
    new[0] = True
    for k in keys:
        values = table.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def crc32_text(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def compiled_ascii(pattern: str) -> re.Pattern[str]:
    """Letters in either case, ASCII only."""
    return re.compile(pattern, re.IGNORECASE | re.ASCII)
