"""Small helpers that several operators of this subpackage share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.session import cut_lineage

#: bytes.split() cuts at exactly these six: space, tab, line feed, vertical tab, form feed, return
WORD = r"[^\x20\x09-\x0D]+"


def fresh(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have yet, so columns of the caller never clash."""
    taken = {c.lower() for c in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def with_row_id(df: DataFrame, name: str) -> DataFrame:
    """Number the rows. The numbers hold for one evaluation: another scan, of a file too, may be split
    differently (executors lost or joined), so write the numbered rows before they are read twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def _is_file_scan(df: DataFrame) -> bool:
    """True for a file scan with projections and filters on it, where a row of the file is one row at most."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        plan = plan.children().head()
    return plan.nodeName() == "LogicalRelation"


def numbered_rows(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number for each row that is the same in every scan, however its files are split.

    Rows of Parquet files are numbered by file (in the order of their paths) and by place in the file, both from the
    reader's metadata, so no copy is made; the driver, which lists the files anyway, gets one path per file. Rows of
    anything else are numbered as they come and written."""
    file, place = fresh(df, "file_"), fresh(df, "place_")
    try:
        if not _is_file_scan(df):
            raise AnalysisException("no file scan")
        placed = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    except AnalysisException:
        return cut_lineage(with_row_id(df, name))
    paths = sorted(r[0] for r in df.select("_metadata.file_path").distinct().collect())
    number, of = fresh(placed, "number_"), fresh(placed, "of_")
    files = df.sparkSession.createDataFrame(list(enumerate(paths)), f"`{number}` long, `{of}` string")
    # as many rows as files
    joined = placed.join(F.broadcast(files), F.col(file) == F.col(of))
    return joined.select(*df.columns, F.shiftleft(number, 40).bitwiseOR(F.col(place)).alias(name))


def as_texts(column: pa.Array) -> list[str]:
    """Python strings of an Arrow column, null as empty."""
    return [t or "" for t in column.to_pylist()]


def flat_list(values, lengths, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from its flat values and the length of each list."""
    import numpy as np

    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def unsigned_hex(c: Column) -> Column:
    """16 lowercase hex digits of the 64 bits of a long."""
    return F.lower(F.lpad(F.hex(c), 16, "0"))


def matrix(lists: pa.ListArray, width: int):
    """Rows of a list column of integers as a matrix, padded with zeros."""
    import numpy as np

    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    n = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    if len(n) and (n == width).all():
        return flat.reshape(len(n), width)
    out = np.zeros((len(n), width), dtype=np.int64)
    out[np.arange(width) < n[:, None]] = flat
    return out
