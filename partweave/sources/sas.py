"""Numbered SAS extracts as one DataFrame, read in parallel.

A Python Data Source: one input partition per part file, so the files of a
table are decoded by as many tasks as there are files. Each task streams its
file in row chunks through the public ``pandas.read_sas`` decoder and yields
Arrow batches - no file is held whole in memory and nothing passes through
the driver. The part number is taken from the file name.

    register(spark)
    df = (spark.read.format("sasparts")
          .option("path", "data/")            # directory or glob
          .option("table", "procedure")       # files procedure_<i>.sas7bdat
          .load())
    landed = land(df)                          # *id columns -> bigint

Options: ``path``, ``table``, ``format`` (``sas7bdat`` | ``xport``),
``encoding``, ``chunk_rows``. Files are listed through ``pyarrow.fs``, which
reads local, HDFS and object-store URIs.
"""

from __future__ import annotations

import re

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# File extension per format, and the part-number pattern
# ``<table>_<i>.<ext>`` of an extract file.
EXTENSIONS = {"sas7bdat": "sas7bdat", "xport": "xpt"}
PART_NAME = r"^{table}_(\d+)\.{ext}$"


def _list_parts(path: str, table: str, fmt: str) -> list[tuple[int, str]]:
    import pyarrow.fs as pafs

    fs, root = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)
    pat = re.compile(PART_NAME.format(table=re.escape(table), ext=EXTENSIONS[fmt]), re.IGNORECASE)
    infos = fs.get_file_info(pafs.FileSelector(root, recursive=False))
    found = []
    for info in infos:
        m = pat.match(info.base_name)
        if m and info.type == pafs.FileType.File:
            uri = info.path if "://" not in path else path.rstrip("/") + "/" + info.base_name
            found.append((int(m.group(1)), uri))
    if not found:
        raise FileNotFoundError(f"no {table}_<i>.{EXTENSIONS[fmt]} under {path}")
    return sorted(found)


def _open(uri: str):
    import pyarrow.fs as pafs

    if "://" in uri:
        fs, p = pafs.FileSystem.from_uri(uri)
        return fs.open_input_file(p)
    return open(uri, "rb")


# Fixed value: what the pandas transport-file decoder returns for an IBM
# float zero (all zero bytes), 2**-260; no real extract holds that number.
XPORT_DECODED_ZERO = 2.0**-260


def _chunks(uri: str, fmt: str, encoding: str | None, chunk_rows: int):
    import pandas as pd

    fh = _open(uri)
    try:
        for chunk in pd.read_sas(fh, format=fmt, encoding=encoding, chunksize=chunk_rows):
            if fmt == "xport":
                for c in chunk.columns:
                    if pd.api.types.is_float_dtype(chunk[c].dtype):
                        chunk[c] = chunk[c].mask(chunk[c].abs() == XPORT_DECODED_ZERO, 0.0)
            yield chunk
    finally:
        fh.close()


def _spark_type(dtype) -> object:
    import pandas as pd

    if pd.api.types.is_bool_dtype(dtype):
        return BooleanType()
    if pd.api.types.is_integer_dtype(dtype):
        return LongType()
    if pd.api.types.is_float_dtype(dtype):
        return DoubleType()
    if pd.api.types.is_datetime64_any_dtype(dtype):
        return TimestampNTZType()
    return StringType()


class SasPartsDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sasparts"

    def _opts(self):
        o = self.options
        fmt = o.get("format", "sas7bdat").lower()
        if fmt not in EXTENSIONS:
            raise ValueError(f"format must be one of {sorted(EXTENSIONS)}")
        return o["path"], o["table"], fmt, o.get("encoding"), int(o.get("chunk_rows", "100000"))

    def schema(self) -> StructType:
        """Columns of the first part, plus ``part``. Names and types stand in the file's
        own header; one row is read to have pandas open it. Parts that lack a column are refused."""
        path, table, fmt, enc, _ = self._opts()
        _, first = _list_parts(path, table, fmt)[0]
        head = next(iter(_chunks(first, fmt, enc, 1)))
        fields = [StructField(str(c), _spark_type(t), True) for c, t in head.dtypes.items()]
        return StructType(fields + [StructField("part", LongType(), True)])

    def reader(self, schema: StructType) -> DataSourceReader:
        return SasPartsReader(*self._opts(), schema)


class PartFile(InputPartition):
    def __init__(self, part: int, uri: str):
        super().__init__(uri)
        self.part = part
        self.uri = uri


class SasPartsReader(DataSourceReader):
    def __init__(self, path, table, fmt, encoding, chunk_rows, schema):
        self.path, self.table, self.fmt = path, table, fmt
        self.encoding, self.chunk_rows, self.schema = encoding, chunk_rows, schema

    def partitions(self):
        return [PartFile(p, uri) for p, uri in _list_parts(self.path, self.table, self.fmt)]

    def read(self, partition: PartFile):
        import pyarrow as pa

        arrow_schema = pa.schema(
            [
                pa.field(
                    f.name,
                    {
                        "bigint": pa.int64(),
                        "double": pa.float64(),
                        "boolean": pa.bool_(),
                        "timestamp_ntz": pa.timestamp("us"),
                    }.get(f.dataType.simpleString(), pa.string()),
                )
                for f in self.schema.fields
            ]
        )
        data_cols = [f.name for f in self.schema.fields if f.name != "part"]
        for chunk in _chunks(partition.uri, self.fmt, self.encoding, self.chunk_rows):
            missing = set(data_cols) - set(map(str, chunk.columns))
            if missing:
                raise ValueError(f"{partition.uri} lacks columns {sorted(missing)}")
            chunk = chunk[data_cols].copy()
            for f in self.schema.fields:
                if f.name == "part" or not isinstance(f.dataType, StringType):
                    continue
                col = chunk[f.name]
                sample = col.dropna().head(1)
                # Text comes back as bytes when no encoding was given: decode
                # the column at once (not per cell), and only then.
                if len(sample) and isinstance(sample.iloc[0], bytes):
                    chunk[f.name] = col.str.decode(self.encoding or "utf-8")
            chunk["part"] = partition.part
            yield pa.RecordBatch.from_pandas(chunk, schema=arrow_schema, preserve_index=False)


def register(spark) -> None:
    """Make ``spark.read.format("sasparts")`` available in this session."""
    spark.dataSource.register(SasPartsDataSource)
