"""Reading an unfamiliar CSV file without corrupting its values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rootlens.sources.split_csv import parse_records, read_records

# Where Windows-1252 and ISO-8859-1 differ: the 0x80-0x9F block. Python's codec
# supplies the characters; five codes have none and stay as they are.
_CODES = [b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
LATIN1_CODES = "".join(chr(b) for b in _CODES)
CP1252_CHARS = bytes(_CODES).decode("cp1252")


def is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether every line is valid UTF-8: one distributed scan, one row back."""
    bad = spark.read.text(path).agg(F.count_if(~F.is_valid_utf8("value")).alias("n")).first()
    return bad["n"] == 0


# only an empty cell is missing; quotes in quotes are doubled; a line of another width stops the load
OPTIONS = {"nullValue": "", "escape": '"', "mode": "FAILFAST"}


def header_of(spark: SparkSession, path: str, utf8: bool = True) -> list[str]:
    """The first record of the first file; reads no further."""
    encoding = "UTF-8" if utf8 else "ISO-8859-1"
    names = spark.read.csv(path, header=True, multiLine=True, escape='"', encoding=encoding).columns
    return names if utf8 else [n.translate(str.maketrans(LATIN1_CODES, CP1252_CHARS)) for n in names]


def read_flat_file(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """Types are inferred over all rows and only an empty cell is missing.

    A line with too few or too many fields stops the load. A quoted cell may hold
    line breaks; the file is read in splits all the same (see split_csv). ``multiline=False``
    skips the search for such cells in files known to have none.
    Text such as ``NA`` stays a value. A file that is not UTF-8 is read as
    Windows-1252, column names included.
    """
    if multiline:
        records, utf8 = read_records(spark, path, (LATIN1_CODES, CP1252_CHARS))
        return parse_records(records, header_of(spark, path, utf8), **OPTIONS)
    options = {"header": True, "inferSchema": True, **OPTIONS}
    if is_utf8(spark, path):
        return spark.read.option("columnPruning", False).csv(path, **options)
    df = spark.read.option("columnPruning", False).csv(path, encoding="ISO-8859-1", **options)
    table = str.maketrans(LATIN1_CODES, CP1252_CHARS)
    df = df.toDF(*[c.translate(table) for c in df.columns])
    return df.select(
        *[
            F.translate(f"`{f.name}`", LATIN1_CODES, CP1252_CHARS).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )
