"""Readers for landed files: everything arrives as text, a bad cell never fails a load.

CSV columns bind by name. A read over files with different headers would bind all
of them by one file's header, so files are grouped by header line (a handful of
variants) and every group is read with its own. Header lines are ranged reads: each
file is opened once more and a buffer or two taken from its beginning, however long it
is, through its codec. Like the listing of files that is work of the driver, which
opens many at a time; rows never pass it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions import scalar
from marketlake.specs import SourceSpec

CORRUPT = "_corrupt"


def header_variants(spark: SparkSession, path: str | Sequence[str], glob: str = "*.csv") -> list[tuple[str, list[str]]]:
    """(header line, files) of each distinct header. The list of files is metadata, bounded by their number."""
    variants: dict[str, list[str]] = {}
    for file, head in first_lines(spark, path, glob):
        variants.setdefault(head, []).append(file)
    return [(head, sorted(files)) for head, files in sorted(variants.items())]


#: Bytes of a file that may hold its header line, and files that are opened at a time.
HEAD_BYTES, OPEN_FILES = 1 << 20, 32


def first_lines(spark: SparkSession, path: str | Sequence[str], glob: str = "*.csv") -> list[tuple[str, str]]:
    """(file, first line) of each file that isn't empty; of a line beyond ``HEAD_BYTES`` its beginning."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path if isinstance(path, str) else list(path))
    files = [r["path"] for r in found.where("length > 0").select("path").collect()]
    jvm, conf = spark.sparkContext._jvm, spark._jsparkSession.sessionState().newHadoopConf()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(file: str) -> str | None:
        at = jvm.org.apache.hadoop.fs.Path(file)
        stream = at.getFileSystem(conf).open(at)
        try:
            codec = codecs.getCodec(at)
            plain = codec.createInputStream(stream) if codec else stream
            bounded = jvm.org.apache.commons.io.input.BoundedInputStream(plain, HEAD_BYTES)
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(bounded, "UTF-8")).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(OPEN_FILES) as pool:
        return [(f, h) for f, h in zip(files, pool.map(head, files), strict=True) if h is not None]


def read_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], glob: str = "*.csv", rename: Mapping[str, str] | None = None, **options: str) -> DataFrame:
    """All-string columns by name (case doesn't matter), the file's name in ``_file``; rows with too few or too many cells keep what they have, the raw line goes to ``_corrupt``."""
    out = None
    for head, files in header_variants(spark, path, glob):
        names = [h.strip().strip('"').lower() for h in head.split(options.get("sep", ","))]
        names = [(rename or {}).get(n, n) for n in names]
        schema = T.StructType([*(T.StructField(f"{i}_{n}", T.StringType()) for i, n in enumerate(names)), T.StructField(CORRUPT, T.StringType())])
        reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", True)
        reader = reader.option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).options(**options)
        part = reader.csv(files).select("*", F.col("_metadata.file_path").alias("_file"))
        own = {n: f"{i}_{n}" for i, n in reversed(list(enumerate(names)))}
        part = part.select(*(F.col(f"`{own[c]}`").alias(c) if c in own else F.lit(None).cast("string").alias(c) for c in columns), "_file", CORRUPT)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in (*columns, "_file", CORRUPT)]))
    return out


#: Columns of one type from which on they are parsed as one array: code for each by itself is a method too long for the JVM to compile.
WIDE = 9


def typed(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Missing-value tokens become null (not where the source is kept as it came), then the specification's decimals and dates are parsed."""
    types = dict(df.dtypes)
    token = lambda c: not spec.raw and types[c] == "string" and not c.startswith("_")
    alike: dict[tuple, list[str]] = {}
    for c, p in spec.decimals.items():
        if c in types:
            alike.setdefault((types[c], token(c), p), []).append(c)
    wide = {kind: names for kind, names in alike.items() if len(names) >= WIDE}
    rest = [c for c in df.columns if not any(c in names for names in wide.values())]
    out = df.withColumns({c: scalar.null_tokens(F.col(c)) for c in rest if token(c)})
    casts = {c: scalar.to_decimal(F.col(c), *spec.decimals[c]) for c in rest if c in spec.decimals}
    casts |= {c: scalar.to_double(F.col(c)) for c in spec.doubles if c in out.columns}
    casts |= {c: scalar.to_date(F.col(c)) for c in spec.dates if c in out.columns}
    out = out.withColumns(casts)
    for (_, tokens, p), names in wide.items():
        cell = lambda x, tokens=tokens, p=p: scalar.to_decimal(scalar.null_tokens(x) if tokens else x, *p)
        cells = out.withColumn("_cells", F.transform(F.array(*names), lambda x: cell(x)))  # noqa: B023
        out = cells.withColumns({c: F.col("_cells")[i] for i, c in enumerate(names)}).drop("_cells")
    return out


def required(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Rows that have every required field."""
    keep = F.lit(True)
    for c in spec.required:
        keep &= F.col(c).isNotNull()
    return df.where(keep)


def split_rejects(df: DataFrame, keep: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that load and rows that don't."""
    ok = F.coalesce(keep, F.lit(False))
    return df.where(ok), df.where(~ok)


def skip_bad(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Typed columns; rows in which a cell that isn't null fails its cast are left out."""
    keep = F.lit(True)
    for c, kind in casts.items():
        keep &= F.col(c).isNull() | F.col(c).try_cast(kind).isNotNull()
    return df.where(keep).withColumns({c: F.col(c).try_cast(k) for c, k in casts.items()})


def file_symbol(path: Column) -> Column:
    """Symbol of ``.../SYM.json``: the file's name up to its first dot."""
    return F.split_part(F.split_part(path, F.lit("/"), F.lit(-1)), F.lit("."), F.lit(1))


def read_json(spark: SparkSession, path: str, fields: Sequence[str], glob: str = "*.json", whole: bool = False) -> DataFrame:
    """One row a document, one document a line or, with ``whole``, a file; the named top-level fields as text."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return spark.read.schema(schema).option("multiLine", whole).option("pathGlobFilter", glob).json(path).select("*", F.col("_metadata.file_path").alias("_file"))


def read_documents(spark: SparkSession, path: str, glob: str = "*.json", whole: bool = False) -> DataFrame:
    """One row a document as a variant (null if it can't be parsed), with its text and file; documents as for ``read_json``."""
    rows = spark.read.option("wholetext", whole).option("pathGlobFilter", glob).text(path)
    return rows.select(F.try_parse_json("value").alias("doc"), F.col("value").alias("text"), F.col("_metadata.file_path").alias("_file"))
