"""File sources with explicit schemas (nothing inferred)."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stellate import schemas
from stellate.functions.dates import parse_date

# The texts pandas' CSV reader treats as missing by default.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def read_arrivals(spark: SparkSession, path: str,
                  schema: T.StructType = schemas.ARRIVALS, check: bool = False) -> DataFrame:
    """Arrival records from a Parquet folder (partitioned or not).  ``check``
    compares the files' footers with the schema first (``check_schema``)."""
    if check:
        check_schema(spark, path, schema)
    return spark.read.schema(schema).parquet(path)


class SchemaError(ValueError):
    pass


def footer_columns(spark: SparkSession, path: str, threads: int = 16) -> dict[str, dict[str, str]]:
    """{file: {column: type}} of all Parquet files under ``path``, by their
    footers, without the rows: a metadata call a file, many at a time."""
    sc = spark.sparkContext
    jvm, conf = sc._jvm, sc._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(conf)
    found, files = fs.listFiles(root, True), []
    base = fs.makeQualified(root).toString().rstrip("/")
    while found.hasNext():
        p = found.next().getPath()
        parts = p.toString()[len(base):].split("/")
        # Names that Spark passes over when it lists a folder.
        if not any(x.startswith(".") or (x.startswith("_") and "=" not in x) for x in parts if x):
            files.append(p)
    parquet = jvm.org.apache.parquet.hadoop
    convert = jvm.org.apache.spark.sql.execution.datasources.parquet.ParquetToSparkSchemaConverter(
        spark._jsparkSession.sessionState().conf())

    def columns(p) -> tuple[str, dict[str, str]]:
        reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(p, conf))
        try:
            schema = T.StructType.fromJson(json.loads(convert.convert(reader.getFileMetaData().getSchema()).json()))
        finally:
            reader.close()
        return p.toString(), {f.name: f.dataType.simpleString() for f in schema.fields}

    with ThreadPoolExecutor(max_workers=threads) as pool:
        return dict(pool.map(columns, files))


def schema_problems(spark: SparkSession, path: str, schema: T.StructType = schemas.ARRIVALS) -> DataFrame:
    """(file, column, problem, declared, found): what the files' footers say
    against the declared schema.  ``missing``: a declared column that the file
    lacks (an explicit schema reads it as all null); ``undeclared``: a column
    that is read by no one; ``type``: another type.  Columns that the folder
    names hold (``name=value``) aren't missing."""
    declared = {f.name: f.dataType.simpleString() for f in schema.fields}
    rows = []
    for file, columns in sorted(footer_columns(spark, path).items()):
        by_folder = {x.split("=", 1)[0] for x in file.split("/") if "=" in x}
        for name, kind in declared.items():
            if name not in columns:
                if name not in by_folder:
                    rows.append((file, name, "missing", kind, None))
            elif columns[name] != kind:
                rows.append((file, name, "type", kind, columns[name]))
        rows += [(file, name, "undeclared", None, kind) for name, kind in columns.items() if name not in declared]
    return spark.createDataFrame(rows, "file string, column string, problem string, declared string, found string")


def check_schema(spark: SparkSession, path: str, schema: T.StructType = schemas.ARRIVALS) -> None:
    """Raise SchemaError naming the columns that are missing from a file or of
    another type there."""
    bad = schema_problems(spark, path, schema).where("problem <> 'undeclared'").collect()
    if bad:
        told = ", ".join(f"{r['column']} ({r['problem']} in {r['file']})" for r in bad[:20])
        raise SchemaError(f"{len(bad)} columns don't fit the declared schema: {told}")


MALFORMED = ("null", "drop", "raise")
BROKEN = ("keep", "drop", "raise")
TOO_FEW, TOO_MANY = "too_few_fields", "too_many_fields"
_RECORD = "__record"


def _parsed(c, dtype: T.DataType, malformed: str):
    """A text value in its type.  ``raise`` fails the task on a malformed one."""
    if isinstance(dtype, T.StringType):
        return c
    value = c.try_cast(dtype)
    if malformed != "raise":
        return value
    error = F.raise_error(F.concat(F.lit(f"malformed {dtype.simpleString()}: "), c)).cast(dtype)
    return F.when(c.isNotNull() & value.isNull(), error).otherwise(value)


def _records(spark: SparkSession, path: str, schema: T.StructType, options: dict) -> DataFrame:
    """All columns as text, and the record itself where its number of fields
    isn't the schema's.  Every field is parsed, whatever columns are used, as a
    record can't be told to be broken by some of its fields."""
    names = [*schema.fieldNames(), _RECORD]
    text_schema = T.StructType([T.StructField(n, T.StringType(), True) for n in names])
    raw = (spark.read.options(**options).option("nullValue", "\u0000").option("columnPruning", "false")
           .option("columnNameOfCorruptRecord", _RECORD).schema(text_schema).csv(path))
    # Spark refuses a query of the record alone: always true, and it uses a field.
    return raw.where(F.coalesce(F.length(F.col(f"`{names[0]}`")), F.lit(0)) >= 0)


def _n_fields(record, sep: str, quote: str):
    """Fields of a record: separators outside of quotes, and one."""
    q = re.escape(quote)
    bare = F.regexp_replace(F.regexp_replace(record, f"{q}[^{q}]*{q}", ""), f"{q}.*$", "")
    return F.size(F.split(bare, re.escape(sep), -1))


def broken_rows(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ",", header: bool = True,
                encoding: str = "UTF-8", quote: str = '"', escape: str = '"') -> DataFrame:
    """(file, defect, n_fields, record): the records with too few or too many
    fields, as they stand in the file."""
    raw = _records(spark, path, schema, _options(sep, header, encoding, quote, escape))
    n = _n_fields(F.col(_RECORD), sep, quote)
    return raw.where(F.col(_RECORD).isNotNull()).select(
        F.col("_metadata.file_path").alias("file"),
        F.when(n < len(schema), TOO_FEW).otherwise(TOO_MANY).alias("defect"), n.alias("n_fields"),
        F.col(_RECORD).alias("record"))


def count_broken(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ",", header: bool = True,
                 encoding: str = "UTF-8", quote: str = '"', escape: str = '"') -> DataFrame:
    """(defect, n_rows, n_bad): records with too few and with too many fields.
    One pass."""
    raw = _records(spark, path, schema, _options(sep, header, encoding, quote, escape))
    record = F.col(_RECORD)
    few = _n_fields(record, sep, quote) < len(schema)
    sums = raw.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(record.isNotNull() & few).alias("few"),
        F.count_if(record.isNotNull() & ~few).alias("many"))
    return sums.select(F.inline(F.array(*[F.struct(F.lit(d).alias("defect"), F.col("n_rows"), F.col(c).alias("n_bad"))
                                          for d, c in ((TOO_FEW, "few"), (TOO_MANY, "many"))])))


def _texts(spark: SparkSession, path: str, schema: T.StructType, null_tokens: Sequence[str],
           options: dict, broken: str = "keep") -> DataFrame:
    """All columns as text, null tokens as null."""
    if broken not in BROKEN:
        raise ValueError(f"broken must be one of {BROKEN}, not {broken!r}")
    if broken == "keep":
        text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
        # emptyValue stays "" so an empty field is a token like the others.
        raw = spark.read.options(**options).option("nullValue", "\u0000").schema(text_schema).csv(path)
    else:
        raw, record = _records(spark, path, schema, options), F.col(_RECORD)
        # A filter, as a column that raises could be pruned away.
        raw = raw.where(record.isNull() if broken == "drop" else F.when(record.isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("wrong number of fields: "), record)).cast("boolean")))
    return raw.select(*[F.when(~F.col(f"`{f.name}`").isin(*(tuple(null_tokens) or ("",))),
                               F.col(f"`{f.name}`")).alias(f.name) for f in schema.fields])


def _options(sep: str, header: bool, encoding: str, quote: str, escape: str) -> dict:
    return {"header": header, "sep": sep, "encoding": encoding, "quote": quote, "escape": escape,
            "mode": "PERMISSIVE"}


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, *,
                   sep: str = ",", header: bool = True,
                   null_tokens: Sequence[str] = ("",), encoding: str = "UTF-8",
                   quote: str = '"', escape: str = '"', malformed: str = "null",
                   broken: str = "keep") -> DataFrame:
    """Delimited text with a declared schema.

    Spark's reader knows one null text only, so the file is read as text, the
    ``null_tokens`` become null and the values are then cast.  ``malformed``
    says what becomes of a value that isn't of its type: ``null`` (the value
    is lost), ``drop`` (its row is left out) or ``raise`` (the job fails);
    ``count_malformed`` counts them.  ``broken`` says the same of a record with
    too few or too many fields: ``keep`` (filled with nulls or cut), ``drop`` or
    ``raise``; ``count_broken`` counts them and ``broken_rows`` lists them.
    """
    if malformed not in MALFORMED:
        raise ValueError(f"malformed must be one of {MALFORMED}, not {malformed!r}")
    texts = _texts(spark, path, schema, null_tokens, _options(sep, header, encoding, quote, escape), broken)
    if malformed == "drop":
        for f in schema.fields:
            c = F.col(f"`{f.name}`")
            if not isinstance(f.dataType, T.StringType):
                texts = texts.where(c.isNull() | c.try_cast(f.dataType).isNotNull())
    return texts.select(*[_parsed(F.col(f"`{f.name}`"), f.dataType, malformed).alias(f.name)
                          for f in schema.fields])


def count_malformed(spark: SparkSession, path: str, schema: T.StructType, *, sep: str = ",", header: bool = True,
                    null_tokens: Sequence[str] = ("",), encoding: str = "UTF-8", quote: str = '"',
                    escape: str = '"', dates: Sequence[str] = (), broken: str = "keep") -> DataFrame:
    """(column, n_rows, n_bad): values of each column that are not of its type;
    columns in ``dates`` are text that should hold a date.  One pass."""
    texts = _texts(spark, path, schema, null_tokens, _options(sep, header, encoding, quote, escape), broken)
    bad = {}
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in dates:
            bad[f.name] = c.isNotNull() & parse_date(c).isNull()
        elif not isinstance(f.dataType, T.StringType):
            bad[f.name] = c.isNotNull() & c.try_cast(f.dataType).isNull()
    sums = texts.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(b).alias(f"__{i}") for i, b in enumerate(bad.values())])
    rows = F.array(*[F.struct(F.lit(n).alias("column"), F.col("n_rows"), F.col(f"__{i}").alias("n_bad"))
                     for i, n in enumerate(bad)])
    return sums.select(F.inline(rows))


def read_demographics(spark: SparkSession, path: str, *,
                      null_tokens: Sequence[str] = PANDAS_NULL_TOKENS,
                      malformed: str = "drop", broken: str = "drop", header: bool = True) -> DataFrame:
    """A missing count means 0 later on, so a malformed one must not become
    null: its row is left out (and counted by ``demographics_rejects``), as is
    a record with too few or too many fields (``demographics_broken``)."""
    return read_delimited(spark, path, schemas.DEMOGRAPHICS, sep=";", header=header,
                          null_tokens=null_tokens, malformed=malformed, broken=broken)


def demographics_rejects(spark: SparkSession, path: str, *,
                         null_tokens: Sequence[str] = PANDAS_NULL_TOKENS) -> DataFrame:
    return count_malformed(spark, path, schemas.DEMOGRAPHICS, sep=";", null_tokens=null_tokens, broken="drop")


def demographics_broken(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return count_broken(spark, path, schemas.DEMOGRAPHICS, sep=";", header=header)


def read_temperatures(spark: SparkSession, path: str, *,
                      null_tokens: Sequence[str] = PANDAS_NULL_TOKENS,
                      malformed: str = "null", broken: str = "drop") -> DataFrame:
    return read_delimited(spark, path, schemas.TEMPERATURES, sep=",",
                          null_tokens=null_tokens, malformed=malformed, broken=broken)


def temperatures_rejects(spark: SparkSession, path: str, *,
                         null_tokens: Sequence[str] = PANDAS_NULL_TOKENS) -> DataFrame:
    return count_malformed(spark, path, schemas.TEMPERATURES, null_tokens=null_tokens, dates=["dt"], broken="drop")


def temperatures_broken(spark: SparkSession, path: str) -> DataFrame:
    return count_broken(spark, path, schemas.TEMPERATURES)


def read_airport_codes(spark: SparkSession, path: str, *,
                       null_tokens: Sequence[str] = PANDAS_NULL_TOKENS) -> DataFrame:
    return read_delimited(spark, path, schemas.AIRPORT_CODES, sep=",",
                          null_tokens=null_tokens)


_LOOKUPS = {
    "country": (schemas.COUNTRY_LOOKUP_RAW, "int"),
    "port": (schemas.PORT_LOOKUP_RAW, None),
    "state": (schemas.STATE_LOOKUP_RAW, None),
}


def clean_label(c) -> F.Column:
    """Trim blanks and drop a trailing ';' left over from the code book."""
    return F.trim(F.regexp_replace(c, r"\s*;\s*$", ""))


def read_lookup(spark: SparkSession, path: str, kind: str, *, clean: bool = True,
                null_tokens: Sequence[str] = PANDAS_NULL_TOKENS) -> DataFrame:
    """A code lookup CSV (country / port / state).

    ``clean`` trims codes and labels and removes a trailing ``;``; the country
    code becomes INT.  ``clean=False`` keeps labels byte for byte (padding and
    all) and only parses the code.
    """
    schema, code_type = _LOOKUPS[kind]
    raw = read_delimited(spark, path, schema, sep=",", null_tokens=null_tokens)
    code_name, label_name = schema.fieldNames()
    code, label = F.col(code_name), F.col(label_name)
    if clean:
        code, label = F.trim(code), clean_label(label)
    if code_type:
        code = F.trim(code).try_cast(code_type)
    return raw.select(code.alias(code_name), label.alias(label_name))


def ambiguous_labels(lookup: DataFrame, code: str, label: str) -> DataFrame:
    """(label, n_codes, first_code, last_code) of labels with several codes:
    each of them multiplies the rows that a lookup join finds."""
    return (lookup.where(F.col(label).isNotNull()).groupBy(F.col(label).alias("label"))
            .agg(F.count_distinct(code).alias("n_codes"), F.min(code).cast("string").alias("first_code"),
                 F.max(code).cast("string").alias("last_code"))
            .where("n_codes > 1"))
