"""File sources and sinks (S0-S5, K0-K6) on Spark's readers and writers.

Sources are callables ``SparkSession -> DataFrame``; sinks take a DataFrame.
Paths may be globs or directories, so many files are read in parallel.
Parse errors surface with ``mode=FAILFAST`` (at read time for JSON, at the
first action for CSV) and are re-raised as ``SourceError``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import DestinationError, SourceError
from ..functions.columns import q
from ..session import scratch_path

# Tokens that the pandas CSV reader treats as missing by default.
PANDAS_NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
#: how a number is written; Java also takes a type suffix and hexadecimal
NUMBER = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|[iI]nf(inity)?)$"
# Spellings read as booleans.
BOOL_TOKENS = ("True", "False", "true", "false", "TRUE", "FALSE")


def _classify(exc: Exception, path: str) -> SourceError:
    msg = str(exc)
    if "PATH_NOT_FOUND" in msg or "does not exist" in msg.lower():
        return SourceError(f"File not found: {path}")
    if "MALFORMED" in msg or "Malformed" in msg or "FAILFAST" in msg:
        return SourceError(f"Could not parse {path}: {msg.splitlines()[0]}")
    return SourceError(f"Could not read {path}: {msg.splitlines()[0] if msg else exc!r}")


class Source:
    """Contract: ``extract(spark) -> DataFrame``."""

    def extract(self, spark: SparkSession) -> DataFrame:  # pragma: no cover
        raise NotImplementedError

    def __call__(self, spark: SparkSession) -> DataFrame:
        return self.extract(spark)


class Destination:
    """Contract: ``save(df) -> None`` (K0)."""

    def save(self, df: DataFrame) -> None:  # pragma: no cover
        raise NotImplementedError

    def __call__(self, df: DataFrame) -> None:
        self.save(df)


def _typed(df: DataFrame, overrides: dict[str, str] | None) -> DataFrame:
    if not overrides:
        return df
    return df.withColumns({c: F.col(q(c)).cast(t) for c, t in overrides.items() if c in df.columns})


class CSVSource(Source):
    """CSV with a header row.

    Types are inferred the way pandas does it, in one distributed aggregate:
    a column is ``bigint`` if every non-missing value parses as an integer,
    else ``double`` if every value parses as a number, else ``boolean`` for
    True/False spellings, else ``string`` (dates stay strings).  Tokens in
    ``null_tokens`` become NULL.  ``schema_overrides={"a": "int"}`` forces
    types (S4); an explicit ``schema`` skips inference.  Quoted fields follow RFC
    4180: separators, doubled quotes and, with ``multi_line`` (files are then not
    split), line breaks.

    ``header=False``: files without a header row, whose columns are called ``names``, or
    0, 1, ... as pandas does.  ``columns``: only these, in this order; the others are
    neither parsed nor typed.  ``dates``: columns read as timestamps (text that is none
    raises).  ``comment``: lines that start with this character are left out.
    """

    def __init__(self, path: str, sep: str = ",", null_tokens=PANDAS_NULL_TOKENS,
                 schema: T.StructType | str | None = None,
                 schema_overrides: dict[str, str] | None = None, encoding: str = "UTF-8",
                 multi_line: bool = False, header: bool = True, names: list[str] | None = None,
                 columns: list[str] | None = None, dates: list[str] = (), comment: str | None = None):
        self.multi_line = multi_line
        self.header, self.names, self.columns = header, names, columns
        self.dates, self.comment = list(dates), comment
        self.path, self.sep, self.null_tokens = path, sep, tuple(null_tokens)
        self.schema, self.overrides, self.encoding = schema, schema_overrides, encoding

    def extract(self, spark: SparkSession) -> DataFrame:
        try:
            reader = (spark.read.option("header", self.header).option("sep", self.sep)
                      .option("mode", "FAILFAST").option("encoding", self.encoding)
                      .option("quote", '"').option("escape", '"')
                      .option("multiLine", self.multi_line))
            if self.comment:
                reader = reader.option("comment", self.comment)
            if self.schema is not None:
                return self._chosen(reader.schema(self.schema).csv(self.path))
            names = reader.csv(self.path).columns           # first line only
            if self.names is not None or not self.header:
                given = self.names or [str(i) for i in range(len(names))]
                if len(given) != len(names):
                    raise SourceError(f"{len(given)} names for {len(names)} columns of {self.path}")
                names = given
            strings = T.StructType([T.StructField(n, T.StringType()) for n in names])
            raw = reader.schema(strings).csv(self.path)
            raw = raw.select(*[F.when(F.col(q(n)).isin(list(self.null_tokens)), F.lit(None))
                               .otherwise(F.col(q(n))).alias(n) for n in self._wanted(names)])
            return self._chosen(infer_types(raw, exclude={*(self.overrides or ()), *self.dates}))
        except SourceError:
            raise
        except Exception as e:      # missing path, or FAILFAST parse error in the inference job
            raise _classify(e, self.path) from e

    def _wanted(self, names: list[str]) -> list[str]:
        missing = [c for c in [*(self.columns or ()), *self.dates] if c not in names]
        if missing:
            raise SourceError(f"No columns {missing} in {self.path}")
        return list(self.columns) if self.columns is not None else names

    def _chosen(self, df: DataFrame) -> DataFrame:
        df = _typed(df.select(*[F.col(q(c)) for c in self._wanted(df.columns)]), self.overrides)
        return df.withColumns({c: F.col(q(c)).cast("timestamp") for c in self.dates if c in df.columns})


def infer_types(raw: DataFrame, exclude: set[str] = frozenset()) -> DataFrame:
    """Cast string columns to bigint / double / boolean when every value fits."""
    names = [n for n in raw.columns if n not in exclude]
    if not names:
        return raw
    aggs = []
    for i, n in enumerate(names):
        c = F.col(q(n))
        present = c.isNotNull()
        # a Java number may end in D, F or L; such text is no number here
        number = F.trim(c).rlike(NUMBER)
        aggs += [F.count_if(present & ~(number & c.try_cast("bigint").isNotNull())).alias(f"i{i}"),
                 F.count_if(present & ~(number & c.try_cast("double").isNotNull())).alias(f"d{i}"),
                 F.count_if(present & ~c.isin(list(BOOL_TOKENS))).alias(f"b{i}"),
                 F.count(c).alias(f"n{i}")]
    row = raw.agg(*aggs).first()
    casts = {}
    for i, n in enumerate(names):
        if row[f"n{i}"] == 0:
            casts[n] = F.col(q(n)).cast("double")          # all missing: float NaN column in pandas
        elif row[f"i{i}"] == 0:
            casts[n] = F.col(q(n)).cast("bigint")
        elif row[f"d{i}"] == 0:
            casts[n] = F.col(q(n)).cast("double")
        elif row[f"b{i}"] == 0:
            casts[n] = F.lower(F.col(q(n))) == F.lit("true")
    return raw.withColumns(casts)


class JSONSource(Source):
    """JSON records (S2): one array of objects per file (``lines=False``), or
    JSON Lines (``lines=True``, splittable, the choice for large inputs)."""

    def __init__(self, path: str, lines: bool = False, schema=None,
                 schema_overrides: dict[str, str] | None = None):
        self.path, self.lines, self.schema, self.overrides = path, lines, schema, schema_overrides

    def extract(self, spark: SparkSession) -> DataFrame:
        try:
            r = spark.read.option("multiLine", not self.lines).option("mode", "FAILFAST")
            if self.schema is not None:
                r = r.schema(self.schema)
            df = r.json(self.path)
            if "_corrupt_record" in df.columns:
                raise SourceError(f"Could not parse {self.path}")
            return _typed(df, self.overrides)
        except AnalysisException as e:
            raise _classify(e, self.path) from e


class JSONArraySource(Source):
    """A JSON array with one record on a line, in one file or in parts, as
    :class:`JSONArrayDestination` writes it: read by lines, so large files are split.
    Lines with only ``[`` or ``]`` frame the array and are no rows; any other line that
    is no record raises."""

    CORRUPT = "__line"

    def __init__(self, path: str, schema=None, schema_overrides: dict[str, str] | None = None):
        self.path, self.schema, self.overrides = path, schema, schema_overrides

    def extract(self, spark: SparkSession) -> DataFrame:
        line, reader = F.col(self.CORRUPT), spark.read.option("columnNameOfCorruptRecord", self.CORRUPT)
        try:
            if self.schema is not None:
                schema = T.StructType.fromDDL(self.schema) if isinstance(self.schema, str) else self.schema
            else:
                schema = reader.json(self.path).schema
        except AnalysisException as e:
            raise _classify(e, self.path) from e
        fields = [f for f in schema.fields if f.name != self.CORRUPT]
        if not fields:
            raise SourceError(f"No records in {self.path}")
        rows = reader.schema(T.StructType([*fields, T.StructField(self.CORRUPT, T.StringType())])).json(self.path)
        framing = F.regexp_like(line, F.lit(r"^\s*[\[\]]\s*$"))
        # a frame has no fields; naming one keeps the reader from parsing nothing but the line
        wrong = F.raise_error(F.concat(F.lit(f"Could not parse {self.path}: "), F.left(line, F.lit(80))))
        keep = (F.when(line.isNull(), F.lit(True)).when(framing, F.col(q(fields[0].name)).isNotNull())
                .otherwise(wrong.cast("boolean")))
        return _typed(rows.filter(keep).drop(self.CORRUPT), self.overrides)


class ParquetSource(Source):
    def __init__(self, path: str):
        self.path = path

    def extract(self, spark: SparkSession) -> DataFrame:
        try:
            return spark.read.parquet(self.path)
        except AnalysisException as e:
            raise _classify(e, self.path) from e


class _Writer(Destination):
    fmt = "csv"

    def __init__(self, path: str, mode: str = "overwrite", **options):
        self.path, self.mode, self.options = path, mode, options

    def _write(self, df: DataFrame) -> None:
        raise NotImplementedError

    def save(self, df: DataFrame) -> None:
        try:
            self._write(df)
        except Exception as e:  # K6: classify and wrap
            kind = "Permission denied" if "ermission" in str(e) else "Could not write"
            raise DestinationError(f"{kind}: {self.path}: {str(e).splitlines()[0]}") from e


class CSVDestination(_Writer):
    """A directory of CSV part files with a header, overwritten (K1, K4, K5)."""

    def _write(self, df):
        (df.write.mode(self.mode).option("header", True).option("escape", '"').options(**self.options)
         .csv(self.path))


class JSONDestination(_Writer):
    """A directory of JSON Lines part files (K2)."""

    def _write(self, df):
        df.write.mode(self.mode).options(**self.options).json(self.path)


class JSONArrayDestination(_Writer):
    """A directory of text parts that are, one after another in the order of their
    names, one JSON array: a line for each record, behind ``indent`` blanks (K2).

    Rows keep their order and nulls are written.  Only the first and the last record
    differ from the rest, so the numbered rows are stored once below the scratch folder,
    and the numbers' bounds tell which these are; nothing passes through one task.  An
    empty table gives ``[]``.  For data nobody else must read as one array, JSON Lines
    need one pass less.
    """

    def __init__(self, path: str, mode: str = "overwrite", indent: int = 2, **options):
        super().__init__(path, mode, **options)
        self.indent = indent

    def _write(self, df):
        spark, stored = df.sparkSession, scratch_path(df.sparkSession, "json-array")
        record = F.to_json(F.struct(*[F.col(q(c)) for c in df.columns]), {"ignoreNullFields": "false", **self.options})
        df.select(F.monotonically_increasing_id().alias("at"), record.alias("record")).write.parquet(stored)
        rows = spark.read.parquet(stored)
        first, last = rows.agg(F.min("at"), F.max("at")).first()
        if first is None:
            lines = spark.createDataFrame([("[]",)], "line string")
        else:
            line = F.concat(F.when(F.col("at") == first, F.lit("[\n")).otherwise(F.lit("")),
                            F.lit(" " * self.indent), F.col("record"),
                            F.when(F.col("at") == last, F.lit("\n]")).otherwise(F.lit(",")))
            lines = rows.repartitionByRange("at").sortWithinPartitions("at").select(line.alias("line"))
        lines.write.mode(self.mode).text(self.path)


class ParquetDestination(_Writer):
    def _write(self, df):
        df.write.mode(self.mode).options(**self.options).parquet(self.path)


