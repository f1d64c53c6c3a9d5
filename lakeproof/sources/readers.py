"""Readers: raw CSV batches, Parquet layers, report history, catalog, preview."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeproof.contract import MSG_LAYER_NOT_FOUND, MSG_NO_REPORTS, PREVIEW_DEFAULT_LIMIT
from lakeproof.operators.quality import REPORT_DDL


def read_raw(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
             infer: bool = False, header: bool = True, sampling_ratio: float = 1.0) -> DataFrame:
    """A raw CSV batch with a header row.

    Default: every column as text (no inference pass over the data; typing is
    done leniently in Silver). ``schema`` declares types
    by column name; cells that don't fit are NULL. ``infer`` reproduces type inference, which costs an extra scan of the input
    (``sampling_ratio`` < 1 infers from a sample of the rows instead; the
    types may then differ from a full inference).

    In a folder of several files every header must be the first one's: a file
    with other columns, or another order of them, is refused when it is read,
    as its values would land in the wrong columns.
    """
    reader = spark.read.option("header", header).option("mode", "PERMISSIVE")
    if header and not infer:
        first = reader.csv(path)
        if len(first.inputFiles()) > 1:
            reader = reader.schema(first.schema).option("enforceSchema", False)
    if schema is not None:
        fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
        raw = reader.csv(path)
        declared = {f.name: f.dataType for f in fields}
        # columns go by the header's names, so one that the file lacks stays missing
        return raw.select(*[F.col(f"`{n}`") for n in raw.columns if n not in declared],
                          *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in fields
                            if f.name in raw.columns])
    if infer:
        reader = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    return reader.csv(path)


RAW_LINE = "__raw_line"


def read_raw_checked(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A raw CSV batch as text columns, with every malformed line as it
    stands in ``RAW_LINE`` (null for a well-formed one).

    ``columns`` names the columns of files without a header row. Malformed is
    a line with more or fewer fields than columns, or with an open quote;
    ``read_raw`` would cut or pad it silently. Blank lines are no records.
    """
    reader = spark.read.option("header", columns is None).option("mode", "PERMISSIVE")
    if columns is None:
        first = reader.csv(path)
        columns = first.columns
        if len(first.inputFiles()) > 1:
            reader = reader.option("enforceSchema", False)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, RAW_LINE]])
    return reader.schema(schema).option("columnNameOfCorruptRecord", RAW_LINE).csv(path)


def well_formed(checked: DataFrame) -> DataFrame:
    """The records whose line was well-formed."""
    return checked.where(F.col(RAW_LINE).isNull()).drop(RAW_LINE)


def malformed(checked: DataFrame, separator: str = ",") -> DataFrame:
    """(raw_line, n_fields, reason) of the malformed lines.

    ``checked`` has to be a written table (Spark does not read the raw line
    alone from CSV). Fields are counted outside quotes.
    """
    expected = len(checked.columns) - 1
    bare = F.regexp_replace(RAW_LINE, r'"(\\.|[^"\\])*"', "")
    n_fields = F.length(bare) - F.length(F.replace(bare, F.lit(separator))) + 1
    reason = (F.when(F.contains(bare, F.lit('"')), "open quote").when(n_fields > expected, "too many fields")
              .when(n_fields < expected, "too few fields").otherwise("unreadable"))
    return checked.where(F.col(RAW_LINE).isNotNull()).select(
        F.col(RAW_LINE).alias("raw_line"), n_fields.cast("int").alias("n_fields"), reason.alias("reason"))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet layer; filters and projections reach the scan."""
    return spark.read.parquet(path)


def _newest_first() -> list:
    """Both layouts name a batch by its time; only its digits are compared."""
    return [F.rpad(F.regexp_replace("batch_id", "[^0-9]", ""), 20, "0").desc(), F.col("batch_id").desc()]


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """Report history: one row per batch with ``batch_id``, newest first.

    Reads both the engine's layout (``batch_id=...`` folders of JSON lines)
    and plain folders of one pretty-printed JSON document per file, whose
    file name then serves as the batch id.
    """
    schema = T.StructType.fromDDL(REPORT_DDL)
    try:
        df = (spark.read.schema(schema).option("multiLine", True)
              .option("recursiveFileLookup", True).json(path))
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{MSG_NO_REPORTS} ({path})") from exc
    if not df.inputFiles():
        raise FileNotFoundError(f"{MSG_NO_REPORTS} ({path})")
    file_path = F.col("_metadata.file_path")
    from_folder = F.regexp_extract(file_path, r"batch_id=([^/]+)/", 1)
    from_name = F.regexp_extract(file_path, r"([^/]+)\.json$", 1)
    batch = F.when(from_folder != "", from_folder).otherwise(from_name)
    return df.select(batch.alias("batch_id"), *schema.fieldNames()).orderBy(*_newest_first())


def select_report(reports: DataFrame, batch_id: str | None = None) -> DataFrame:
    """One batch of the history; the newest when no id is given."""
    if batch_id is not None:
        return reports.filter(F.col("batch_id") == batch_id)
    return reports.orderBy(*_newest_first()).limit(1)


CATALOG_FIELDS = ["coluna", "tipo", "obrigatorio", "regras_dq", "descricao"]


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Catalog document -> (layer, layer_position, position, coluna, tipo, obrigatorio, regras_dq, descricao).

    Layer names are dynamic keys, so the document is parsed as a map and
    exploded twice. The catalog is a small configuration file read whole.
    """
    doc = spark.read.text(path, wholetext=True)
    parsed = doc.select(F.from_json("value", "map<string, array<map<string, string>>>").alias("m"))
    layers = parsed.select(F.posexplode(F.map_entries("m")).alias("layer_position", "e"))
    rows = layers.select("layer_position", F.col("e.key").alias("layer"),
                         F.posexplode(F.col("e.value")).alias("position", "rec"))
    return rows.select("layer", "layer_position", "position",
                       *[F.col("rec").getItem(f).alias(f) for f in CATALOG_FIELDS])


def preview(spark: SparkSession, path: str, limit: int = PREVIEW_DEFAULT_LIMIT,
            order_by: list[str] | None = None) -> DataFrame:
    """The first ``limit`` rows of a layer, in no particular order.

    With ``order_by`` the rows are the first under that order (planned as a
    per-partition top-k, never a full sort).
    """
    if limit <= 0:
        raise ValueError("limit must be positive")
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"{MSG_LAYER_NOT_FOUND} ({path})") from exc
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(limit)
