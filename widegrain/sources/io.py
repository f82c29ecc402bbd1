"""Sources and sinks (S1-S17): typed CSV scans (keys always text), the
two-header-row CSV, table/view publishing with guards and fall-backs, table
fingerprints, schema audits and model persistence.

Everything writes to / reads from paths the caller names; scratch output of
the library goes under the shared ``spark.checkpoint.dir`` (never a
machine-local temp folder).
"""

from __future__ import annotations

import csv
import uuid
import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..session import ensure_checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/widegrain-{name}-{uuid.uuid4().hex[:12]}"


# --------------------------------------------------------------------------- #
# S1 / S2 scans
# --------------------------------------------------------------------------- #

#: fixed values: texts that stand for a missing value
NULL_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A",
              "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def _numbers_beside_nulls(df: DataFrame, texts: Sequence[str]) -> DataFrame:
    """Text columns whose values are all numbers once the null texts are gone,
    as numbers (one aggregate over those columns decides)."""
    if not texts:
        return df
    seen = df.agg(*[x for i, c in enumerate(texts) for x in (
        F.count(c).alias(f"n{i}"), F.count(F.col(c).try_cast("bigint")).alias(f"i{i}"),
        F.count(F.col(c).try_cast("double")).alias(f"d{i}"))]).first()
    kinds = {c: "bigint" if seen[f"i{i}"] == seen[f"n{i}"] else "double" for i, c in enumerate(texts)
             if seen[f"n{i}"] and seen[f"d{i}"] == seen[f"n{i}"]}
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in kinds.items()}) if kinds else df


def read_csv(spark: SparkSession, path: str, key_cols: Sequence[str] = (), schema: StructType | None = None,
             nan_value: str = "NaN", sampling_ratio: float = 1.0) -> DataFrame:
    """CSV scan with header, inferred types and string-typed keys.

    With no explicit schema, types are inferred (from a ``sampling_ratio``
    sample; pass ``schema`` for very large inputs to skip the inference pass),
    the key columns are forced to string, and the file is read with that
    explicit schema (so leading zeros survive). ``NULL_TEXTS`` such as ``NaN``
    and ``NA`` are nulls, as in pandas.
    """
    opts = {"header": "true", "nullValue": nan_value, "nanValue": nan_value, "mode": "PERMISSIVE"}
    inferred = None
    if schema is None:
        inferred = (spark.read.options(**opts).option("inferSchema", "true")
                    .option("samplingRatio", sampling_ratio).csv(path).schema)
        schema = StructType([StructField(f.name, StringType() if f.name in set(key_cols) else f.dataType, True)
                             for f in inferred.fields])
    df = spark.read.options(**opts).schema(schema).csv(path)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, StringType)]
    df = df.withColumns({c: F.when(~F.trim(F.col(c)).isin(*NULL_TEXTS), F.col(c)) for c in texts}) if texts else df
    if inferred is not None:
        df = _numbers_beside_nulls(df, [c for c in texts if c not in set(key_cols)])
        schema = df.schema
    double_cols = [f.name for f in schema.fields if f.dataType.simpleString() in ("double", "float")]
    if double_cols:
        df = df.select(*[F.nanvl(F.col(c), F.lit(None)).alias(c) if c in double_cols else F.col(c)
                         for c in df.columns])
    return df


def write_two_header_csv(df: DataFrame, path: str, human_names: Mapping[str, str] | None = None) -> None:
    """Write a CSV whose first header row holds human names and whose second
    row holds the column codes (the layout S2 reads)."""
    human = human_names or {c: c.replace("_", " ").title() for c in df.columns}
    spark = df.sparkSession
    codes = spark.range(1, numPartitions=1).select(*[F.lit(c).alias(c) for c in df.columns])
    body = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])
    out = codes.unionByName(body).select(*[F.col(c).alias(human[c]) for c in df.columns])
    out.write.mode("overwrite").option("header", "true").csv(path)


def read_two_header_csv(spark: SparkSession, path: str, key_cols: Sequence[str] = (),
                        numeric: bool = True) -> DataFrame:
    """CSV with two header rows (S2): the first (human names) is skipped, the
    second names the columns.

    The second line is read with ``spark.read.text(...).limit(2)``; the data
    is read as all-string with those names; the codes row (kept as data by
    Spark) is removed; then, as a two-phase plan, every non-key column whose
    non-null values all parse as numbers is ``try_cast`` to double (one
    profile aggregate decides)."""
    first_file = sorted(spark.read.text(path).inputFiles())[0]   # the file holding both header rows
    lines = [r[0] for r in spark.read.text(first_file).limit(2).collect()]
    if len(lines) < 2:
        raise ValueError(f"{path}: fewer than two header rows")
    codes = next(csv.reader([lines[1]]))
    schema = StructType([StructField(c, StringType(), True) for c in codes])
    raw = spark.read.option("header", "true").schema(schema).csv(path)
    first = codes[0]
    raw = raw.where(~(F.col(first).eqNullSafe(F.lit(first)) & F.col(codes[-1]).eqNullSafe(F.lit(codes[-1]))))
    raw = raw.select(*[F.when(~F.trim(F.col(c)).isin(*NULL_TEXTS), F.col(c)).alias(c) for c in codes])
    if not numeric:
        return raw
    cand = [c for c in codes if c not in set(key_cols)]
    prof = raw.agg(*[F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(f"b{i}")
                     for i, c in enumerate(cand)]).first()
    num = {c for i, c in enumerate(cand) if prof[f"b{i}"] == 0}
    return raw.select(*[F.col(c).try_cast("double").alias(c) if c in num else F.col(c) for c in codes])


def source_filter(df: DataFrame, column: str, value) -> DataFrame:
    """Source-side predicate (S10): Parquet pushes it into the scan."""
    return df.where(F.col(column) == F.lit(value))


def select_variables(df: DataFrame, column: str, variables: Sequence[str]) -> DataFrame:
    """Named variables of a long fact table."""
    return df.where(F.col(column).isin(list(variables)))


# --------------------------------------------------------------------------- #
# S4-S9, S12 catalog, publishing, guards
# --------------------------------------------------------------------------- #

def write_files(df: DataFrame, path: str, fmt: str = "parquet", sort_by: Sequence[str] = ()) -> None:
    """File sink, overwrite (S6, S17). Sorting happens here, at the sink, only."""
    out = df.orderBy(*sort_by) if sort_by else df
    w = out.write.mode("overwrite")
    (w.option("header", "true").csv(path) if fmt == "csv" else w.format(fmt).save(path))


def publish(spark: SparkSession, tables: Mapping[str, DataFrame], managed: bool = False) -> list[str]:
    """Publish tables (S7, C6): managed tables (``saveAsTable``, replace) or
    temp views; returns the names."""
    for name, df in tables.items():
        if managed:
            df.write.mode("overwrite").saveAsTable(name)
        else:
            df.createOrReplaceTempView(name)
    return list(tables)


def replace_table(spark: SparkSession, name: str, df: DataFrame, folder: str) -> str:
    """A persisted table under ``folder`` that is replaced as a whole (S7): the
    rows are written as a new version, a table of the catalog of its own, and
    the view ``name`` is switched to it in one step, so a reader sees the old
    rows or the new ones and a failed write changes nothing. Versions before
    the last one leave the catalog. Returns the version's table."""
    version = f"{name}_v{uuid.uuid4().hex[:12]}"
    df.write.option("path", f"{folder.rstrip('/')}/{version}").saveAsTable(version)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {version}")
    for t in spark.catalog.listTables():
        if t.name.lower().startswith(f"{name.lower()}_v") and t.name.lower() != version.lower():
            spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    return version


def create_views(spark: SparkSession, master: str, benchmark: str, key: str, prefix: str = "") -> list[str]:
    """The three published views (S9): two pass-through views and one left
    join that names the key once (``USING``), so no duplicate key column."""
    views = {
        f"{prefix}master_analysis_view": f"SELECT * FROM {master}",
        f"{prefix}modeling_view": f"SELECT * FROM {master}",
        f"{prefix}exploration_view": f"SELECT * FROM {master} m LEFT JOIN {benchmark} c USING ({key})",
    }
    for name, sql in views.items():
        spark.sql(sql).createOrReplaceTempView(name)
    return list(views)


def list_tables(spark: SparkSession) -> DataFrame:
    """Catalog listing (S5) as a DataFrame (name, is_temporary)."""
    rows = [(t.name, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    return spark.createDataFrame(rows, "name string, is_temporary boolean")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """Full table scan from the catalog."""
    return spark.table(name)


def require_tables(spark: SparkSession, names: Sequence[str]) -> None:
    """Required-source guard (S12): raise with the missing names."""
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise FileNotFoundError(f"required tables missing: {missing}")


def existing_only(spark: SparkSession, names: Sequence[str]) -> list[str]:
    """Optional sources: keep the ones present and warn of the others."""
    there = [n for n in names if spark.catalog.tableExists(n)]
    for n in names:
        if n not in there:
            warnings.warn(f"optional table {n} is missing and left out", stacklevel=2)
    return there


def bootstrap_tables(spark: SparkSession, loaders: Mapping[str, Callable[[], DataFrame]],
                     fallbacks: Mapping[str, str] | None = None, folder: str | None = None) -> dict[str, str]:
    """Create missing tables from their loaders; when a table exists but is
    empty, fall back to the named alternative (S8). With ``folder`` they are
    persisted there (``replace_table``), else temporary views of the session.
    Returns name -> source."""
    used = {}
    for name, load in loaders.items():
        if not spark.catalog.tableExists(name):
            if folder is not None:
                replace_table(spark, name, load(), folder)
            else:
                load().createOrReplaceTempView(name)
            used[name] = "loaded"
        else:
            used[name] = "existing"
        if fallbacks and name in fallbacks and spark.table(name).limit(1).count() == 0:
            if folder is not None:
                spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {fallbacks[name]}")
            else:
                spark.table(fallbacks[name]).createOrReplaceTempView(name)
            used[name] = f"fallback:{fallbacks[name]}"
    return used


# --------------------------------------------------------------------------- #
# S13-S15 fingerprints, audits, dimensions
# --------------------------------------------------------------------------- #

def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None, method: str = "xxhash64") -> DataFrame:
    """Order-insensitive content fingerprint (S13): row count, XOR and sum of a
    per-row digest (the sum keeps duplicate pairs, which XOR would cancel).
    Every value enters with its place and whether it is null, so no two
    different rows are spelled alike.

    ``xxhash64`` is the fast JVM default; ``md5`` uses the first 12 hex digits
    of the md5 of the values' texts, each with its length in front (``-`` for
    null) and joined by ``|`` (reproducible in any SQL engine)."""
    cols = list(cols) if cols is not None else df.columns
    if method == "md5":
        values = [F.col(c).cast("string") for c in cols]
        txt = F.concat_ws("|", *[F.coalesce(F.concat(F.length(v).cast("string"), F.lit(":"), v), F.lit("-")) for v in values])
        h = F.conv(F.substring(F.md5(txt), 1, 12), 16, 10).cast("long")
    else:
        h = F.xxhash64(*[x for i, c in enumerate(cols) for x in (F.lit(i), F.col(c).isNull(), F.col(c))])
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor(h).alias("digest_xor"),
                  F.sum(h.cast("decimal(38,0)")).cast("string").alias("digest_sum"))


def schema_audit(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Column audit of tables without reading rows (S14): (table_name,
    position, column_name, dtype) from the schemas only."""
    rows = [(t, i + 1, f.name, f.dataType.simpleString()) for t, df in frames.items()
            for i, f in enumerate(df.schema.fields)]
    spark = next(iter(frames.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, dtype string")


def dimensions(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns per table (S15): one count aggregate per table,
    combined with ``unionByName``."""
    out = None
    for name, df in frames.items():
        d = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        out = d if out is None else out.unionByName(d)
    return out


# --------------------------------------------------------------------------- #
# S16 model persistence
# --------------------------------------------------------------------------- #

def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_pipeline_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def verify_reload(model, path: str, df: DataFrame, label: str, tol: float = 1e-9) -> DataFrame:
    """Persist, reload and check the reloaded model reproduces the metrics (S16):
    rows (metric, original, reloaded, ok)."""
    from ..models.pipeline import regression_metrics
    save_model(model, path)
    back = load_pipeline_model(path)
    a = regression_metrics(model.transform(df), label).first()
    b = regression_metrics(back.transform(df), label).first()
    rows = [(m, float(a[m]), float(b[m]), abs(float(a[m]) - float(b[m])) <= tol) for m in ("r2", "rmse", "mae")]
    return df.sparkSession.createDataFrame(rows, "metric string, original double, reloaded double, ok boolean")
