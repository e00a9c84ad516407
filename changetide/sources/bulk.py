"""Bulk files as initial snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.changes import DELETING_OP
from ..spec import (
    BROKER_TS, COMMITTED, DELETE, DELETED, KIND, OFFSET, OP, ORDER_PRODUCTS, ORDERS, PARTIAL, PARTITION,
    PRODUCTS, REASON, REJECT, SHOP_TABLES, SOURCE_TS, TABLE, UPSERT, VALUE, TableSpec,
)
from .paths import first_existing, input_files, written

# Fixed value: how many more rows a limit allows for the line items.
LINES_PER_ORDER = 3

# Source time of a snapshot whose time of export is not known.
BEFORE_ALL = 0

_FILE, _SPLIT, _PLACE, _FIRST, _BEFORE = "__file", "__split", "__place", "__first", "__before"
_LINE = "__line"

# Why a line, a row or a cell of a file was not taken over.
BAD_LINE, NO_KEY, BAD_CELL = "malformed", "null_key", "unreadable"


def _reader(spark: SparkSession) -> DataFrameReader:
    return spark.read.option("header", True).option("escape", '"')


def _lines(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The cells of every line as text, and the line itself where it has too many or too few of them.

    All cells are parsed, as a line is otherwise not seen to be damaged.
    """
    whole = T.StructType([*schema.fields, T.StructField(_LINE, T.StringType())])
    return (_reader(spark).schema(whole).option("columnNameOfCorruptRecord", _LINE)
            .option("columnPruning", False).csv(path))


def _placed(text: DataFrame, schema: T.StructType, lenient: bool) -> DataFrame:
    """Declared columns by header name, read as their types, and each row's place in the files."""
    present = set(text.columns)
    read = Column.try_cast if lenient else Column.cast
    return text.select(
        *[read(F.col(f.name), f.dataType).alias(f.name) for f in schema if f.name in present],
        F.col("_metadata.file_path").alias(_FILE),
        F.col("_metadata.file_block_start").alias(_SPLIT),
        F.monotonically_increasing_id().alias(_PLACE))


def _fit(spark: SparkSession, path: str | list[str], schema: T.StructType, spec: TableSpec, lenient: bool) -> DataFrame:
    """The cells of the lines to load: of all, or of those that have all their cells, and a key if the file has one."""
    if not lenient:
        return _reader(spark).schema(schema).csv(path)
    lines = _lines(spark, path, schema)
    return lines.filter(_whole(lines, spec))


def _whole(lines: DataFrame, spec: TableSpec) -> Column:
    whole = F.col(_LINE).isNull()
    if spec.pk not in lines.columns:
        # Spark refuses to look for damaged lines alone, so a cell is looked at as well.
        return whole & (F.coalesce(F.length(lines.columns[0]), F.lit(0)) >= 0)
    return whole & F.col(spec.pk).try_cast(spec.schema[spec.pk].dataType).isNotNull()


def _opening_files(text: DataFrame, spec: TableSpec, limit: int, lenient: bool) -> list[str]:
    """The first files, in path order, that together hold at least ``limit`` rows to load.

    Twice as many files are counted at each step, so the rest of a large folder is not read.
    """
    paths, taken, rows = sorted(input_files(text)), 0, 0
    while rows < limit and taken < len(paths):
        following = paths[taken:max(1, 2 * taken)]
        rows += _fit(text.sparkSession, following, text.schema, spec, lenient).count()
        taken += len(following)
    return paths[:taken]


def _rows_before() -> Column:
    """Rows in the splits before each one; the frame has one row per split."""
    earlier = Window.orderBy(_FILE, _SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("n").over(earlier), F.lit(0))


def _opening_splits(placed: DataFrame, limit: int) -> DataFrame:
    """Whole splits from the start that hold at least ``limit`` rows, or all.

    The end is a place in a file, so it holds even if the files are split otherwise when
    they are read again.
    """
    splits = placed.groupBy(_FILE, _SPLIT).agg(F.count("*").alias("n"))
    beyond = splits.withColumn(_BEFORE, _rows_before()).filter(F.col(_BEFORE) >= limit)
    end = beyond.agg(F.min(F.struct(_FILE, _SPLIT))).scalar()
    return placed.filter(F.coalesce(F.struct(_FILE, _SPLIT) < end, F.lit(True)))


def number_rows(placed: DataFrame, number: str) -> DataFrame:
    """Number rows 1, 2, 3 ... in file order, without sorting them or moving them to one task.

    ``placed`` comes from :func:`_placed`. Each file split counts its rows; a running sum
    over these counts, one per split, tells every split where its numbers begin. The rows
    are stored first, so that both steps see the same splits.
    """
    rows = written(placed, "numbered")
    splits = rows.groupBy(_FILE, _SPLIT).agg(
        F.min(_PLACE).alias(_FIRST), F.count("*").alias("n"))
    starts = splits.select(_FILE, _SPLIT, _FIRST, _rows_before().alias(_BEFORE))
    return rows.join(starts, [_FILE, _SPLIT]).select(
        (F.col(_BEFORE) + F.col(_PLACE) - F.col(_FIRST) + 1).alias(number),
        *[c for c in placed.columns if c not in (_FILE, _SPLIT, _PLACE)])


def load_csv(spark: SparkSession, candidates: list[str], spec: TableSpec,
             limit: int | None = None, lenient: bool = False) -> DataFrame:
    """Rows of the first candidate file that exists, in the table's columns.

    Columns the file lacks take the table's defaults; a missing integer key is numbered
    in file order. With ``limit`` the first rows in file order are kept. No file, no rows.
    An unreadable cell is an error. A ``lenient`` load goes on: it leaves out lines with too many or too few cells
    and rows without a readable key, makes other unreadable cells NULL, and :func:`csv_rejects` tells all of them.
    """
    path = first_existing(spark, candidates)
    if path is None:
        return spark.createDataFrame([], spec.schema)
    text = _reader(spark).csv(path)
    if limit is not None or lenient:
        files = path if limit is None else _opening_files(text, spec, limit, lenient)
        text = _fit(spark, files, text.schema, spec, lenient)
    rows = _placed(text, spec.schema, lenient)
    if limit is not None or spec.pk not in rows.columns:
        rows = number_rows(rows if limit is None else _opening_splits(rows, limit), "__number")
        if limit is not None:
            rows = rows.filter(F.col("__number") <= limit)
        if spec.pk not in rows.columns:
            rows = rows.withColumn(spec.pk, F.col("__number"))
    present = set(rows.columns)
    return rows.select(*[
        (F.col(f.name) if f.name in present else F.lit(spec.defaults.get(f.name)))
        .cast(f.dataType).alias(f.name) for f in spec.schema])


def csv_rejects(spark: SparkSession, candidates: list[str], spec: TableSpec) -> DataFrame:
    """What a lenient load leaves out: ``file, reason, column_name, value``, one row per line, row or cell.

    ``malformed`` has the line, ``null_key`` the row's cells as JSON, and ``unreadable`` the cell, whose row is loaded without it.
    """
    schema = "file STRING, reason STRING, column_name STRING, value STRING"
    path = first_existing(spark, candidates)
    if path is None:
        return spark.createDataFrame([], schema)
    text = _reader(spark).csv(path)
    lines = _lines(spark, path, text.schema)
    cells = {f.name: f.dataType for f in spec.schema if f.name in text.columns}
    bad = {name: F.col(name).isNotNull() & F.col(name).try_cast(kind).isNull() for name, kind in cells.items()}

    def told(reason: str, column: str | None, value: Column) -> Column:
        return F.struct(F.lit(reason).alias("reason"), F.lit(column).cast("string").alias("column_name"), value.alias("value"))

    none = F.lit(None).cast("struct<reason: string, column_name: string, value: string>")
    unread = F.filter(F.array(*[F.when(bad[c], told(BAD_CELL, c, F.col(c))).otherwise(none) for c in cells if c != spec.pk], none),
                      lambda x: x.isNotNull())
    keyless = F.array(told(NO_KEY, spec.pk, F.to_json(F.struct(*text.columns))))
    found = F.when(F.col(_LINE).isNotNull(), F.array(told(BAD_LINE, None, F.col(_LINE)))).when(~_whole(lines, spec), keyless)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.explode(found.otherwise(unread)).alias("r")).select(
        "file", "r.reason", "r.column_name", "r.value")


def as_rejects(found: DataFrame, spec: TableSpec) -> DataFrame:
    """What a load left out, as rejects of the table's log, beside the snapshot's rows."""
    told = F.when(F.col("column_name").isNull(), F.col("value")).otherwise(F.concat_ws(": ", "column_name", "value"))
    given = {VALUE: told, KIND: F.lit(REJECT), REASON: F.col("reason"), PARTIAL: F.lit(False)}
    return found.select(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spec.log_schema if f.name != COMMITTED])


def load_shop_tables(spark: SparkSession, data_dir: str, limit: int | None = None,
                     lenient: bool = False) -> dict[str, DataFrame]:
    """The three shop tables of a folder of CSV files, by table name; all rows unless a limit is given."""
    limits = {ORDERS.name: limit, ORDER_PRODUCTS.name: None if limit is None else limit * LINES_PER_ORDER}
    return {spec.name: load_csv(spark, shop_files(data_dir)[spec.name], spec, limits.get(spec.name), lenient)
            for spec in SHOP_TABLES}


def shop_files(data_dir: str) -> dict[str, list[str]]:
    """The files that a shop table may stand in, by table name."""
    return {ORDERS.name: [f"{data_dir}/orders.csv"],
            ORDER_PRODUCTS.name: [f"{data_dir}/order_products__prior.csv", f"{data_dir}/order_products__train.csv"],
            PRODUCTS.name: [f"{data_dir}/products.csv"]}


def shop_rejects(spark: SparkSession, data_dir: str) -> dict[str, DataFrame]:
    """What lenient loads of the shop tables leave out, by table name."""
    return {spec.name: csv_rejects(spark, shop_files(data_dir)[spec.name], spec) for spec in SHOP_TABLES}


def replace_table(rows: DataFrame, path: str) -> None:
    """Full refresh of a stored snapshot."""
    rows.write.mode("overwrite").parquet(path)


def to_changes(rows: DataFrame, spec: TableSpec, op: str, ts_ms: int) -> DataFrame:
    """Rows as changes of one kind at one time, in the log's columns.

    Changes of one key at equal times need ``__partition`` and ``__offset`` columns in
    the rows to be ordered.
    """
    def kept(name: str, kind: str):
        column = F.col(name) if name in rows.columns else F.lit(None)
        return column.cast(kind).alias(name)

    deleting = op == DELETING_OP
    return rows.select(
        *spec.columns,
        F.lit(op).alias(OP),
        F.lit(spec.name).alias(TABLE),
        F.lit(ts_ms).cast("long").alias(SOURCE_TS),
        F.lit("true" if deleting else "false").alias(DELETED),
        kept(BROKER_TS, "timestamp"), kept(PARTITION, "int"), kept(OFFSET, "long"),
        F.lit(None).cast("string").alias(VALUE),
        F.lit(DELETE if deleting else UPSERT).alias(KIND),
        F.lit(None).cast("string").alias(REASON),
        F.lit(False).alias(PARTIAL),
        *[c for c in rows.columns if c not in {*spec.columns, BROKER_TS, PARTITION, OFFSET}])


def bootstrap(rows: DataFrame, spec: TableSpec, ts_ms: int = BEFORE_ALL) -> DataFrame:
    """Rows of an initial snapshot as changes; any change of a key after ``ts_ms`` replaces its row.

    Without a time the snapshot stands before every change of the stream, whenever it is loaded, so that
    it hides none made between export and load.
    """
    return to_changes(rows, spec, "r", ts_ms)
