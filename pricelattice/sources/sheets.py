"""Sheet rows to typed tables: find the header, cut the data, clean, reject bad files.

Input is one row per sheet row: ``file``, ``report_type``, ``row_idx`` and ``cells``
(an array of text).  Per-file decisions are small aggregates joined back to the rows,
so a file holding a third of all rows is still read by many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelattice import vocabulary as V
from pricelattice.functions.numeric import is_bad_cell, is_bad_number, number_text, number_value
from pricelattice.functions.text import clean_text, collapse_whitespace
from pricelattice.session import broadcast_if_small

# header position and layout number share one long, so a plain minimum finds both
_LAYOUTS_PER_TYPE = 16


def normalized_cells(cells: Column) -> Column:
    return F.transform(cells, collapse_whitespace)


def matching_layout(report_type: Column, cells: Column) -> Column:
    """Number of the type's first layout whose header the leading cells equal, or null."""
    def is_header(tipo: str, header: list[str]) -> Column:
        leading = F.slice(cells, 1, len(header))
        return (report_type == tipo) & (leading == F.array(*[F.lit(h) for h in header]))

    return F.coalesce(*[
        F.when(is_header(tipo, header), number)
        for tipo, layouts in V.SHEET_LAYOUTS.items()
        for number, (header, _) in enumerate(layouts)
    ])


def _header_position() -> Column:
    """Row number and layout of a header row as one long; null for other rows."""
    openings = sorted({header[0] for layouts in V.SHEET_LAYOUTS.values() for header, _ in layouts})
    # one cell tells most rows from headers, so the others are not normalised; a word of it stands there as it is
    first = F.get("cells", F.lit(0))
    holds = reduce(Column.__or__, [first.contains(word) for word in sorted({o.split()[0] for o in openings})])
    may_be = holds & collapse_whitespace(first).isin(openings)
    layout = matching_layout(F.col("report_type"), normalized_cells(F.col("cells")))
    return F.when(may_be, F.col("row_idx") * _LAYOUTS_PER_TYPE + layout).cast("long")


def file_headers(rows: DataFrame) -> DataFrame:
    """Every file with the position and layout of its first header row, null if there is none."""
    first = rows.select("file", "report_type", _header_position().alias("_at")).groupBy("file", "report_type").agg(
        F.min("_at").alias("_at")
    )
    return first.select(
        "file", "report_type",
        F.floor(F.col("_at") / _LAYOUTS_PER_TYPE).alias("header_idx"),
        (F.col("_at") % _LAYOUTS_PER_TYPE).cast("int").alias("layout"),
    )


def find_headers(rows: DataFrame) -> DataFrame:
    """First header row of each file that has one, and the layout it shows."""
    return file_headers(rows).where(F.col("header_idx").isNotNull()).drop("report_type")


def unknown_layouts(rows: DataFrame) -> DataFrame:
    """Files in which no known header was found."""
    return file_headers(rows).where(F.col("header_idx").isNull()).select("file", "report_type")


def data_rows(rows: DataFrame) -> DataFrame:
    """Rows below the header whose first cell is not null."""
    headers = broadcast_if_small(find_headers(rows), written=True)
    return rows.join(headers, "file").where(
        (F.col("row_idx") > F.col("header_idx")) & F.get("cells", F.lit(0)).isNotNull()
    )


def _columns(tipo: str) -> list[str]:
    """All columns of a type over its layouts, in order of first use."""
    return list(dict.fromkeys(c for _, columns in V.SHEET_LAYOUTS[tipo] for c in columns))


def _cell(tipo: str, column: str) -> Column:
    """The cell holding a column under the row's layout; null if the layout lacks it."""
    places = {n: columns.index(column) for n, (_, columns) in enumerate(V.SHEET_LAYOUTS[tipo]) if column in columns}
    if len(places) == len(V.SHEET_LAYOUTS[tipo]) and len(set(places.values())) == 1:
        return F.get("cells", F.lit(places[0]))
    return F.coalesce(*[F.when(F.col("layout") == n, F.get("cells", F.lit(at))) for n, at in places.items()])


def _has_column(tipo: str, column: str) -> Column:
    numbers = [n for n, (_, columns) in enumerate(V.SHEET_LAYOUTS[tipo]) if column in columns]
    return F.col("layout").isin(numbers)


def typed_rows(data: DataFrame, tipo: str) -> DataFrame:
    """Data rows of one type with cleaned columns; ``bad`` marks rows with a cell that is no number."""
    columns = _columns(tipo)
    numbers = [c for c in columns if c not in V.TEXT_COLUMNS]
    cells = data.where(F.col("report_type") == tipo).select(
        "file", "row_idx", "layout", *[_cell(tipo, c).alias(c) for c in columns],
        *[number_text(_cell(tipo, c)).alias(f"_{c}") for c in numbers],
    )
    return cells.select(
        "file", "row_idx", "layout",
        *[
            F.when(_has_column(tipo, c), clean_text(F.col(c))).alias(c) if c in V.TEXT_COLUMNS
            else number_value(F.col(f"_{c}")).alias(c)
            for c in columns
        ],
        reduce(Column.__or__, [is_bad_cell(F.col(c), F.col(f"_{c}")) for c in numbers]).alias("bad"),
    )


def _bad_row(tipo: str) -> Column:
    numbers = [c for c in _columns(tipo) if c not in V.TEXT_COLUMNS]
    return reduce(Column.__or__, [is_bad_number(_cell(tipo, c)) for c in numbers])


def parse_sheets(rows: DataFrame, tipo: str) -> DataFrame:
    """Clean rows of one type; one bad cell rejects its whole file."""
    data = data_rows(rows.where(F.col("report_type") == tipo))
    rejected = data.where(_bad_row(tipo)).select("file").distinct()
    kept = data.join(broadcast_if_small(rejected, written=True), "file", "left_anti")
    return typed_rows(kept, tipo).drop("bad", "layout")


def attach_file_metadata(parsed: DataFrame, files: DataFrame, parsed_at: Column) -> DataFrame:
    """Adds the path facts of each row's file and the parse time, as silver stores them."""
    facts = broadcast_if_small(files.withColumnRenamed("blob_name", "file"), max_rows=50_000)
    return (
        parsed.drop("row_idx").join(facts, "file")
        .withColumnRenamed("file", "blob_name")
        .withColumn("parsed_at", F.date_format(parsed_at, "yyyy-MM-dd HH:mm:ss"))
    )


def file_outcomes(rows: DataFrame) -> DataFrame:
    """Per file: parsed with its row count, or failed with the reason."""
    bad = F.coalesce(*[F.when(F.col("report_type") == t, _bad_row(t)) for t in V.SHEET_LAYOUTS])
    checked = data_rows(rows).select("file", bad.alias("_bad")).groupBy("file").agg(
        F.count(F.lit(1)).alias("_rows"), F.bool_or("_bad").alias("_bad")
    )
    error = F.when(F.col("header_idx").isNull(), "no known header").when(F.col("_bad"), "cell is not a number")
    return file_headers(rows).join(checked, "file", "left").select(
        "file", "report_type",
        F.when(error.isNull(), F.coalesce("_rows", F.lit(0))).cast("long").alias("row_count"),
        F.when(error.isNull(), "parsed").otherwise("failed").alias("status"),
        error.alias("error"),
    )


def parsed_row_counts(rows: DataFrame) -> DataFrame:
    return file_outcomes(rows).where("status = 'parsed'").select("file", "row_count")
