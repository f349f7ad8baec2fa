"""Writers. Rows go from the executors to the files; the driver only formats bounded previews."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gristmill.session import new_folder, written


def write_report(
    frame: DataFrame, path: str, order: Sequence[Column | str] = (), single_file: bool = False
) -> None:
    """A result of any size as CSV, its rows in ``order`` over the files.

    ``single_file`` asks for one file: the rows are then exchanged into one task at the very
    end, as ``coalesce(1)`` would run the whole last stage of the plan there.
    """
    if single_file:
        frame = frame.repartition(1)
        ordered = frame.sortWithinPartitions(*order) if order else frame
    else:
        ordered = frame.orderBy(*order) if order else frame
    ordered.write.mode("overwrite").csv(path, header=True)


def write_table(
    frame: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = (), compression: str | None = None
) -> None:
    """All rows, in as many files as there are tasks.

    ``compression`` is for CSV, as ``gzip``; a compressed file is read by one task, as it was written.
    """
    writer = frame.write.mode("overwrite").partitionBy(*partition_by)
    if kind == "csv":
        writer.csv(path, header=True, compression=compression)
    else:
        writer.format(kind).save(path)


def write_key_values(frame: DataFrame, path: str) -> None:
    """Lines of ``key<TAB>value``."""
    frame.write.mode("overwrite").csv(path, sep="\t")


def write_reports(frames: dict[str, DataFrame], folder: str, single_file: bool = False) -> None:
    """One report per name under ``folder``."""
    for name, frame in frames.items():
        write_report(frame, f"{folder}/{name}", single_file=single_file)


def write_snapshot(frame: DataFrame) -> str:
    """A new version of a table in a folder of its own; older versions stay as they are."""
    path = new_folder(frame.sparkSession, "snapshot")
    frame.write.parquet(path)
    return path


def preview_lines(frame: DataFrame, rows: int = 20) -> list[str]:
    """The first rows as a grid with values to the right; only these rows come to the driver."""
    shown = frame.select(*(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")).alias(c) for c in frame.columns))
    table = [frame.columns, *([str(v) for v in row] for row in shown.take(rows))]
    widths = [max(3, *(len(line[i]) for line in table)) for i in range(len(frame.columns))]
    rule = "+" + "+".join("-" * width for width in widths) + "+"
    body = ["|" + "|".join(v.rjust(w) for v, w in zip(line, widths)) + "|" for line in table]
    return [rule, body[0], rule, *body[1:], rule]


def grid_lines(frame: DataFrame, rows: int, *order: Column | str) -> DataFrame:
    """The first ``rows`` rows in ``order`` as the lines of a grid, ``number, line``: rules, names, values to the right.

    Widths are an aggregate and the padding an expression, so no row comes to the driver; the grid is written as any
    other table is. Missing values show as NULL.
    """
    columns = frame.columns
    chosen = written(frame.orderBy(*order).limit(rows), "grid-rows")
    place = F.row_number().over(Window.orderBy(*order)).cast("long")
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("NULL")).alias(f"v{i}") for i, c in enumerate(columns)]
    # One window over the few rows of the grid.
    shown = chosen.select(place.alias("_place"), *cells)
    widths = [
        shown.select(F.greatest(F.lit(max(3, len(c))), F.coalesce(F.max(F.length(f"v{i}")), F.lit(0)))).scalar()
        for i, c in enumerate(columns)
    ]

    def line(values: Sequence[Column]) -> Column:
        return F.concat(F.lit("|"), F.concat_ws("|", *(F.lpad(v, w, F.lit(" ")) for v, w in zip(values, widths))), F.lit("|"))

    rule = F.concat(F.lit("+"), F.concat_ws("+", *(F.repeat(F.lit("-"), w) for w in widths)), F.lit("+"))
    around = ((-2, rule), (-1, line([F.lit(c) for c in columns])), (0, rule), (2**62, rule))
    marks = F.explode(F.array(*(F.struct(F.lit(n).cast("long").alias("_place"), text.alias("line")) for n, text in around)))
    frames = frame.sparkSession.range(1).select(marks.alias("s")).select("s.*")
    body = shown.select("_place", line([F.col(f"v{i}") for i in range(len(columns))]).alias("line"))
    number = (F.row_number().over(Window.orderBy("_place")) - 1).alias("number")
    return frames.unionByName(body).select(number, "line")


def write_preview(frame: DataFrame, path: str, title: str, rows: int = 20) -> None:
    """A titled grid of the first rows as a text file."""
    lines = [f"===== {title} =====", *preview_lines(frame, rows)]
    spark = frame.sparkSession
    spark.createDataFrame([("\n".join(lines),)], "value STRING").coalesce(1).write.mode("overwrite").text(path)
