"""JSON documents (S6-S8, S12) and HTML tables.

Documents arrive as a text column (landed files read with ``spark.read.text``
or a string column); parsing is ``from_json`` with an explicit schema, so
missing keys become NULL and malformed documents become NULL rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_document(df: DataFrame, json_col: str, schema: str, fields: dict[str, str],
                     keep: Sequence[str] = ()) -> DataFrame:
    """One nested document -> one flat row; ``fields`` maps output name
    to a dotted path inside the document."""
    doc = F.from_json(F.col(json_col), schema)
    parsed = df.select(*keep, doc.alias("_doc"))
    return parsed.select(*keep, *[F.col(f"_doc.{path}").alias(name) for name, path in fields.items()])


def explode_records(df: DataFrame, json_col: str, schema: str, array_path: str,
                    keep: Sequence[str] = ()) -> DataFrame:
    """A JSON array of records inside a document -> one row per record."""
    doc = F.from_json(F.col(json_col), schema)
    parsed = df.select(*keep, doc.alias("_doc"))
    return parsed.select(*keep, F.inline(F.col(f"_doc.{array_path}")))


def price_pairs(df: DataFrame, json_col: str, path: str = "prices", keep: Sequence[str] = ()) -> DataFrame:
    """``{prices: [[epoch_ms, price], ...]}`` -> (date, price) rows."""
    doc = F.from_json(F.col(json_col), f"struct<{path}: array<array<double>>>")
    pairs = df.select(*keep, F.explode(doc[path]).alias("_p"))
    ms = F.col("_p")[0].cast("long")
    return pairs.select(*keep, F.to_date(F.timestamp_millis(ms)).alias("date"), F.col("_p")[1].alias("price"))


def row_payload(df: DataFrame, key: str, cols: Sequence[str] | None = None) -> DataFrame:
    """``(key, payload)`` with the other columns as a JSON object,
    NULLs kept as JSON null."""
    cols = [c for c in (cols or df.columns) if c != key]
    payload = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    return df.select(key, payload.alias("payload"))


def html_table_rows(df: DataFrame, html_col: str, row_tag: str = "tr", cell_tag: str = "td",
                    n_cells: int | None = 9, keep: Sequence[str] = ()) -> DataFrame:
    """Rows of HTML tables -> arrays of cell texts; keep rows with
    exactly ``n_cells`` cells (``None`` keeps all).  Tags inside cells are
    stripped and whitespace trimmed; ``row_idx`` is the row's position in
    its document."""
    row_re = f"(?s)<{row_tag}\\b[^>]*>(.*?)</{row_tag}>"
    cell_re = f"(?s)<{cell_tag}\\b[^>]*>(.*?)</{cell_tag}>"
    rows = df.select(*keep, F.posexplode(F.regexp_extract_all(F.col(html_col), F.lit(row_re), 1))
                     .alias("row_idx", "_row"))
    cells = F.transform(F.regexp_extract_all(F.col("_row"), F.lit(cell_re), 1),
                        lambda c: F.trim(F.regexp_replace(c, "<[^>]+>", "")))
    out = rows.select(*keep, "row_idx", cells.alias("cells"))
    return out.filter(F.size("cells") == n_cells) if n_cells is not None else out


def html_rows_from(df: DataFrame, cells: Sequence[Column | str], key: str | None = None) -> DataFrame:
    """Inverse of S9 for fixtures: one ``<tr><td>..</td>..</tr>`` per row."""
    parts = [F.concat(F.lit("<td>"), (F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("</td>"))
             for c in cells]
    row = F.concat(F.lit("<tr>"), F.concat(*parts), F.lit("</tr>"))
    return df.select(*([key] if key else []), row.alias("html_row"))
