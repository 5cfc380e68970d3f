"""Text of web pages."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablework.llm.html_layout import render


def extract_text(pages: DataFrame) -> DataFrame:
    """The pages with their columns but ``html``, and ``text``, which replaces a column of that name.

    The visible text of the whole ``html``: head, scripts, styles, templates
    and elements hidden by attribute or inline style are left out; paragraphs,
    headings, lists and tables are set apart by blank lines, list items are
    marked and indented, table cells stand in aligned columns. Null html gives
    a null text, empty html an empty one; broken markup never fails. Each row
    is on its own, so repeated rows give equal texts.
    """
    kept = [c for c in pages.columns if c != "text"]

    def extract(batches):
        for batch in batches:
            texts = [None if x is None else render(x) for x in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    whole = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept if c != "html"]).alias("row"), "html")
    schema = f"row {whole.schema['row'].dataType.simpleString()}, text string"
    if "html" in kept and len(kept) == 1:
        raise ValueError("pages need a column besides html to be told apart")
    out = whole.mapInArrow(extract, schema)
    return out.select(*[F.col(f"row.`{c}`").alias(c) for c in kept if c != "html"], "text")
