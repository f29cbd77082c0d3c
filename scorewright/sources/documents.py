"""Text out of submitted documents so it can be filtered and queried.

HTML is handled natively (regex rewrites, see ``functions.text``); notebooks
and OOXML/ODF containers are opened in Python with the stdlib (``json``,
``zipfile``, ``xml.etree``) in ``mapInPandas``; PDFs need an external
extractor and come back with a reason instead of text.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import paths as P
from ..functions import text as X

OOXML_PARTS = {
    ".docx": (r"^word/document\.xml$",),
    ".pptx": (r"^ppt/slides/slide\d+\.xml$",),
    ".odt": (r"^content\.xml$",),
}

OUT_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("reason", T.StringType()),
])


def _xml_text(blob: bytes) -> str:
    root = ElementTree.fromstring(blob)
    parts = []
    for el in root.iter():
        tag = el.tag.rsplit("}", 1)[-1]
        if el.text and tag in ("t", "span", "p", "h"):
            parts.append(el.text)
        if tag in ("p",):
            parts.append("\n")
    return "".join(parts)


def _extract(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in it:
        rows = []
        for path, ext, data in zip(pdf["path"], pdf["ext"], pdf["content"]):
            text, reason = None, None
            try:
                blob = bytes(data) if data is not None else b""
                if ext in OOXML_PARTS:
                    pats = [re.compile(p) for p in OOXML_PARTS[ext]]
                    with zipfile.ZipFile(io.BytesIO(blob)) as zf:
                        names = sorted(n for n in zf.namelist() if any(p.match(n) for p in pats))
                        text = "\n".join(_xml_text(zf.read(n)) for n in names)
                else:
                    reason = f"no text extractor for {ext}"
            except Exception as exc:  # noqa: BLE001 - the reason is the row's result
                text, reason = None, f"{type(exc).__name__}: {exc}"
            rows.append((path, text, reason))
        yield pd.DataFrame(rows, columns=["path", "text", "reason"])


NOT_NOTEBOOK = "not a notebook (no JSON object)"
NOT_CONTAINER = "not an office container"


def notebook_text(content) -> F.Column:
    """ipynb, natively: cell sources (string or list of strings) joined by a
    blank line; null when the content is not a JSON object."""
    v = F.try_parse_json(content)
    cells = F.try_variant_get(v, "$.cells", "array<variant>")
    def cell_source(c):
        is_list = F.coalesce(F.schema_of_variant(F.try_variant_get(c, "$.source", "variant")).startswith("ARRAY"),
                             F.lit(False))
        return F.coalesce(F.when(is_list, F.array_join(F.try_variant_get(c, "$.source", "array<string>"), ""))
                          .otherwise(F.try_variant_get(c, "$.source", "string")), F.lit(""))
    src = F.transform(cells, cell_source)
    is_obj = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return F.when(is_obj, F.coalesce(F.array_join(src, "\n\n"), F.lit("")))


def extract_document_text(files: DataFrame) -> DataFrame:
    """(path, text, reason) per file.  HTML and notebooks natively; office
    containers whose bytes start like a zip go to Python (stdlib zipfile +
    xml), others get a reason natively; other types get a reason."""
    content = F.col("content")
    as_bytes = content if isinstance(files.schema["content"].dataType, T.BinaryType) else F.encode(content, "UTF-8")
    as_text = content.cast("string")
    f = files.withColumn("ext", P.file_ext(F.col("name")))
    html = f.filter(F.col("ext") == ".html").select(
        "path", X.html_to_text(as_text).alias("text"), F.lit(None).cast("string").alias("reason"))
    nb = f.filter(F.col("ext") == ".ipynb").withColumn("text", notebook_text(as_text)).select(
        "path", "text", F.when(F.col("text").isNull(), F.lit(NOT_NOTEBOOK)).alias("reason"))
    office = f.filter(F.col("ext").isin(*OOXML_PARTS)).withColumn("bytes", as_bytes) \
        .withColumn("zip_like", F.coalesce(F.substring("bytes", 1, 4) == F.lit(bytearray(b"PK\x03\x04")), F.lit(False)))
    rejected = office.filter(~F.col("zip_like")).select(
        "path", F.lit(None).cast("string").alias("text"), F.lit(NOT_CONTAINER).alias("reason"))
    other = f.filter(~F.col("ext").isin(".html", ".ipynb", *OOXML_PARTS)).select(
        "path", F.lit(None).cast("string").alias("text"),
        F.concat(F.lit("no text extractor for "), F.col("ext")).alias("reason"))
    out = html.unionByName(nb).unionByName(rejected).unionByName(other)
    candidates = office.filter("zip_like").select("path", "ext", F.col("bytes").alias("content"))
    from ..session import ship_package
    ship_package(files.sparkSession)
    return out.unionByName(candidates.mapInPandas(_extract, OUT_SCHEMA))
