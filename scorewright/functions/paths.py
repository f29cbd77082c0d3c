"""File-name predicates and derived names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


SUFFIX_RE = r"^(?s).+(\.[^.]+)$"
STEM_RE = r"^(?s)(.+?)(\.[^.]+)?$"
COMPOUND_RE = r"(?i)(\.tar\.(gz|bz2))$"


def raw_suffix(name) -> Column:
    """Last extension with its case: no leading-dot or trailing-dot suffix."""
    return F.regexp_extract(_c(name), SUFFIX_RE, 1)


def file_ext(name) -> Column:
    """lower-cased last extension, '' when there is none."""
    return F.lower(raw_suffix(name))


def file_stem(name) -> Column:
    """Name without its last extension (the whole name when there is none)."""
    return F.regexp_extract(_c(name), STEM_RE, 1)


def compound_ext(name) -> Column:
    """'.tar.gz' / '.tar.bz2' when present, else the last extension."""
    n = _c(name)
    c = F.lower(F.regexp_extract(n, COMPOUND_RE, 1))
    return F.when(c != "", c).otherwise(file_ext(n))


def is_hidden(name, path) -> Column:
    """system or hidden file (case-sensitive names)."""
    n, p = _c(name), _c(path)
    return (n.startswith("._")
            | (n.startswith(".") & ~n.startswith(".."))
            | n.isin(*rules.SKIP_FILES)
            | p.contains("__MACOSX"))


def category_of(ext) -> Column:
    """category by extension; null when the extension is unknown."""
    e = _c(ext)
    out = None
    for cat, exts in rules.category_sets():
        out = (F.when(e.isin(*exts), F.lit(cat)) if out is None
               else out.when(e.isin(*exts), F.lit(cat)))
    return out.otherwise(F.lit(None).cast("string"))


def size_limit_mb(category) -> Column:
    c = _c(category)
    out = None
    for cat, mb in rules.SIZE_LIMITS_MB.items():
        out = F.when(c == cat, F.lit(mb)) if out is None else out.when(c == cat, F.lit(mb))
    return out.otherwise(F.lit(rules.DEFAULT_SIZE_LIMIT_MB))


def size_mb(size_bytes) -> Column:
    """Bytes -> MiB as double."""
    return _c(size_bytes).cast("double") / F.lit(1048576.0)


def size_limit_reason(size_bytes, category) -> Column:
    """F8: 'File too large (x.yMB > nMB)' when strictly over the limit, else null.

    ``bround`` first: Python formats exact ties half-even, Java half-up."""
    mb = size_mb(size_bytes)
    lim = size_limit_mb(category)
    msg = F.format_string("File too large (%sMB > %sMB)",
                          F.format_string("%.1f", F.bround(mb, 1)), lim.cast("string"))
    return F.when(mb > lim.cast("double"), msg)


def pdf_output_name(name) -> Column:
    """'<stem>.pdf' for a PDF, else '<stem>_from_<ext>.pdf'."""
    n = _c(name)
    ext = file_ext(n)
    return F.when(ext == ".pdf", F.concat(file_stem(n), F.lit(".pdf"))) \
        .otherwise(F.concat(file_stem(n), F.lit("_from_"), F.regexp_replace(ext, r"^\.", ""), F.lit(".pdf")))


def page_image_name(name, page_no) -> Column:
    """'<stem>_page_<n>.jpg'."""
    return F.concat(file_stem(name), F.lit("_page_"), _c(page_no).cast("string"), F.lit(".jpg"))


def archive_dir_name(name) -> Column:
    """'extracted_<stem>'."""
    return F.concat(F.lit("extracted_"), file_stem(name))


OFFICE_EXTENSIONS = (".docx", ".doc", ".odt", ".rtf", ".pptx", ".ppt")


def conversion_route(ext) -> Column:
    """conversion family a mixed file needs."""
    e = _c(ext)
    return (F.when(e == ".ipynb", "notebook")
            .when(e.isin(*OFFICE_EXTENSIONS), "office")
            .when(e == ".html", "html")
            .when(e == ".pdf", "pdf_copy")
            .otherwise("none"))


def missing_output_error(ext) -> Column:
    return F.concat(F.lit("PDF conversion failed - output file not created for "), _c(ext), F.lit(" file"))


NOTEBOOK_FAILED = ("Jupyter notebook conversion failed (both direct PDF and "
                   "HTML→PDF methods failed)")


def conversion_error(kind, ext, cause) -> Column:
    """text of one conversion error (before the stage prefix)."""
    k, e = _c(kind), _c(ext)
    cause100 = F.substring(F.coalesce(_c(cause), F.lit("")), 1, rules.ERROR_MESSAGE_CHARS)
    return (F.when(k == "timeout", F.concat(F.lit("Conversion timeout ("), e, F.lit(" → PDF)")))
            .when(k == "command", F.concat(F.lit("Conversion command failed ("), e, F.lit(" → PDF): "), cause100))
            .when(k == "unexpected", F.concat(F.lit("Unexpected conversion error ("), e, F.lit(" → PDF): "), cause100))
            .when(k == "notebook", F.lit(NOTEBOOK_FAILED))
            .when(k == "image", F.concat(F.lit("Image conversion failed ("), e, F.lit("): "), cause100))
            .otherwise(missing_output_error(e)))


def failure_reason(conversion_type, message) -> Column:
    """stage prefix on a conversion error."""
    t = _c(conversion_type)
    return F.when(t == "PDF", F.concat(F.lit("PDF conversion failed: "), _c(message))) \
        .otherwise(F.concat(F.lit("Image conversion failed: "), _c(message)))


DIR_RE = r"^(?s)(.*)_([^_]*)_([^_]*)$"


def student_details(dir_name) -> Column:
    """struct(last_name, first_name, student_id, matriculation_number).

    Two right-splits on '_'; fewer than two '_' -> name kept, ids 'unknown'."""
    d = _c(dir_name)
    ok = d.rlike(DIR_RE)
    name_part = F.regexp_extract(d, DIR_RE, 1)
    last = F.substring_index(name_part, "_", 1)
    first = F.when(F.instr(name_part, "_") > 0,
                   F.regexp_extract(name_part, r"^(?s)[^_]*_(.*)$", 1)).otherwise(name_part)
    return F.struct(
        F.when(ok, last).otherwise(d).alias("last_name"),
        F.when(ok, first).otherwise(F.lit("")).alias("first_name"),
        F.when(ok, F.regexp_extract(d, DIR_RE, 2)).otherwise(F.lit("unknown")).alias("student_id"),
        F.when(ok, F.regexp_extract(d, DIR_RE, 3)).otherwise(F.lit("unknown")).alias("matriculation_number"),
    )
