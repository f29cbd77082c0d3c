"""File-inventory operators: classify, name, route."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .. import rules
from ..functions import paths as P
from ..functions import text as X
from .ranking import rank_within


def exclude_processed(files: DataFrame, path_col: str = "path", root_col: str | None = None) -> DataFrame:
    """S3: drop files with a path component equal to 'processed'.

    With ``root_col`` only the part below the submission root is tested (D14)."""
    p = F.col(path_col)
    if root_col:
        p = F.substring(p, F.length(F.col(root_col)) + 1, 1 << 30)
    return files.filter(~F.array_contains(F.split(p, "/"), "processed"))


def _content_checks(files: DataFrame, content_col: str) -> tuple[Column, Column]:
    """(leading text, whether the leading bytes decode).  Of binary content only the bytes that can hold the sniffed
    characters are looked at; up to 3 bytes of a character cut at their end are left out."""
    dtype = files.schema[content_col].dataType
    if not isinstance(dtype, T.BinaryType):
        return F.col(content_col), F.lit(True)
    lead = F.substring(F.col(content_col), 1, 4 * rules.TEXT_SNIFF_CHARS)
    text = lead.cast("string")
    for cut in (1, 2, 3):
        shorter = F.substring(F.col(content_col), 1, 4 * rules.TEXT_SNIFF_CHARS - cut).cast("string")
        cuttable = F.octet_length(F.col(content_col)) > 4 * rules.TEXT_SNIFF_CHARS
        text = F.when(F.is_valid_utf8(text) | ~cuttable, text).otherwise(shorter)
    # the sniff reads characters, so bytes behind the last of them do not matter
    whole = F.is_valid_utf8(text) | F.coalesce(F.is_valid_utf8(F.substring(text, 1, rules.TEXT_SNIFF_CHARS)), F.lit(False))
    return text, whole


def extension_table(spark):
    """The fixed extension rule table (78 rows): a broadcast side whose size
    is bounded by construction."""
    return spark.createDataFrame(rules.extension_rules(), "ext string, ext_class string")


def classify_files(files: DataFrame, content_col: str = "content") -> DataFrame:
    """should_process / category / skip_reason, first matching rule wins.

    Order: hidden -> unsupported extension -> size unknown/empty -> category by
    extension -> content sniff for unknown extensions -> size limit.  The
    extension is looked up by a broadcast join against the rule table, so the
    name regex runs once per row and later filters do not re-inline it."""
    name, path, size = F.col("name"), F.col("path"), F.col("size_bytes")
    spark = files.sparkSession
    out = files.withColumn("ext", P.file_ext(name)) \
        .join(F.broadcast(extension_table(spark)), "ext", "left")
    klass = F.col("ext_class")
    if content_col in files.columns:
        text, valid = _content_checks(files, content_col)
        is_text = X.looks_like_text(text, valid)
    else:
        is_text = F.lit(False)
    cat = F.coalesce(klass, F.lit("textual"))   # only reached once the sniff said text
    reason = (F.when(P.is_hidden(name, path), rules.REASON_HIDDEN)
              .when(klass == "skip", rules.REASON_UNSUPPORTED)
              .when(size.isNull(), rules.REASON_NO_ACCESS)
              .when(size == 0, rules.REASON_EMPTY)
              .when(klass.isNull() & ~is_text, rules.REASON_BINARY)
              .otherwise(F.coalesce(P.size_limit_reason(size, cat), F.lit(""))))
    out = out.withColumn("skip_reason", reason)
    ok = F.col("skip_reason") == ""
    return (out.withColumn("should_process", ok)
            .withColumn("category", F.when(ok, cat).otherwise(F.lit("")))
            .drop("ext_class"))


def reportable_skips(classified: DataFrame) -> DataFrame:
    """skipped files whose reason is worth reporting."""
    return classified.filter(~F.col("should_process") & ~F.col("skip_reason").isin(*rules.UNREPORTED_SKIPS))


# ---------------------------------------------------------------- W2 names
_FAMILY_RE = r"^(?s)(.*?)(_[0-9]+)*$"


def _fold_names(frames):
    """Sequential unique naming inside conflict families (natural 'a_1.txt' next to duplicated 'a.txt'), over rows
    sorted by family and path: each file takes its name, else the first free '<stem>_<k><suffix>'.  Only the names of
    the family at hand are held, and a stem's search goes on where it last ended."""
    family, taken, last = None, set(), {}
    for pdf in frames:
        out = []
        for fam, name, stem, suffix in zip(zip(pdf["submission"], pdf["__family"], pdf["__suffix"]), pdf["name"],
                                           pdf["__stem"], pdf["__suffix"]):
            if fam != family:
                family, taken, last = fam, set(), {}
            cand, k = name, last.get(stem, 0)
            while cand in taken:
                k += 1
                cand = f"{stem}_{k}{suffix}"
            if cand != name:
                last[stem] = k
            taken.add(cand)
            out.append(cand)
        yield pdf.assign(unique_name=out)


def unique_names(files: DataFrame) -> DataFrame:
    """Flatten-time names: the k-th later file with an already used name becomes '<stem>_<k><suffix>' (path order
    within the submission).  Every row stays, repeated paths too; null submissions and names count as values.

    The rows are written once; most names occur once and stay as they are, without any sort.  Repeated names are numbered
    by ``rank_within``.  Only a family where a natural '<stem>_<k>' name meets duplicates of '<stem>' needs the sequential
    rule; the rows of such families pass once through a sorted fold."""
    from ..session import materialize, ship_package
    ship_package(files.sparkSession)
    keep = [*files.columns, "unique_name"]
    base = materialize(files.withColumn("__stem", P.file_stem(F.col("name"))).withColumn("__suffix", P.raw_suffix(F.col("name")))
                       .withColumn("__family", F.regexp_extract(F.col("__stem"), _FAMILY_RE, 1)), "names")
    fam_keys = ["submission", "__family", "__suffix"]
    names = base.groupBy(*fam_keys, "name").agg(F.count(F.lit(1)).alias("__n"))
    # families with a repeated name: every name in them, and whether the sequential rule is needed
    crowded = names.groupBy(*fam_keys).agg(F.max("__n").alias("__most"), (F.count(F.lit(1)) > 1).alias("__fold")).filter("__most > 1")
    crowded = crowded.select(*[F.col(c).alias(f"{c}_f") for c in fam_keys], "__fold")
    same = F.lit(True)
    for c in fam_keys:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_f"))
    tagged = base.join(crowded, same, "left").drop(*[f"{c}_f" for c in fam_keys])
    single = tagged.filter(F.col("__fold").isNull()).withColumn("unique_name", F.col("name"))
    ranked = rank_within(tagged.filter(~F.col("__fold")), ["submission", "name"], ["path"], "__k").withColumn(
        "unique_name", F.when(F.col("__k") == 1, F.col("name")).otherwise(
            F.concat(F.col("__stem"), F.lit("_"), (F.col("__k") - 1).cast("string"), F.col("__suffix"))))
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = tagged.filter(F.col("__fold")).drop("__fold")
    schema = T.StructType([*rows.schema.fields, T.StructField("unique_name", T.StringType())])
    folded = (rows.repartition(n, *fam_keys).sortWithinPartitions(*fam_keys, "path", "name")
              .mapInPandas(_fold_names, schema))
    return single.select(*keep).unionByName(ranked.select(*keep)).unionByName(folded.select(*keep))


# ---------------------------------------------------------------- F11 routing
def route_channels(files: DataFrame, name_col: str = "unique_name") -> DataFrame:
    """one row per produced output (submission, path, channel, output_path).

    textual -> textual copy; visual -> visual copy; mixed -> textual PDF
    (PDFs only when they carry text) plus page images; archives found inside
    archives -> nothing.  Needs ``category``, ``ext`` and, for PDFs, ``has_text``."""
    files = files.withColumn("__ustem", P.file_stem(F.col(name_col)))
    n = F.col(name_col)
    stem = F.col("__ustem")
    cat, ext = F.col("category"), F.col("ext")
    textual = F.struct(F.lit("textual").alias("channel"), F.concat(F.lit("processed/textual/"), n).alias("output_path"))
    visual = F.struct(F.lit("visual").alias("channel"), F.concat(F.lit("processed/visual/"), n).alias("output_path"))
    pdf_name = F.when(ext == ".pdf", F.concat(stem, F.lit(".pdf"))).otherwise(
        F.concat(stem, F.lit("_from_"), F.substring(ext, 2, 1 << 20), F.lit(".pdf")))
    pdf_text = F.struct(F.lit("textual").alias("channel"),
                        F.concat(F.lit("processed/textual/"), pdf_name).alias("output_path"))
    pages = F.struct(F.lit("visual").alias("channel"),
                     F.concat(F.lit("processed/visual/"), stem, F.lit("_page_*.jpg")).alias("output_path"))
    has_text = F.coalesce(F.col("has_text"), F.lit(False)) if "has_text" in files.columns else F.lit(False)
    routes = (F.when(cat == "textual", F.array(textual))
              .when(cat == "visual", F.array(visual))
              .when((cat == "mixed") & (ext == ".pdf") & has_text, F.array(pdf_text, pages))
              .when((cat == "mixed") & (ext == ".pdf"), F.array(pages))
              .when(cat == "mixed", F.array(pdf_text, pages))
              .otherwise(F.array().cast("array<struct<channel:string,output_path:string>>")))
    return files.select("*", F.inline(routes)).drop("__ustem")


def scanned_pdfs(files: DataFrame, name_col: str = "unique_name") -> DataFrame:
    """Mixed PDFs without extractable text, with their text sample (column ``text_sample``)."""
    return (files.filter((F.col("category") == "mixed") & (F.col("ext") == ".pdf") & ~F.col("has_text"))
            .select("submission", "path", F.col(name_col).alias("filename"), "size_bytes", "text_sample"))


# ---------------------------------------------------------------- images
def image_resize_plan(images: DataFrame, max_dim: int = rules.MAX_IMAGE_RESOLUTION) -> DataFrame:
    """target size when the longer side exceeds ``max_dim`` (truncating)."""
    w, h = F.col("width"), F.col("height")
    big = F.greatest(w, h)
    ratio = F.lit(float(max_dim)) / big.cast("double")
    resize = big > max_dim
    return images.withColumn("resize", resize) \
        .withColumn("new_width", F.when(resize, (w.cast("double") * ratio).cast("int")).otherwise(w)) \
        .withColumn("new_height", F.when(resize, (h.cast("double") * ratio).cast("int")).otherwise(h))


def cap_pages(pages: DataFrame, n: int = rules.MAX_PDF_PAGES, page_col: str = "page_no") -> DataFrame:
    """First ``n`` pages of each document (pages carry their number, so a
    filter suffices: no shuffle)."""
    return pages.filter(F.col(page_col) <= n)


def first_pages(pages: DataFrame, n: int = rules.MAX_PDF_PAGES, key: str = "doc_id", order: str = "page_file") -> DataFrame:
    """W3 for pages without numbers: the first ``n`` of each document by ``order``, numbered in ``page_no``.  Every task
    keeps at most ``n`` rows of a document before the shuffle (``WindowGroupLimit``), so that a document with
    very many pages costs no more than others."""
    place = F.row_number().over(Window.partitionBy(key).orderBy(order))
    return pages.withColumn("page_no", place).filter(F.col("page_no") <= n)


def truncated_docs(pages: DataFrame,n: int = rules.MAX_PDF_PAGES, key: str = "doc_id",
                   page_col: str = "page_no") -> DataFrame:
    """Pages per document, pages kept, and whether the cap cut it."""
    return (pages.groupBy(key)
            .agg(F.count(F.lit(1)).alias("total_pages"),
                 F.count_if(F.col(page_col) <= n).alias("kept_pages"))
            .withColumn("truncated", F.col("total_pages") > n))


def assign_batches(files: DataFrame, size: int = rules.UPLOAD_BATCH_SIZE, key: str = "submission",
                   order: str = "path") -> DataFrame:
    """Upload batches of ``size`` files per submission in path order."""
    ranked = rank_within(files, [key], [order], "upload_ord")
    return ranked.withColumn("batch", F.floor((F.col("upload_ord") - 1) / size).cast("bigint"))
