"""Solution manifests (K4): JSON text per assignment, and the path of its parsed solution."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MANIFEST = ("assignment_id string, solution_pdf string, solution_text_path string, structure_hint_path string, "
            "solution_images array<string>, parsed_solution_path string")


def manifest_json(folder: Column, assignment_id: Column, pages: Column) -> Column:
    """K4: the manifest of a solution folder with its page images."""
    images = F.transform(F.sequence(F.lit(1), pages),
                         lambda i: F.concat(folder, F.lit("/pages/model_solution_page_"), i.cast("string"), F.lit(".png")))
    return F.to_json(F.struct(assignment_id.alias("assignment_id"),
                              F.concat(folder, F.lit("/solution.pdf")).alias("solution_pdf"),
                              F.concat(folder, F.lit("/solution_text.txt")).alias("solution_text_path"),
                              F.concat(folder, F.lit("/structure_hint.txt")).alias("structure_hint_path"),
                              images.alias("solution_images")))


def add_parsed_path(manifests: DataFrame, path: Column, text_col: str = "manifest") -> DataFrame:
    """``manifests`` with ``parsed_solution_path`` set in their JSON text; text that is no JSON object stays as it is."""
    doc = F.from_json(F.col(text_col), MANIFEST)
    added = F.to_json(doc.withField("parsed_solution_path", path))
    return manifests.withColumn(text_col, F.when(F.try_parse_json(text_col).isNull(), F.col(text_col)).otherwise(added))
