"""Request builders.

The instruction texts below are this project's own wording; deployments swap
in their prompts through the ``templates`` arguments.  What the pipeline
relies on is the structure: the literal ``{structural_hint}`` placeholder and
the ordered request parts.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules
from .text import collapse_ws

HINT_PLACEHOLDER = "{structural_hint}"

GRADING_INSTRUCTION = (
    "Grade the student submission against the model solution, question by question. "
    "Accept other valid solutions.\n\nStructure hint with points per gradable unit:\n"
    + HINT_PLACEHOLDER +
    "\n\nEnd the report with one ```json block holding the points per exercise, part and "
    "sub-part as nested objects, plus a \"total\" key.\n")
PARSE_INSTRUCTION = ("Transcribe the submission files into markdown, keeping formulas as LaTeX between $$ "
                     "and describing figures and handwriting; add nothing of your own.\n")
SOLUTION_INSTRUCTION = ("Transcribe the model solution into markdown with one header per exercise, "
                        "one line per gradable unit with its points, and a **Solution.** paragraph each.\n"
                        "Structure hint:\n" + HINT_PLACEHOLDER + "\n")
SOLUTION_EXTRACT_INSTRUCTION = "Transcribe the model solution.\n\n"

# FIXED VALUES: separators between the parts of a grading request
MODEL_SOLUTION_HEADER = "\n\nModel Solution:\n"
STUDENT_SUBMISSION_HEADER = "\n\nStudent Submission:\n"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def fill_hint(template, hint) -> Column:
    """Literal placeholder replacement; braces in the hint stay as they
    are (D10)."""
    t = F.lit(template) if isinstance(template, str) else template
    return F.replace(t, F.lit(HINT_PLACEHOLDER), _c(hint))


def build_grade_request(hint, solution, submission, template: str = GRADING_INSTRUCTION) -> Column:
    """Instruction (hint filled) + solution + submission, in order."""
    return F.concat(fill_hint(template, hint), F.lit(MODEL_SOLUTION_HEADER), _c(solution),
                    F.lit(STUDENT_SUBMISSION_HEADER), _c(submission))


# One part of a request: kind 'text' with its text, or kind 'file' with the path of a file to attach.
PART = "struct<kind:string,text:string,ref:string>"


def text_part(text) -> Column:
    return F.struct(F.lit("text").alias("kind"), _c(text).alias("text"), F.lit(None).cast("string").alias("ref")).cast(PART)


def file_part(ref) -> Column:
    return F.struct(F.lit("file").alias("kind"), F.lit(None).cast("string").alias("text"), _c(ref).alias("ref")).cast(PART)


def grade_parts(hint, solution_ref, submission_ref, template: str = GRADING_INSTRUCTION) -> Column:
    """The grading request as ordered parts; solution and submission are attached as files."""
    return F.array(text_part(fill_hint(template, hint)), text_part(F.lit(MODEL_SOLUTION_HEADER)), file_part(solution_ref),
                   text_part(F.lit(STUDENT_SUBMISSION_HEADER)), file_part(submission_ref))


def solution_extract_parts(pdf_ref, template: str = SOLUTION_EXTRACT_INSTRUCTION) -> Column:
    """The first solution request: instruction, PDF."""
    return F.array(text_part(F.lit(template)), file_part(pdf_ref))


def solution_enhance_parts(hint, markdown_ref, image_refs, template: str = SOLUTION_INSTRUCTION) -> Column:
    """The second solution request: instruction with the hint, extracted markdown, page images in order."""
    images = F.coalesce(F.transform(_c(image_refs), file_part), F.array().cast(f"array<{PART}>"))
    return F.concat(F.array(text_part(fill_hint(template, hint)), file_part(markdown_ref)), images)


def _bullets(arr) -> Column:
    return F.array_join(F.transform(arr, lambda x: F.concat(F.lit("- "), x, F.lit("\n"))), "")


def build_context(name, total, textual, visual, textual_files, visual_files) -> Column:
    """Submission context: name, three counts ('Unknown' without info),
    then bullet lists of textual and visual files when info exists."""
    def cnt(c):
        return F.coalesce(_c(c).cast("string"), F.lit("Unknown"))
    has_info = _c(total).isNotNull()
    # FIXED VALUES: the wording of the context
    head = F.concat(F.lit("\nSubmission Structure Information:\n- Submission Name: "), _c(name),
                    F.lit("\n- Total Original Files: "), cnt(total),
                    F.lit("\n- Textual Files: "), cnt(textual),
                    F.lit("\n- Visual Files: "), cnt(visual),
                    F.lit("\n\nThe following files have been uploaded for analysis:\n"))
    lists = F.concat(F.lit("\nTextual files:\n"), _bullets(F.coalesce(_c(textual_files), F.array().cast("array<string>"))),
                     F.lit("\nVisual files:\n"), _bullets(F.coalesce(_c(visual_files), F.array().cast("array<string>"))))
    return F.when(has_info, F.concat(head, lists)).otherwise(head)


def empty_reply(text) -> Column:
    """Blank reply -> the fixed marker text; else the reply."""
    t = _c(text)
    return F.when(collapse_ws(F.coalesce(t, F.lit(""))) == "", F.lit(rules.EMPTY_REPLY_MARKER)).otherwise(t)


def is_empty_reply(text) -> Column:
    return collapse_ws(F.coalesce(_c(text), F.lit(""))) == ""
