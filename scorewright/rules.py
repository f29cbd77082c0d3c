"""Rule tables of the intake and pricing logic.

FIXED VALUES: everything in this module but EMPTY_REPLY_MARKER must equal the
behaviour being reproduced (extension sets, skip lists, size limits, prices, caps, retry
defaults).  They are kept as plain data so every operator reads them from one
place and a deployment can swap them without touching code.
"""

from __future__ import annotations

# --- FIXED VALUES: file categories by lower-cased last extension -----------
TEXTUAL_EXTENSIONS = (
    ".txt", ".py", ".md", ".json", ".csv", ".xml", ".yaml", ".yml",
    ".js", ".css", ".sql", ".r", ".m", ".c", ".cpp", ".h",
    ".java", ".php", ".rb", ".go", ".rs", ".swift", ".kt", ".scala",
    ".tex",
)
VISUAL_EXTENSIONS = (
    ".jpg", ".jpeg", ".png", ".gif", ".bmp", ".tiff", ".tif",
    ".svg", ".webp", ".ico", ".eps",
)
MIXED_EXTENSIONS = (
    ".pdf", ".ipynb", ".html", ".pptx", ".ppt", ".docx", ".doc",
    ".odt", ".rtf",
)
# ".tar.gz" / ".tar.bz2" are listed but a last-extension lookup never yields
# them; they only matter for the compound-extension column.
ARCHIVE_EXTENSIONS = (".zip", ".rar", ".7z", ".tar", ".tar.gz", ".tar.bz2", ".gz")

# --- FIXED VALUES: names and extensions that are never processed -----------
SKIP_FILES = (".DS_Store", "Thumbs.db", "desktop.ini", "__MACOSX")
SKIP_EXTENSIONS = (
    ".npy", ".npz", ".pkl", ".pickle", ".mat", ".rds", ".rdata",
    ".h5", ".hdf5", ".db", ".sqlite", ".sqlite3", ".exe", ".msi",
    ".dmg", ".app", ".dll", ".so", ".dylib", ".bin", ".dat",
    ".tmp", ".log", ".cache", ".bak", ".swp",
)

# --- FIXED VALUES: limits ----------------------------------------------------
SIZE_LIMITS_MB = {"textual": 5, "visual": 10, "mixed": 75, "archive": 100}
DEFAULT_SIZE_LIMIT_MB = 100
MAX_PDF_PAGES = 30
MAX_IMAGE_RESOLUTION = 2048
PDF_DPI = 96
MIN_PDF_TEXT_LENGTH = 50
TEXT_SNIFF_CHARS = 1024
TEXT_SNIFF_MIN_SHARE = 0.8
PDF_TEXT_MIN_SHARE = 0.7
UPLOAD_BATCH_SIZE = 10
ERROR_MESSAGE_CHARS = 100
TEXT_SAMPLE_CHARS = 200
SCANNED_SAMPLE_CHARS = 100

# --- FIXED VALUES: skip reasons and status strings --------------------------
REASON_HIDDEN = "System/hidden file"
REASON_UNSUPPORTED = "Unsupported file type"
REASON_EMPTY = "Empty file"
REASON_NO_ACCESS = "Cannot access file"
REASON_BINARY = "Unknown binary file type"
UNREPORTED_SKIPS = (REASON_HIDDEN, REASON_EMPTY)
NO_FILES_REASON = "No processable files found"
UNKNOWN_ERROR = "Unknown error"
NO_TEXT_FOUND = "No text found"
PARSED_EXISTS = "parsed_submission.md already exists"
GRADED_EXISTS = "grading_result.json already exists"
PARSE_FAILED = "Failed to parse submission"
GRADE_FAILED = "Failed to grade submission"
PARSING_FAILED_FOR_GRADE = "Parsing failed"
NO_PARSED_FILE = "No parsed submission file"
EXCEPTION = "Exception: "
THREAD_EXCEPTION = "Thread exception: "
# our own wording (a documented divergence): it names no vendor
EMPTY_REPLY_MARKER = "Error: Empty response from the model. Please check the submission files."
JSON_PARSE_ERROR = "Failed to parse grading results"

# --- FIXED VALUES: price per 1M tokens (USD) ---------------------------------
# (model_type, thinking) -> (input price, output price); thinking only changes
# the flash output price.
PRICES = (
    ("flash", False, 0.15, 0.60),
    ("flash", True, 0.15, 3.50),
    ("pro", False, 1.25, 10.00),
    ("pro", True, 1.25, 10.00),
)
INVALID_MODEL_ERROR = "Model must be 'flash' or 'pro'."

# --- FIXED VALUES: model-call retries -----------------------------------------
MAX_RETRIES = 3
RETRY_DELAY_S = 5
DEFAULT_PARALLEL = 1
AUTO_PARALLEL_CAP = 4


def extension_rules():
    """(ext, ext_class) rows: the four categories plus 'skip' for unsupported
    extensions; first listing wins, as in the category lookup order."""
    seen: dict[str, str] = {}
    for ext in SKIP_EXTENSIONS:
        seen.setdefault(ext, "skip")
    for cat, exts in category_sets():
        for ext in exts:
            seen.setdefault(ext, cat)
    return sorted(seen.items())


def category_sets():
    """(category, extensions) in lookup order: first match wins."""
    return (
        ("textual", TEXTUAL_EXTENSIONS),
        ("visual", VISUAL_EXTENSIONS),
        ("mixed", MIXED_EXTENSIONS),
        ("archive", ARCHIVE_EXTENSIONS),
    )
