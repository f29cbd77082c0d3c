"""Text predicates and samples (T1, T2, F6, F10, L2, S9-html)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .. import rules

# Characters Python's str.isspace() accepts: Java/RE2 \s plus VT, the
# information separators, NEL and every Unicode separator (Zs, Zl, Zp).
WS_CLASS = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}]"
# Characters that are neither printable nor whitespace for Python:
# category C minus the whitespace controls.
NON_PRINTABLE_KEEP = r"[\P{C}\t-\r\x{1c}-\x{1f}\x{85}]+"
ALNUM_OR_SPACE_DROP = r"[^\p{L}\p{N} ]+"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def collapse_ws(text) -> Column:
    """Strip and join the whitespace-separated words with one space."""
    return F.trim(F.regexp_replace(_c(text), WS_CLASS + "+", " "))


def char_share(text, drop_pattern: str) -> Column:
    """Share of characters that survive removing ``drop_pattern``.

    Null for empty text (no division by zero under ANSI)."""
    t = _c(text)
    kept = F.length(F.regexp_replace(t, drop_pattern, ""))
    return kept.cast("double") / F.nullif(F.length(t), F.lit(0)).cast("double")


def printable_share(text) -> Column:
    """Share of characters that are printable or whitespace."""
    t = _c(text)
    rest = F.length(F.regexp_replace(t, NON_PRINTABLE_KEEP, ""))
    n = F.length(t)
    return (n - rest).cast("double") / F.nullif(n, F.lit(0)).cast("double")


def looks_like_text(content, valid_utf8: Column | None = None) -> Column:
    """first 1,024 characters decode and are > 80 % printable/space."""
    sniff = F.substring(_c(content), 1, rules.TEXT_SNIFF_CHARS)
    ok = (F.length(sniff) > 0) & (printable_share(sniff) > F.lit(rules.TEXT_SNIFF_MIN_SHARE))
    if valid_utf8 is not None:
        ok = valid_utf8 & ok
    return F.coalesce(ok, F.lit(False))


def has_extractable_text(text, collapsed: bool = False) -> Column:
    """collapsed text has >= 50 characters and > 70 % alnum or space.

    Pass an already collapsed column with ``collapsed=True`` to skip T1."""
    t = _c(text) if collapsed else collapse_ws(text)
    return F.coalesce(
        (F.length(t) >= rules.MIN_PDF_TEXT_LENGTH)
        & (char_share(t, ALNUM_OR_SPACE_DROP) > F.lit(rules.PDF_TEXT_MIN_SHARE)),
        F.lit(False))


def cut(text, n: int) -> Column:
    """First ``n`` characters plus '...' when longer (L2)."""
    t = _c(text)
    return F.when(F.length(t) > n, F.concat(F.substring(t, 1, n), F.lit("..."))).otherwise(t)


def text_sample(text, collapsed: bool = False, has_text: Column | None = None) -> Column:
    """L2: sample kept with the extractable-text verdict (``has_text``, if it is known already)."""
    t = _c(text) if collapsed else collapse_ws(text)
    verdict = has_extractable_text(t, True) if has_text is None else has_text
    return F.when(verdict, cut(t, rules.TEXT_SAMPLE_CHARS)).otherwise(cut(t, rules.SCANNED_SAMPLE_CHARS))


def scanned_sample(sample) -> Column:
    """L2: a scanned PDF keeps 100 characters of its sample, or a marker."""
    s = _c(sample)
    return F.when(F.coalesce(F.length(s), F.lit(0)) == 0, F.lit(rules.NO_TEXT_FOUND)) \
        .otherwise(F.substring(s, 1, rules.SCANNED_SAMPLE_CHARS))


# S9 (html): ordered regex rewrites, all case-insensitive and dot-all.
HTML_REWRITES = (
    (r"(?is)<script\b.*?</script\s*>", " "),
    (r"(?is)<style\b.*?</style\s*>", " "),
    (r"(?s)<!--.*?-->", " "),
    (r"(?s)<[^>]*>", " "),
    (r"&nbsp;", " "),
    (r"&lt;", "<"),
    (r"&gt;", ">"),
    (r"&quot;", '"'),
    (r"&#39;", "'"),
    (r"&amp;", "&"),
)


def html_to_text(html) -> Column:
    """Visible text of an HTML page, whitespace collapsed."""
    out = _c(html)
    for pattern, repl in HTML_REWRITES:
        out = F.regexp_replace(out, pattern, repl)
    return collapse_ws(out)
