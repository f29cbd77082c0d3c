"""DuckDB spellings of the column rules, generated from the same rule tables.

Used only to write oracle SQL for the checks; the Spark side never runs it.
"""

from __future__ import annotations

from .. import rules
from ..functions import paths as P
from ..functions import text as X
from ..functions import scores as S


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def in_list(values) -> str:
    return "(" + ", ".join(q(v) for v in values) + ")"


def dbl(x) -> str:
    return f"CAST({x!r} AS DOUBLE)"


def ext(name: str) -> str:
    return f"lower(regexp_extract({name}, {q(P.SUFFIX_RE)}, 1))"


def suffix(name: str) -> str:
    return f"regexp_extract({name}, {q(P.SUFFIX_RE)}, 1)"


def stem(name: str) -> str:
    return f"regexp_extract({name}, {q(P.STEM_RE)}, 1)"


def hidden(name: str, path: str) -> str:
    return (f"(starts_with({name}, '._') OR (starts_with({name}, '.') AND NOT starts_with({name}, '..')) "
            f"OR {name} IN {in_list(rules.SKIP_FILES)} OR contains({path}, '__MACOSX'))")


def category(e: str) -> str:
    parts = " ".join(f"WHEN {e} IN {in_list(exts)} THEN {q(cat)}" for cat, exts in rules.category_sets())
    return f"(CASE {parts} ELSE NULL END)"


def limit_mb(cat: str) -> str:
    parts = " ".join(f"WHEN {cat} = {q(c)} THEN {mb}" for c, mb in rules.SIZE_LIMITS_MB.items())
    return f"(CASE {parts} ELSE {rules.DEFAULT_SIZE_LIMIT_MB} END)"


def mb(size: str) -> str:
    return f"(CAST({size} AS DOUBLE) / CAST(1048576 AS DOUBLE))"


def size_reason(size: str, cat: str) -> str:
    return (f"(CASE WHEN {mb(size)} > CAST({limit_mb(cat)} AS DOUBLE) THEN "
            f"'File too large (' || printf('%.1f', {mb(size)}) || 'MB > ' || CAST({limit_mb(cat)} AS VARCHAR) || 'MB)' END)")


def collapse(t: str) -> str:
    return f"trim(regexp_replace({t}, {q(X.WS_CLASS + '+')}, ' ', 'g'))"


def share(t: str, drop: str) -> str:
    return (f"(CAST(length(regexp_replace({t}, {q(drop)}, '', 'g')) AS DOUBLE) / "
            f"CAST(nullif(length({t}), 0) AS DOUBLE))")


def printable_share(t: str) -> str:
    return (f"(CAST(length({t}) - length(regexp_replace({t}, {q(X.NON_PRINTABLE_KEEP)}, '', 'g')) AS DOUBLE) / "
            f"CAST(nullif(length({t}), 0) AS DOUBLE))")


def sniff(t: str) -> str:
    s = f"substring({t}, 1, {rules.TEXT_SNIFF_CHARS})"
    return f"coalesce(length({s}) > 0 AND {printable_share(s)} > {dbl(rules.TEXT_SNIFF_MIN_SHARE)}, false)"


def has_text(t: str) -> str:
    c = collapse(t)
    return (f"coalesce(length({c}) >= {rules.MIN_PDF_TEXT_LENGTH} AND "
            f"{share(c, X.ALNUM_OR_SPACE_DROP)} > {dbl(rules.PDF_TEXT_MIN_SHARE)}, false)")


def cut(t: str, n: int) -> str:
    return f"(CASE WHEN length({t}) > {n} THEN substring({t}, 1, {n}) || '...' ELSE {t} END)"


def text_sample(t: str) -> str:
    c = collapse(t)
    return f"(CASE WHEN {has_text(t)} THEN {cut(c, rules.TEXT_SAMPLE_CHARS)} ELSE {cut(c, rules.SCANNED_SAMPLE_CHARS)} END)"


def scanned_sample(s: str) -> str:
    return f"(CASE WHEN coalesce(length({s}), 0) = 0 THEN {q(rules.NO_TEXT_FOUND)} ELSE substring({s}, 1, {rules.SCANNED_SAMPLE_CHARS}) END)"


def skip_reason(name: str, path: str, size: str, content: str) -> str:
    e = ext(name)
    cat = f"coalesce({category(e)}, CASE WHEN {sniff(content)} THEN 'textual' END)"
    return (f"(CASE WHEN {hidden(name, path)} THEN {q(rules.REASON_HIDDEN)} "
            f"WHEN {e} IN {in_list(rules.SKIP_EXTENSIONS)} THEN {q(rules.REASON_UNSUPPORTED)} "
            f"WHEN {size} IS NULL THEN {q(rules.REASON_NO_ACCESS)} "
            f"WHEN {size} = 0 THEN {q(rules.REASON_EMPTY)} "
            f"WHEN {cat} IS NULL THEN {q(rules.REASON_BINARY)} "
            f"ELSE coalesce({size_reason(size, cat)}, '') END)"), cat


def pdf_name(name: str) -> str:
    e = ext(name)
    return (f"(CASE WHEN {e} = '.pdf' THEN {stem(name)} || '.pdf' "
            f"ELSE {stem(name)} || '_from_' || regexp_replace({e}, '^\\.', '') || '.pdf' END)")


def last_json(report: str) -> str:
    return f"regexp_extract_all({report}, {q(S.FENCE_RE)}, 1)[-1]"
