"""Structure hints -> rubric rows, totals, solution markdown.

A hint or a solution is one row and is read in one pass in its place.
"""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame, functions as F

EXERCISE_RE = r"^\s*Exercise\s+([^\s:]+)\s*:?(.*)$"
MARKER_RE = r"^\s*\(?([A-Za-z]+)\)\s*(.*)$"
POINTS_RE = r"(\d+(?:\.\d+)?)\s*points?\b"
BARE_POINTS_RE = r"^\s*\[?\s*(\d+(?:\.\d+)?)\s*points?\s*\]?\s*$"
ROMAN_RE = r"^x{0,3}(ix|iv|v?i{0,3})$"


_BEFORE = {"i": "h", "v": "u", "x": "w"}


def _as_in_java(pattern: str) -> re.Pattern:
    """A pattern for one line with what ``.``, ``$`` and the classes mean in Spark's expressions."""
    return re.compile(pattern.replace(".*", "[^\n\r\u0085\u2028\u2029]*").replace("$", "(?=[\r\u0085\u2028\u2029]?\\Z)"), re.ASCII)


_CR, _HEADING, _MARKER, _POINTS, _BARE_POINTS, _ROMAN = map(
    _as_in_java, (r"\r$", EXERCISE_RE, MARKER_RE, POINTS_RE, BARE_POINTS_RE, ROMAN_RE))


def _points(text: str) -> float | None:
    """The points that a line states.  To Java's ``\\b`` letters, digits and marks of all scripts are parts of a word."""
    if "point" not in text:
        return None
    if not text.isascii():
        text = "".join(c if c.isascii() else "_" if unicodedata.category(c) in _WORD else "!" for c in text)
    m = _POINTS.search(text)
    return float(m[1]) if m else None


_HINT_FIELDS = "ord int, exercise string, part string, sub string, points double"
_WORD = {"Lu", "Ll", "Lt", "Lm", "Lo", "Nd", "Mn"}


def _hint_units(text: str):
    """The gradable units of one hint, in order, each a tuple of ``_HINT_FIELDS``; one pass over the lines."""
    exercise = prev = part = waiting = None  # a pointed part waits until it is known whether it has pointed children
    for at, line in enumerate(text.split("\n"), 1):
        if "\r" in line:
            line = _CR.sub("", line)
        m = _HEADING.match(line) if "Exercise" in line else None
        if m:
            if waiting:
                yield waiting
            exercise, prev, part, waiting = "Exercise " + m[1], "#", None, None
            points = _points(m[2])
            if points is not None:
                yield at, exercise, None, None, points
            continue
        m = _MARKER.match(line) if ")" in line else None
        if m:
            marker, points = m[1].lower(), _points(m[2])
            roman = bool(_ROMAN.match(marker)) and not (prev and prev == _BEFORE.get(marker))
            prev = marker
            if roman or part is None:
                if waiting:
                    yield waiting
                part = marker if roman else None
                waiting = None if points is None else (at, exercise, marker, None, points)
            elif points is not None:
                waiting = None
                yield at, exercise, part, marker, points
            continue
        m = _BARE_POINTS.match(line) if "point" in line else None
        if m:
            if waiting:
                yield waiting
            waiting = None
            yield at, exercise, None, None, float(m[1])
    if waiting:
        yield waiting


def _parse_hints(batches):
    """Arrow batches (key, hint) -> key and ``_HINT_FIELDS``, about ten thousand rows at a time."""
    import pyarrow as pa

    names, types = [f.split()[0] for f in _HINT_FIELDS.split(", ")], [pa.int32(), *[pa.string()] * 3, pa.float64()]

    def batch(ids, at, rows):
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *map(pa.array, zip(*rows), types)], ["key", *names])

    for given in batches:
        ids, at, rows = given.column(0), [], []
        for i, text in enumerate(given.column(1).cast(pa.binary())):
            text = text.as_py()
            if text is None:
                continue
            for unit in _hint_units(text.decode("utf-8", "replace")):
                at.append(i)
                rows.append(unit)
                if len(rows) >= 10_000:
                    yield batch(ids, at, rows)
                    at, rows = [], []
        if rows:
            yield batch(ids, at, rows)


def parse_structure_hint(hints: DataFrame, key: str = "assignment_id", text_col: str = "hint") -> DataFrame:
    """Rubric rows (key, ord, exercise, part, sub, points).

    'Exercise X.Y[:] [N points]'; 'i)'/'a)' markers with 'N point(s)' or
    '[N points]'; a bare 'N points' line belongs to the exercise.  A marker is
    a part if it is a Roman numeral, unless the marker before it in the
    exercise is the preceding letter (h-i, u-v, w-x); letters are sub-parts
    under a part.  An unpointed part is a container; a pointed part with
    pointed children counts its children only.

    A hint is one row and is read in one pass in its place: no shuffle, no sort, no joins."""
    from ..session import ship_package

    ship_package(hints.sparkSession)
    kind = hints.schema[key].dataType.simpleString()
    return hints.select(F.col(key).alias("key"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(_parse_hints, f"key {kind}, {_HINT_FIELDS}").withColumnRenamed("key", key)


def rubric_totals(rubric: DataFrame, key: str = "assignment_id") -> DataFrame:
    """Exercise total = sum of its gradable units."""
    return rubric.groupBy(key, "exercise").agg(F.sum("points").alias("total_points"),
                                               F.count(F.lit(1)).alias("n_units"))


# ---- T9 / T10: model-solution markdown ------------------------------------
MD_EXERCISE_RE = r"^\s*##\s*Exercise\s+(\S+)\s*\((.*)\)\.\s*\(Total:\s*(\d+(?:\.\d+)?)\s*points?\)\s*$"
MD_UNIT_RE = r"^\s*\(([A-Za-z]+)\)\s*(.*?)\s*\[(\d+(?:\.\d+)?)\s*points?\]\s*$"
MD_CONTAINER_RE = r"^\s*\(([A-Za-z]+)\)\s*(.*)$"
MD_SOLUTION_RE = r"^\s*\*\*Solution\.\*\*\s*$"


_UNIT_FIELDS = ("exercise string, title string, header_total double, ord int, part string, sub string, prompt string, "
                "points double, solution_text string")
_EXERCISE, _MD_UNIT, _CONTAINER, _SOLUTION = map(_as_in_java, (MD_EXERCISE_RE, MD_UNIT_RE, MD_CONTAINER_RE, MD_SOLUTION_RE))


def _solution_units(text: str):
    """The units of one solution, in order, each a list of ``_UNIT_FIELDS``; one pass over the lines."""
    head, units, prev, container, body = (None, None, None), [], None, None, None

    def ended():
        if len(units) == 1 and units[0][4] == "i" and units[0][5] is None:
            units[0][4] = None
        for u in units:
            u[8] = "\n".join(u[8]) if u[8] else None
        return units

    for at, line in enumerate(text.split("\n"), 1):
        if "\r" in line:
            line = _CR.sub("", line)
        m = _EXERCISE.match(line) if "##" in line else None
        if m:
            yield from ended()
            head, units, prev, container, body = ("Exercise " + m[1], m[2], float(m[3])), [], None, None, None
            continue
        marked = "(" in line
        m = _MD_UNIT.match(line) if marked else None
        if m:
            unit = m[1].lower()
            if _ROMAN.match(unit) and not (prev and prev == _BEFORE.get(unit)):
                container = None
            body, prev = [], unit
            units.append([*head, at, container or unit, unit if container else None, m[2], float(m[3]), body])
            continue
        m = _CONTAINER.match(line) if marked else None
        if m:
            prev = container = m[1].lower()
            body = None
        elif body is not None and not ("**Solution.**" in line and _SOLUTION.match(line)):
            body.append(line)
    yield from ended()


def _parse_solutions(batches):
    """Arrow batches (key, text) -> key and ``_UNIT_FIELDS``, about ten thousand rows or eight million characters at a time."""
    import pyarrow as pa

    names = [f.split()[0] for f in _UNIT_FIELDS.split(", ")]
    types = [{"string": pa.string(), "double": pa.float64(), "int": pa.int32()}[f.split()[1]] for f in _UNIT_FIELDS.split(", ")]

    def batch(ids, at, rows):
        cols = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays([ids.take(pa.array(at, pa.int64())), *map(pa.array, cols, types)], ["key", *names])

    for given in batches:
        ids, at, rows, size = given.column(0), [], [], 0
        for i, text in enumerate(given.column(1)):
            text = text.as_py()
            if text is None:
                continue
            bare = not ids[i].is_valid  # a solution without key has no texts
            for unit in _solution_units(text):
                if bare:
                    unit[8] = None
                at.append(i)
                rows.append(unit)
                size += len(unit[8] or "") + len(unit[6])
                if len(rows) >= 10_000 or size > 8_000_000:
                    yield batch(ids, at, rows)
                    at, rows, size = [], [], 0
        if rows:
            yield batch(ids, at, rows)


def parse_solution_units(md: DataFrame, key: str = "assignment_id", text_col: str = "markdown") -> DataFrame:
    """solution_units (key, exercise, title, header_total, ord, part, sub,
    prompt, points, solution_text) from markdown in the solution grammar.

    Roman units are parts (they close an open container); letter units are
    sub-parts of the open container.  A sole '(i)' unit of an exercise
    without containers is the exercise itself (part null).

    Each row of ``md`` is a solution and is read in one pass in its place: no shuffle, no sort, no joins."""
    from ..session import ship_package

    ship_package(md.sparkSession)
    kind = md.schema[key].dataType.simpleString()
    return md.select(F.col(key).alias("key"), F.col(text_col)).mapInArrow(_parse_solutions, f"key {kind}, {_UNIT_FIELDS}") \
        .withColumnRenamed("key", key)


def validate_solution(units: DataFrame, rubric: DataFrame, key: str = "assignment_id") -> DataFrame:
    """Per exercise, header total = sum of unit points, and unit points equal the rubric's (null-safe full join on
    exercise, part, sub, so that a unit the solution omits counts too).

    ``total_ok`` also needs the rubric's total to be reached; an exercise that is only in the rubric has no header.

    The join is counted, not made: the rows of both sides are stacked and dealt once by ``key`` and exercise, and of m units
    and n rubric rows in one place the m x n pairs are known from how often each number of points comes on either side.  A row
    without ``key`` or exercise pairs with nothing."""
    place, points = [key, "exercise", "part", "sub"], F.col("points").cast("double").alias("points")
    no_header = F.lit(None).cast(units.schema["header_total"].dataType).alias("header_total")
    rows = units.select(*place, points, "header_total", F.lit(True).alias("here")).unionByName(
        rubric.select(*place, points, no_header, F.lit(False).alias("here"))).repartition(key, "exercise")
    at = rows.groupBy(*place, "points").agg(
        F.max("header_total").alias("header_total"), F.count_if("here").alias("m"), F.count_if(~F.col("here")).alias("n"))
    has_points, zero = F.col("points").isNotNull(), F.lit(0).cast("bigint")
    at = at.groupBy(*place).agg(
        F.max("header_total").alias("header_total"), F.sum("m").alias("m"), F.sum("n").alias("n"),
        F.sum(F.when(F.col("m") > 0, F.col("points") * F.col("m"))).alias("points"),
        (F.sum(F.when(has_points, F.col("m")).otherwise(zero)) * F.sum(F.when(has_points, F.col("n")).otherwise(zero))
         - F.sum(F.when(has_points, F.col("m") * F.col("n")).otherwise(zero))).alias("unequal"))
    keyed, pairs = F.col(key).isNotNull(), F.col(key).isNotNull() & F.col("exercise").isNotNull()
    return at.groupBy(key, "exercise").agg(
        F.max("header_total").alias("header_total"),
        F.coalesce(F.sum(F.col("points") * F.when(pairs, F.greatest("n", F.lit(1))).otherwise(F.lit(1))), F.lit(0.0)).alias("unit_points"),
        F.sum(F.when(keyed & ~(pairs & (F.col("n") > 0)), F.col("m")).otherwise(zero)).alias("units_not_in_rubric"),
        F.sum(F.when(pairs & (F.col("m") > 0), zero).when(keyed, F.col("n")).otherwise(F.col("m") + F.col("n"))).alias("units_omitted"),
        F.sum(F.when(pairs, F.col("unequal")).otherwise(zero)).alias("points_mismatch")) \
        .withColumn("total_ok", F.coalesce(F.abs(F.col("header_total") - F.col("unit_points")) < 1e-9, F.lit(False))
                    & (F.col("units_omitted") == 0))
