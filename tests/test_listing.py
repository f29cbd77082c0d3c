"""S2 listings in rounds and W3 without page numbers."""

import os
import tempfile

from scorewright.operators.files import first_pages
from scorewright.sources.files import scan_files


def test_deep_and_linked_folders(spark):
    root = tempfile.mkdtemp(prefix="sw-listing-")
    files = {"S1/a.txt": b"x", "S1/one/two/three/.deep": b"four", "S1/one/empty": b"", "#r/x": b"1", "S2/é ü/%41 b": b"22", "loose.txt": b"no"}
    for rel, data in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "wb") as out:
            out.write(data)
    os.makedirs(os.path.join(root, "S3/nothing"))
    os.symlink(os.path.join(root, "S1"), os.path.join(root, "S1/one/again"))
    for place in (root, f"file://{root}"):
        got = {(r.submission, r.path, r.name, r.size_bytes) for r in scan_files(spark, place).collect()}
        assert got == {(rel.split("/")[0], os.path.join(root, rel), os.path.basename(rel), len(data)) for rel, data in files.items() if "/" in rel}
    assert scan_files(spark, os.path.join(root, "S3/nothing")).collect() == []


def test_first_pages_limits_before_the_shuffle(spark):
    pages = spark.range(2000).selectExpr("if(id % 3 = 0, 7, id % 50) AS doc_id", "concat('p', lpad(id, 5, '0')) AS page_file")
    out = first_pages(pages, 30)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    want = {}
    for r in pages.collect():
        want.setdefault(r.doc_id, []).append(r.page_file)
    want = {(d, n, p) for d, files in want.items() for n, p in enumerate(sorted(files)[:30], 1)}
    assert {(r.doc_id, r.page_no, r.page_file) for r in out.collect()} == want


def test_first_pages_of_nothing(spark):
    assert first_pages(spark.createDataFrame([], "doc_id long, page_file string")).collect() == []


def test_small_folders_share_a_batch():
    import pyarrow as pa
    from scorewright.sources.files import _list_folders
    root = tempfile.mkdtemp(prefix="sw-listing-")
    folders = [os.path.join(root, f"S{i}") for i in range(50)]
    for f in folders:
        os.makedirs(f)
        open(os.path.join(f, "a.txt"), "wb").close()
    asked = pa.RecordBatch.from_arrays([pa.array([None] * 50, pa.string()), pa.array(folders)], ["submission", "folder"])
    out = list(_list_folders(iter([asked.slice(0, 20), asked.slice(20)])))
    assert len(out) == 1 and out[0].column("path").to_pylist() == [f"{f}/a.txt" for f in folders]
    assert list(_list_folders(iter([]))) == []
