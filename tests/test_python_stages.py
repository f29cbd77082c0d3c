"""Archives, model calls with retries, unique-name folding, skew path."""

import bz2
import gzip
import io
import tarfile
import zipfile

from pyspark.sql import Window, functions as F

from scorewright.operators import enrich as E
from scorewright.operators import files as FO
from scorewright.operators.ranking import rank_within
from scorewright.sources.archives import expand_archives


def _zip(entries):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as zf:
        for name, data in entries:
            zf.writestr(name, data)
    return buf.getvalue()


def _tar(entries, mode="w"):
    buf = io.BytesIO()
    with tarfile.open(fileobj=buf, mode=mode) as tf:
        for name, data in entries:
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tf.addfile(info, io.BytesIO(data))
    return buf.getvalue()


def test_expand_archives(spark):
    inner = _zip([("deep.txt", b"deep")])
    rows = [
        ("S", "/S/a.zip", "a.zip", _zip([("x/n.txt", b"one"), ("y/n.txt", b"two"), ("in.zip", inner)])),
        ("S", "/S/empty.zip", "empty.zip", _zip([])),
        ("S", "/S/bad.zip", "bad.zip", b"PK\x03\x04 not really"),
        ("S", "/S/prose.zip", "prose.zip", b"just words"),
        ("S", "/S/t.txt.gz", "t.txt.gz", gzip.compress(b"hello")),
        ("S", "/S/p.tar", "p.tar", _tar([("p/q.md", b"# q")])),
        ("S", "/S/p.tar.gz", "p.tar.gz", gzip.compress(_tar([("r.py", b"1")]))),
        ("S", "/S/p.tar.bz2", "p.tar.bz2", bz2.compress(_tar([("s.c", b"int")]))),
    ]
    df = spark.createDataFrame(rows, "submission string, path string, name string, content binary")
    out = expand_archives(df).collect()
    members = sorted((r.archive_path, r.name, bytes(r.content)) for r in out if r.error is None)
    assert members == sorted([("/S/a.zip", "n.txt", b"one"), ("/S/a.zip", "n.txt", b"two"), ("/S/a.zip", "in.zip", inner),
                              ("/S/t.txt.gz", "t.txt", b"hello"), ("/S/p.tar", "q.md", b"# q"),
                              ("/S/p.tar.gz", "r.py", b"1"), ("/S/p.tar.bz2", "s.c", b"int")])
    errors = {r.archive_path for r in out if r.error is not None}
    assert errors == {"/S/bad.zip", "/S/prose.zip"}
    deeper = expand_archives(df.filter(F.col("name") == "a.zip"), max_depth=2).collect()
    assert any(r.name == "deep.txt" for r in deeper)


def test_invoke_model_retries(spark):
    waits = []
    req = spark.createDataFrame([(i, "parsing", f"text {i}") for i in range(40)], "id long, stage string, request string")

    def factory():
        return E.OfflineClient("offline-pro", fail_every=3, fail_times=2)

    out = E.invoke_model(req.coalesce(1), factory, max_retries=3, retry_delay=5, sleep=lambda s: None).collect()
    assert len(out) == 40 and all(r.error is None for r in out)
    assert {r.attempts for r in out} <= {1, 3} and any(r.attempts == 3 for r in out)

    def always_fail():
        return E.OfflineClient("offline-flash", fail_every=1, fail_times=99)

    bad = E.invoke_model(req.limit(2), always_fail, max_retries=3, sleep=waits.append).collect()
    assert all(r.attempts == 4 and r.error and r.text is None for r in bad)
    del waits


def test_unique_names_with_natural_conflict(spark):
    rows = [("S", "/S/1/a.txt", "a.txt"), ("S", "/S/2/a.txt", "a.txt"), ("S", "/S/3/a_1.txt", "a_1.txt"),
            ("S", "/S/4/b.pdf", "b.pdf"), ("S", "/S/5/b.pdf", "b.pdf"), ("S", "/S/6/b.pdf", "b.pdf")]
    df = spark.createDataFrame(rows, "submission string, path string, name string")
    got = {r.path: r.unique_name for r in FO.unique_names(df).collect()}
    assert got == {"/S/1/a.txt": "a.txt", "/S/2/a.txt": "a_1.txt", "/S/3/a_1.txt": "a_1_1.txt",
                   "/S/4/b.pdf": "b.pdf", "/S/5/b.pdf": "b_1.pdf", "/S/6/b.pdf": "b_2.pdf"}


def test_rank_within_hot_keys_equal_window(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 10 < 8 THEN 'hot' ELSE CAST(id % 7 AS STRING) END AS k", "id")
    fast = rank_within(df, ["k"], ["id"])
    ref = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("id")))
    assert fast.exceptAll(ref.select(*fast.columns)).count() == 0
    assert fast.count() == 3000


def test_model_called_once_per_row(spark):
    import os
    import tempfile
    marker_dir = tempfile.mkdtemp(prefix="sw-calls-")

    class Counting(E.OfflineClient):
        def generate(self, stage, request):
            open(os.path.join(marker_dir, f"{abs(hash(request))}-{os.getpid()}-{len(os.listdir(marker_dir))}"), "w").close()
            return super().generate(stage, request)

    def factory():
        return Counting("offline-pro")

    req = spark.createDataFrame([(i, "parsing", f"t{i}") for i in range(12)], "id long, stage string, request string")
    out = E.persist_responses(E.invoke_model(req, factory))
    out.count()
    out.collect()
    assert len(os.listdir(marker_dir)) == 12


def test_document_text(spark):
    import json as _json
    from scorewright.sources.documents import extract_document_text
    docx = _zip([("word/document.xml", b'<w:document xmlns:w="x"><w:body><w:p><w:r><w:t>Hello</w:t></w:r>'
                                        b'<w:r><w:t> world</w:t></w:r></w:p></w:body></w:document>')])
    nb = _json.dumps({"cells": [{"source": ["a = 1\n", "b = 2"]}, {"source": "# Title"}]}).encode()
    rows = [("/d/e.docx", "e.docx", docx), ("/d/n.ipynb", "n.ipynb", nb), ("/d/bad.ipynb", "bad.ipynb", b"prose"),
            ("/d/p.html", "p.html", b"<html><script>x()</script><p>Hi &amp; bye</p></html>"),
            ("/d/fake.docx", "fake.docx", b"prose"), ("/d/s.pdf", "s.pdf", b"%PDF")]
    df = spark.createDataFrame(rows, "path string, name string, content binary")
    got = {r.path: (r.text, r.reason) for r in extract_document_text(df).collect()}
    assert got["/d/e.docx"][0].strip() == "Hello world"
    assert got["/d/n.ipynb"] == ("a = 1\nb = 2\n\n# Title", None)
    assert got["/d/bad.ipynb"][0] is None and got["/d/bad.ipynb"][1]
    assert got["/d/p.html"] == ("Hi & bye", None)
    assert got["/d/fake.docx"] == (None, "not an office container")
    assert got["/d/s.pdf"][1] == "no text extractor for .pdf"
