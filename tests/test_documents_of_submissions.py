"""K1 nested documents: whole lists in documents of bounded size, read back by S6."""

import uuid

from scorewright import sinks
from scorewright.session import shared_dir
from scorewright.sources.files import read_preprocess_info


def test_a_large_submission_comes_out_whole(spark):
    path = shared_dir(spark, f"documents/{uuid.uuid4().hex}")
    info = spark.createDataFrame([("big", 900, 600, 300, 1, 2, 3), ("small", 2, 1, 1, 0, 0, 0), ("none", 1, 0, 0, 1, 0, 0)],
                                 ["submission", *sinks.SUMMARY_COUNTS])
    files = [("big", "visual" if i % 3 == 0 else "textual", f"out/{i:04d}") for i in range(900)]
    files += [("small", "textual", "a"), ("small", "visual", "b"), ("small", "visual", "b")]
    outputs = spark.createDataFrame(files, "submission string, channel string, output_path string")
    for _ in range(2):  # a repeated run replaces its own documents
        sinks.write_preprocess_documents(info, outputs, path, "2026-01-05", "1", files_per_document=50)
    docs = read_preprocess_info(spark, path, multi_line=False).collect()
    assert sorted(d.submission_name for d in docs) == ["big"] * 18 + ["none", "small"]
    assert all(len(d.textual_files) + len(d.visual_files) <= 50 and d._corrupt_record is None for d in docs)
    got = [(d.submission_name, c, f) for d in docs for c, names in (("textual", d.textual_files), ("visual", d.visual_files)) for f in names]
    assert sorted(got) == sorted(files)
    assert {(d.submission_name, *d.summary) for d in docs} == {tuple(r) for r in info.collect()}
