"""S4, S6, S7 readers over files written by the test."""

import json
import os
import tempfile

from scorewright.sources.files import read_preprocess_info, read_text_files, read_usage_ledger


def test_readers(spark):
    root = tempfile.mkdtemp(prefix="sw-readers-")
    for sub, info in (("A", {"submission_name": "A", "summary": {"total_original_files": 3, "textual_outputs": 1,
                                                                "visual_outputs": 2, "skipped_files": 0,
                                                                "failed_files": 0, "scanned_pdfs": 0},
                            "textual_files": ["processed/textual/a.txt"], "visual_files": []}),):
        os.makedirs(f"{root}/info/{sub}")
        json.dump(info, open(f"{root}/info/{sub}/preprocess_info.json", "w"), indent=2)
    os.makedirs(f"{root}/info/B")
    open(f"{root}/info/B/preprocess_info.json", "w").write("{not json")
    rows = {r.file_path.rsplit("/", 2)[-2]: r for r in read_preprocess_info(spark, f"{root}/info/*/preprocess_info.json").collect()}
    assert rows["A"].summary.textual_outputs == 1 and rows["A"].submission_name == "A"
    assert rows["B"].summary is None

    os.makedirs(f"{root}/meta/A")
    json.dump({"parsing": {"prompt_tokens": 10, "completion_tokens": 5, "total_tokens": 15, "cost_usd": 0.1,
                           "model_type": "pro", "processing_time_seconds": 1.5, "files_processed": 2},
               "grading": {"prompt_tokens": 7, "completion_tokens": 3, "total_tokens": 10, "cost_usd": 0.05,
                           "model_type": "pro", "processing_time_seconds": 0.5}},
              open(f"{root}/meta/A/grading_metadata.json", "w"))
    os.makedirs(f"{root}/meta/B")
    open(f"{root}/meta/B/grading_metadata.json", "w").write("oops")
    usage = sorted((r.stage, r.prompt_tokens, r.files_processed) for r in read_usage_ledger(spark, f"{root}/meta/*/grading_metadata.json").collect())
    assert usage == [("grading", 7, None), ("parsing", 10, 2)]

    os.makedirs(f"{root}/hints")
    open(f"{root}/hints/h.txt", "w").write("Exercise 1.1:\ni) 3 points\n")
    texts = read_text_files(spark, f"{root}/hints").collect()
    assert len(texts) == 1 and texts[0].text.startswith("Exercise 1.1:\n")
