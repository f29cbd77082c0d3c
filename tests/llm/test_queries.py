"""The registered queries on the smallest tables: against their oracle, or by contract columns and rows."""

import importlib.util
import os

import pytest

from scorewright.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_quality": ["doc_id", "held_out", "score", "predicted"],
    "op3_simhash": ["doc_id", "fingerprint", "component_id"],
    "op5_line_dedup": ["doc_id", "text", "lines_before", "lines_removed"],
    "op6_toxicity": ["doc_id", "held_out", "score", "predicted"],
    "op8_decontaminate": ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
    "op9_packing": ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
    "op10_html_text": ["page_id", "url", "text", "n_chars"],
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(spark, name):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spec = importlib.util.spec_from_file_location("check_oracles", f"{root}/tools/check_oracles.py")
    tool = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(tool)
    result = tool.compare(spark, tool.duck(SF_DIR), name, SF_DIR, QUERIES[name], ORACLES[name])
    assert result.startswith("OK"), result


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_contract(spark, name):
    out = QUERIES[name](spark, SF_DIR)
    assert out.columns == COLUMNS[name]
    table = "pages" if name.startswith("op10") else "documents"
    ids = out.select(out.columns[0]).distinct().count()
    assert ids == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    if name != "op9_packing":
        assert out.count() == ids
