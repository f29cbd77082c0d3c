"""Every registered query vs its DuckDB oracle at sf0.001 (the driver runs
the same comparison at sf0.01)."""

import pytest

from scorewright.plans.registry import ORACLES, QUERIES, load_all

from sw_paths import ROOT, SF_SMALL

load_all()


@pytest.fixture(scope="module")
def duck():
    import importlib.util
    spec = importlib.util.spec_from_file_location("check_oracles", f"{ROOT}/tools/check_oracles.py")
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod, mod.duck(SF_SMALL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    mod, con = duck
    result = mod.compare(spark, con, name, SF_SMALL, QUERIES[name], ORACLES.get(name))
    assert result.startswith("OK") or result.startswith("ROWS"), result
