"""List output columns whose Spark type differs from the DuckDB oracle's type."""
import sys, os
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT); sys.path.insert(0, os.path.join(ROOT, 'tools'))
from check_oracles import duck
from scorewright.session import get_session
from scorewright.plans.registry import QUERIES, ORACLES, load_all
load_all()
spark = get_session("local[8]")
sf = '/root/testdata/sf0.001'
con = duck(sf)
M = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
     "smallint": "SMALLINT", "tinyint": "TINYINT", "float": "FLOAT", "timestamp": "TIMESTAMP WITH TIME ZONE", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BLOB"}
for name in sorted(ORACLES):
    sdf = QUERIES[name](spark, sf)
    st = {f.name: M.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(f"SELECT * FROM ({ORACLES[name]}) LIMIT 0")
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    bad = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    if bad:
        print("TYPE", name, bad, flush=True)
print("done")
