"""Compare column types of each Spark query with its DuckDB oracle."""

import sys

import duckdb

sys.path.insert(0, ".")
from tessera.plans.catalog import QUERIES, SQL  # noqa: E402
from tessera.session import TABLES, local_session  # noqa: E402

MAP = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
       "DATE": "date", "TIMESTAMP": "timestamp", "FLOAT": "float", "HUGEINT": "hugeint"}


def duck_type(t: str) -> str:
    t = str(t)
    if t.endswith("[]"):
        return f"array<{duck_type(t[:-2])}>"
    return MAP.get(t, t)


sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
spark = local_session(8)
con = duckdb.connect()
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
for name, sql in SQL.items():
    s = dict(QUERIES[name](spark, sf).dtypes)
    rel = con.sql(sql)
    d = {c: duck_type(t) for c, t in zip(rel.columns, rel.types)}
    diff = {c: (s.get(c), d.get(c)) for c in set(s) | set(d)
            if s.get(c) != d.get(c) and not (s.get(c) == "timestamp_ntz" and d.get(c) == "timestamp")}
    if diff:
        print(f"{name}: {diff}")
print("done")
