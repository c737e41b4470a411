import glob
import os

import duckdb

TABLES = "documents embeddings pages benchmark labels".split()


def duck(sql, sf_dir=None, **frames):
    con = duckdb.connect()
    if sf_dir:
        for t in TABLES:
            p = f"{sf_dir}/{t}.parquet"
            con.execute(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    for name, f in frames.items():
        con.register(name, f)
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    return sorted((tuple(sorted(zip(names, r, strict=True))) for r in cur.fetchall()), key=str)


def spark_rows(df):
    return sorted((tuple(sorted(r.asDict().items())) for r in df.collect()), key=str)
