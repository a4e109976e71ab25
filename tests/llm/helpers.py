import duckdb

SF = "/root/testdata/sf0.001"


def table(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


ODD = [(1, "a b c"), (1, "a b c"), (None, "x y z"), (2, None), (3, ""), (4, "long " * 5000), (None, None)]


def against_sql(spark, fn, sql, **tables):
    """Rows of fn(spark, folder-less tables) as a set against DuckDB's on the same rows."""
    c = duckdb.connect()
    for n, df in tables.items():
        pdf = df.toPandas()
        c.register(f"{n}_v", pdf)
        c.execute(f"CREATE TABLE {n} AS SELECT * FROM {n}_v")
    got = fn(**tables)
    names = sorted(got.columns)
    d = c.execute(sql)
    at = [[x[0] for x in d.description].index(n) for n in names]
    key = lambda r: tuple(map(str, r))
    return sorted((tuple(r[n] for n in names) for r in got.collect()), key=key), sorted((tuple(r[i] for i in at) for r in d.fetchall()), key=key)
