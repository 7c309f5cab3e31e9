import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs_flagship(spark):
    mod = _entry()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["category", "count_m1", "overlap", "pct"]
    assert all(50.0 <= r.pct <= 70.0 for r in rows)


def test_oracle_keys_are_queries():
    mod = _entry()
    q, o = mod.queries(), mod.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 30


def test_sf0001_queries_match_duckdb(spark):
    """Every query with SQL agrees with DuckDB on the smallest tables."""
    import duckdb

    import tools.check_oracle as chk
    mod = _entry()
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in chk.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name, sql in mod.oracle_sql().items():
        df = mod.queries()[name](spark, sf)
        res = con.execute(sql)
        dcols = [d[0] for d in res.description]
        assert sorted(df.columns) == sorted(dcols), name
        assert chk._rows(df.columns, [tuple(r) for r in df.collect()]) == chk._rows(dcols, res.fetchall()), name


def test_entry_loads_and_runs_python_workers_from_another_directory(tmp_path):
    """Loaded by path from elsewhere, the entry finds its package and the KNN
    kernel runs in Python workers that cannot import the package."""
    import subprocess
    import sys
    code = (
        "import importlib.util\n"
        f"spec = importlib.util.spec_from_file_location('e', {os.path.join(ROOT, '__spark_entry__.py')!r})\n"
        "m = importlib.util.module_from_spec(spec); spec.loader.exec_module(m)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "print('ROWS', m.queries()['knn_blocked'](s, '/root/testdata/sf0.001').count(), m.entry(s).count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS 100 5" in out.stdout, out.stderr[-2000:]
