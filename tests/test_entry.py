"""The driver contract: every query against its SQL, and the package without the optional part."""

import datetime
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from cueforge.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "events documents pages conversations labels benchmark".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 9) if isinstance(v, float) else str(v) if isinstance(v, datetime.datetime) else v


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == cols
    theirs = sorted((tuple(plain(r[names.index(c)]) for c in cols) for r in result.fetchall()), key=repr)
    assert mine == theirs


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_imports_without_the_optional_part(tmp_path):
    root = Path(entry.__file__).parent
    for p in ("__spark_entry__.py", "cueforge"):
        (tmp_path / p).symlink_to(root / p) if p.endswith(".py") else None
    (tmp_path / "cueforge").mkdir()
    for p in (root / "cueforge").iterdir():
        if p.name not in ("llm", "__pycache__"):
            (tmp_path / "cueforge" / p.name).symlink_to(p)
    run = subprocess.run([sys.executable, "-c", "import sys; sys.path[:0] = [sys.argv[1]]; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))", str(tmp_path)], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert run.stdout.split() == [str(len(QUERIES)), str(len(SQL))], run.stderr


def test_clips_of_cut_hints_match_sql(spark, tmp_path):
    # 17 references of 13 characters and spaces between them: the hint's last character is a space
    start = datetime.datetime(2024, 1, 1)
    rows = [(1, start, 1, "view", 5.0, ""), (2, start, 1, "view", 5.07, "")] + [(1_000_000 + k, start, 1, "click", 5.0, "") for k in range(17)]
    con = duckdb.connect()
    con.execute("CREATE TABLE events (event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type VARCHAR, value DOUBLE, props VARCHAR)")
    con.executemany("INSERT INTO events VALUES (?, ?, ?, ?, ?, ?)", rows)
    con.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    mine = sorted((r["file_id"], r["ordinal"], r["whisper"]) for r in QUERIES["provider_clips"](spark, str(tmp_path)).collect())
    assert mine == sorted(con.execute(SQL["provider_clips"]).fetchall())
    assert mine[0][2].endswith(" ") and mine[1][2] == "view_2"
