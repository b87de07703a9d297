"""The entry file with and without the corpus operators."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_every_oracle_has_a_query():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and len(e.oracle_sql()) > 40


def test_imports_without_the_corpus_operators(tmp_path):
    for name in ("__spark_entry__.py", "feedmill"):
        source = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(source) else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "feedmill" / "llm", ignore_errors=True)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'deduped_feeds' in q and not any(x.startswith('op') for x in q) and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_imports_when_the_corpus_operators_cannot_be_imported(tmp_path):
    for name in ("__spark_entry__.py", "feedmill"):
        source = os.path.join(ROOT, name)
        (shutil.copytree if os.path.isdir(source) else shutil.copy)(source, tmp_path / name)
    shutil.rmtree(tmp_path / "feedmill" / "llm", ignore_errors=True)
    (tmp_path / "feedmill" / "llm").mkdir()
    (tmp_path / "feedmill" / "llm" / "queries.py").write_text("import a_module_that_is_not_there\n")
    code = "import __spark_entry__ as e; assert 'deduped_feeds' in e.queries() and 'pipeline' not in e.queries(); e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})


def test_nothing_else_imports_the_corpus_operators():
    for folder, _, names in os.walk(os.path.join(ROOT, "feedmill")):
        if os.path.basename(folder) != "llm":
            for name in names:
                if name.endswith(".py"):
                    assert "feedmill.llm" not in open(os.path.join(folder, name), encoding="utf-8").read(), name


@pytest.mark.parametrize("name", ["best_recent_by_category", "deduped_feeds", "extracted_blogs", "parsed_scores", "category_sections", "markdown_blocks", "page_markdown", "edition_reports", "blog_table_file", "synced_blogs"])
def test_queries_equal_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import __spark_entry__ as e

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "pages", "labels", "events", "conversations"):
        con.execute(f"create view {table} as select * from read_parquet('{sf}/{table}.parquet')")
    df = e.queries()[name](spark, sf)
    relation = con.sql(e.oracle_sql()[name])
    order = lambda cols: sorted(range(len(cols)), key=lambda i: cols[i])
    flat = lambda rows, cols: sorted(tuple(str(r[i]) for i in order(cols)) for r in rows)
    assert sorted(df.columns) == sorted(relation.columns)
    assert flat(map(tuple, df.collect()), df.columns) == flat(relation.fetchall(), relation.columns)
