"""Each query against its SQL."""

import pytest

from folioscope import catalog, oracles
from tests.conftest import rows_of, rows_of_sql


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(name, spark, sf_dir, duck):
    df = catalog.QUERIES[name](spark, sf_dir)
    got = rows_of(df)
    assert got
    if name in oracles.ORACLES:
        names, expected = rows_of_sql(duck, oracles.ORACLES[name])
        assert names == sorted(df.columns)
        assert got == expected


def test_every_oracle_has_a_query():
    assert set(oracles.ORACLES) <= set(catalog.QUERIES)


def test_entry_survives_without_the_optional_subpackage(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).resolve().parent.parent
    for name in ("__spark_entry__.py", "folioscope"):
        source = repo / name
        if source.is_dir():
            shutil.copytree(source, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
        else:
            shutil.copy(source, tmp_path / name)
    out = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), 'pipeline' in e.queries(), len(e.oracle_sql()))"], cwd=tmp_path, capture_output=True, text=True, check=True)
    n, pipeline, m = out.stdout.split()
    assert int(n) == len(catalog.QUERIES) and pipeline == "False" and int(m) == len(oracles.ORACLES)


def test_queries_show_what_they_are_for(spark):
    """Rules and counts that inputs could leave out unseen."""
    sf = "/root/testdata/sf0.01"
    assert {r[0] for r in catalog.gate_findings(spark, sf).select("rule_ordinal").distinct().collect()} == set(range(1, 23))
    counts = catalog.doc_ir_counts(spark, sf).groupBy().sum("mojibake", "repairable", "risky", "captionless_images").first()
    assert all(counts) and counts["sum(repairable)"] < counts["sum(mojibake)"]
    assert {r["flavor"] for r in catalog.package_profile(spark, sf).select("flavor").distinct().collect()} == {"strict", "unknown", "transitional", None}
    roles = {r["role"] for r in catalog.doc_roles(spark, sf).select("role").distinct().collect()}
    assert roles == {"heading", "heading_candidate", "abstract", "keywords", "bibliography_heading", "figure_caption", "table_caption", "citation_fragment", "body", None}
