import subprocess
import sys

from tallywire.plans.registry import all_oracles, all_queries


def test_registry_loads_without_a_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert q and set(o) <= set(q)"
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_every_query_is_callable():
    assert all(callable(f) for f in all_queries().values())
    assert len(all_oracles()) > 100
