"""Compare registered queries with their reference SQL: check_queries.py SF_DIR [NAME ...]"""

import sys
import time

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry_module  # noqa: E402
from claimweave.session import build_session  # noqa: E402
from compare import compare  # noqa: E402

if __name__ == "__main__":
    sf_dir, *names = sys.argv[1:]
    quiet = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    spark = build_session("check", "local[8]", 8, quiet)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, name, fn, oracles.get(name), sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(problem)
        kind = "" if name in oracles else " (rows only)"
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - start:6.2f}s {name}{kind} {problem or ''}", flush=True)
    print(f"{bad} failed")
