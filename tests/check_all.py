"""Command line: compare all (or the named) queries at a scale factor."""

import sys
import time
import traceback

from compare import compare, connection

import __spark_entry__ as entry
from tillhouse.session import local_session

if __name__ == "__main__":
    sf = sys.argv[1]
    names = sys.argv[2:]
    spark = local_session()
    con = connection(f"/root/testdata/{sf}")
    qs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t = time.time()
        try:
            df = fn(spark, f"/root/testdata/{sf}")
            if name in sqls:
                problems = compare(df, sqls[name], con)
                note = "ok" if not problems else "FAIL " + "; ".join(problems)
            else:
                problems, note = [], f"no oracle, {len(df.collect())} rows"
        except Exception as exc:
            problems, note = ["x"], "ERROR " + str(exc)[:700].replace("\n", " | ")
        bad += bool(problems)
        print(f"{name:40s} {time.time() - t:6.2f}s {note}", flush=True)
    print(f"{bad} bad", sorted(set(sqls) - set(qs)))
