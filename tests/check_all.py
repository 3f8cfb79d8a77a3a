"""Run every registered query beside its SQL: python tests/check_all.py <sf_dir> [name …]"""

import sys
import time
import traceback

sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(__import__("pathlib").Path(__file__).resolve().parent))

from compare import compare, duck  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from millrace.session import build_session  # noqa: E402


def main() -> None:
    sf_dir, only = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g", spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql = duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, run in entry.queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        t0 = time.time()
        try:
            df = run(spark, sf_dir)
            if name in sql:
                problems = compare(df, con, sql[name])
                note = "ok" if not problems else " | ".join(problems)
            else:
                note, problems = f"rows only: {df.count()}", []
        except Exception as err:  # noqa: BLE001
            problems, note = ["error"], f"{type(err).__name__}: {str(err)[:1500]}"
            if only:
                traceback.print_exc()
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'pass'} {name:28s} {time.time() - t0:6.2f}s {note}", flush=True)
    print(f"{bad} failing")


if __name__ == "__main__":
    main()
