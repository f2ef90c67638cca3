"""Command line: compare queries with their SQL twins. ``python tests/compare.py SF [name ...]``."""

import sys
import time
import traceback

sys.path.insert(0, ".")
from tests.oracle import connect, duck_rows, spark_rows, types_of_duck, types_of_spark  # noqa: E402
from tillroll.plans import registry  # noqa: E402
from tillroll.session import build_session  # noqa: E402


def main(sf: str, names: list[str]) -> None:
    sf_dir = f"/root/testdata/sf{sf}"
    registry.load()
    spark = build_session(
        master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                              "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = []
    for name in names or list(registry.QUERIES):
        t = time.time()
        try:
            df = registry.QUERIES[name](spark, sf_dir)
            got = spark_rows(df)
            took = time.time() - t
            if name not in registry.SQL:
                print(f"{name:28s} {took:6.1f}s rows={len(got[1])} (no SQL) {got[1][:1]}", flush=True)
                continue
            want = duck_rows(con, registry.SQL[name])
            types = {k: (v, types_of_duck(con, registry.SQL[name]).get(k)) for k, v in types_of_spark(df).items()}
            odd = {k: v for k, v in types.items() if v[0] != v[1]}
            ok = got == want and not odd
            print(f"{name:28s} {took:6.1f}s rows={len(got[1])} {'OK' if ok else 'DIFF'}", flush=True)
            if not ok:
                bad.append(name)
                print("   types", odd, "cols", got[0] == want[0], len(want[1]))
                differing = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
                print("   ", len(differing), str(differing[:2])[:1200])
        except Exception:
            bad.append(name)
            print(f"{name} FAILED"); print(traceback.format_exc()[-2500:], flush=True)
    print("BAD", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
