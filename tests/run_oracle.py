"""Run queries against their SQL: ``python tests/run_oracle.py [module] [name ...]``."""

import importlib
import sys
import time

sys.path[:0] = [__file__.rsplit("/", 2)[0], __file__.rsplit("/", 1)[0]]

from oracle import connect, differences  # noqa: E402

from vectorloom.plans.registry import ORACLES, QUERIES  # noqa: E402
from vectorloom.session import build_session  # noqa: E402


def main() -> None:
    for module in sys.argv[1].split(","):
        importlib.import_module(f"vectorloom.plans.{module}")
    names = sys.argv[2:] or list(QUERIES)
    folder = "/root/testdata/sf0.01"
    spark = build_session(
        "oracle", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false", spark_driver_memory="6g"
    )
    spark.sparkContext.setLogLevel("OFF")
    connection = connect(folder)
    bad = 0
    for name in names:
        start = time.time()
        try:
            frame = QUERIES[name](spark, folder)
            found = differences(frame, ORACLES[name], connection) if name in ORACLES else [f"rows only: {frame.count()}"]
        except Exception as error:
            found = [f"{type(error).__name__}: {str(error)[:700]}"]
        bad += bool(found) and name in ORACLES
        print(f"{name}: {time.time() - start:.2f}s {found or 'ok'}", flush=True)
    print("bad:", bad)


main()
