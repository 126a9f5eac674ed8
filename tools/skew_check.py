"""Hot-key check: a third of all events moved to one user.

Derives a skewed feed from ``events`` (user_id -> 0 when event_id % 3 = 0),
runs the tumbling and session joins (plain and salted, the session join
also as a stream), and compares row counts and a checksum with DuckDB on
the same derivation.

python tools/skew_check.py [sf_dir] [check ...]
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from tandem.operators.parse import gps_readings, parse_feed, stage_parsed, weather_readings  # noqa: E402
from tandem.operators.windows import session_join, tumbling_join  # noqa: E402
from tandem.plans import oracle  # noqa: E402
from tandem.session import get_session  # noqa: E402
from tandem.sources import events as ev_mod  # noqa: E402

HOT = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE user_id END"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = get_session("local[8]", extra={
        # small thresholds so AQE's skew-join split is exercised at this size
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    })
    skewed_dir = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"skewed-{os.getpid()}")
    (spark.read.parquet(f"{sf_dir}/events.parquet")
     .withColumn("user_id", F.expr(HOT)).write.parquet(f"{skewed_dir}/events.parquet"))
    p = stage_parsed(parse_feed(ev_mod.events_feed(spark, skewed_dir)))
    w, g = weather_readings(p, ingest="timestamp"), gps_readings(p)

    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * REPLACE ({HOT} AS user_id) "
                f"FROM '{sf_dir}/events.parquet'")
    con.execute(f"CREATE VIEW nation AS SELECT * FROM '{sf_dir}/nation.parquet'")
    checks = {
        "tumbling_1d": (lambda salt: tumbling_join(w, g, 86_400, salt=salt),
                        oracle._with(oracle.tumbling_weather(86_400_000))),
        "session_60s": (lambda salt: session_join(w, g, 60, salt=salt),
                        f"WITH {oracle._BASE}{oracle.session_ctes(60_000)}{oracle.SESSION_SELECT}"),
    }
    def stream_session(salt, salt_keys=None):
        from tandem.plans.streams import FLUSH_USER, flush_lines
        from tandem.streaming.replay import run_available_now, stage_feed, stream_feed
        feed = ev_mod.events_feed(spark, skewed_dir).unionByName(flush_lines(spark))
        sp = parse_feed(stream_feed(spark, stage_feed(feed)))
        j = session_join(weather_readings(sp, ingest="timestamp"), gps_readings(sp), 60,
                         salt=salt, salt_keys=salt_keys)
        out = spark.read.parquet(run_available_now(j.select("userId", "obsTs", "temp")))
        return out.where(F.col("userId") != FLUSH_USER)

    checks["stream_session_60s"] = (stream_session, checks["session_60s"][1])
    # salt only the hot user's join key
    checks["stream_session_hot"] = (lambda salt: stream_session(salt, ["u0"]),
                                    checks["session_60s"][1])
    wanted = sys.argv[2:]
    for name, (make, sql) in checks.items():
        if wanted and name not in wanted:
            continue
        want = con.execute(f"SELECT count(*), sum(obs_ms % 1000003 + temp) FROM ({sql})").fetchone()
        for salt in (1, 8):
            t0 = time.time()
            df = make(salt).agg(F.count(F.lit(1)),
                                F.sum(F.unix_millis("obsTs") % 1000003 + F.col("temp")))
            got = df.first()
            dt = time.time() - t0
            plan = df._jdf.queryExecution().executedPlan().toString()
            skew = "skew-split" if "isSkewJoin=true" in plan else "no-split"
            ok = (got[0], got[1]) == (want[0], want[1])
            print(f"{name:18s} salt={salt} rows={got[0]:9d} oracle={want[0]:9d} "
                  f"{'ok' if ok else 'DIFF'} {dt:.1f}s {skew}")


if __name__ == "__main__":
    main()
