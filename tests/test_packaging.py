"""A driver started elsewhere, with the package only on its own sys.path,
can still run operators whose functions execute in Python workers."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_session_stream_from_another_folder(tmp_path):
    code = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        from tandem.session import get_session, scratch_path
        from tandem.operators.parse import gps_readings, parse_feed, weather_readings
        from tandem.operators.windows import session_join
        from tandem.streaming.replay import run_available_now, stage_feed, stream_feed
        from tests.helpers import EDGE_MS, feed, gps, weather
        spark = get_session("local[2]", shuffle_partitions=2, extra={{"spark.checkpoint.dir": {str(tmp_path)!r}}})
        lines = [weather(EDGE_MS), gps(EDGE_MS + 1000), weather(EDGE_MS + 999000, user="x"),
                 gps(EDGE_MS + 999000, user="x")]
        p = parse_feed(stream_feed(spark, stage_feed(feed(spark, lines))))
        j = session_join(weather_readings(p, ingest="timestamp"), gps_readings(p), 5)
        print("PAIRS", spark.read.parquet(run_available_now(j)).count())
        spark.stop()
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "PAIRS 1" in got.stdout, got.stderr[-2000:]
