"""Fetching with ids as rows: rate, failures and going on after them."""

import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from tallymark.sources import remote as N


@pytest.fixture
def server():
    seen, broken = [], {"c"}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            ids = self.path.partition("ids=")[2]
            seen.append((time.monotonic(), ids))
            bad = broken & set(ids.split("|"))
            self.send_response(403 if bad else 200)
            self.end_headers()
            if not bad:
                self.wfile.write(f"answer {ids}".encode())

        def log_message(self, *_):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}/q?ids={{id}}", seen, broken
    s.shutdown()


def test_answers_are_kept_and_the_rest_asked_for_again(spark, server, tmp_path):
    url, seen, broken = server
    ids = spark.createDataFrame([(x,) for x in ["a", "b", "c", "d", "a", None]], "id string")
    with pytest.raises(OSError, match="1 requests failed .status 403"):
        N.fetched(ids, "id", url, str(tmp_path / "x"), gap=0, lanes=2)
    assert sorted(i for _, i in seen) == ["a", "b", "c", "d"]
    seen.clear()
    broken.clear()
    got = N.fetched(ids, "id", url, str(tmp_path / "x"), gap=0, lanes=2)
    assert [i for _, i in seen] == ["c"]
    assert sorted((r["ids"][0], r["body"]) for r in got.collect()) == [(x, f"answer {x}") for x in "abcd"]
    assert N.fetched(ids.limit(0), "id", url, str(tmp_path / "y"), gap=0).count() == 0


def test_lanes_share_the_rate(spark, server, tmp_path):
    url, seen, broken = server
    broken.clear()
    ids = spark.createDataFrame([(str(i),) for i in range(12)], "id string")
    got = N.fetched(ids, "id", url, str(tmp_path / "x"), batch=2, gap=0.1, lanes=2)
    assert sorted(i for r in got.collect() for i in r["ids"]) == sorted(map(str, range(12)))
    lanes = len(seen)
    assert 6 <= lanes <= 7 and max(t for t, _ in seen) - min(t for t, _ in seen) >= 0.2 * ((lanes + 1) // 2 - 1) * 0.9
