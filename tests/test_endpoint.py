"""The lookup at an endpoint, over HTTP with a server of our own."""

import json
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest

from polylex.operators import crosswalk


@pytest.fixture
def endpoint():
    """(address, replies to give in order as (status, headers, body), requests as they came)."""
    replies, seen = [], []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            seen.append((parse_qs(urlparse(self.path).query), dict(self.headers)))
            status, headers, body = replies.pop(0)
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/sparql", replies, seen
    server.shutdown()
    server.server_close()


def found(*rows):
    names = ("n", "item", "page", "lang")
    return json.dumps({"results": {"bindings": [{k: {"value": v} for k, v in zip(names, r, strict=True)} for r in rows]}}).encode()


def test_busy_and_broken_replies_are_waited_out(endpoint):
    address, replies, seen = endpoint
    row = ("7", "http://x/entity/Q7", "https://de.x/wiki/T_7", "de")
    replies += [(429, {"Retry-After": "9"}, b""), (503, {}, b""), (429, {"Retry-After": "soon"}, b""), (200, {}, found(row))]
    waits = []
    lookup = crosswalk.sparql(address, agent="me")
    assert crosswalk.patiently(lambda: lookup(["7", "8"]), 7, waits.append) == [row] and waits == [9, 8, 16]
    query, headers = seen[-1]
    assert query["format"] == ["json"] and headers["User-Agent"] == "me" and '"7" "8"' in query["query"][0] and '"en" "de" "es" "fr" "zh"' in query["query"][0]


def test_a_refused_query_is_not_tried_again(endpoint):
    address, replies, seen = endpoint
    replies += [(400, {}, b"")]
    with pytest.raises(RuntimeError, match="400"):
        crosswalk.patiently(lambda: crosswalk.sparql(address)(["7"]), 7, lambda s: None)
    assert len(seen) == 1


def test_no_server_and_no_rows(endpoint):
    address, replies, _ = endpoint
    replies += [(200, {}, found()), (200, {}, b"{}")]
    assert crosswalk.sparql(address)(["7"]) == crosswalk.sparql(address)(["7"]) == []
    assert crosswalk.patiently(lambda: crosswalk.sparql("http://127.0.0.1:9/none")(["7"]), 2, lambda s: None) is None
