"""A local server for tests: a function from (method, path, headers, body) to (status, headers, body)."""

import contextlib
import http.server
import threading


@contextlib.contextmanager
def serving(answer):
    class Handler(http.server.BaseHTTPRequestHandler):
        def _do(self):
            body = self.rfile.read(int(self.headers.get("Content-Length") or 0))
            status, headers, out = answer(self.command, self.path, self.headers, body)
            self.send_response(status)
            for k, v in headers.items():
                self.send_header(k, v)
            self.end_headers()
            with contextlib.suppress(BrokenPipeError):
                self.wfile.write(out)

        do_GET = do_POST = _do

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        yield f"http://127.0.0.1:{server.server_port}"
    finally:
        server.shutdown()
