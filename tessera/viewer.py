"""A local, read-only viewer of runs: http://127.0.0.1:PORT/ lists the runs below a folder and shows their receipts."""

from __future__ import annotations

import json
import os
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import quote, unquote, urlsplit

from tessera.plans.report import page
from tessera.sources.corpus import runs
from tessera.sources.sinks import EventLog

#: Files of a run that are shown; nothing else below the folder can be read.
SHOWN = ("MANIFEST.json", "BUILD-MANIFEST.json", "NEARDUP.json", "COMPOSITION.md", "REPORT.md", "receipt.html")


def inside(root: str, name: str) -> str | None:
    """The real path of a name below ``root``; None if it leads out of it, over links too."""
    root = os.path.realpath(root)
    path = os.path.realpath(os.path.join(root, name))
    return path if path == root or path.startswith(root + os.sep) else None


def summarise(folder: str) -> dict:
    """What a run's receipts say, in a few figures."""
    out: dict = {"state": "running" if EventLog(folder).running() else "finished"}
    for name, keys in (("MANIFEST.json", ("corpus_id", "docs", "doc_bytes", "corpus_build_hash")), ("BUILD-MANIFEST.json", ("corpus_id", "reasons", "filtered_build_hash"))):
        path = os.path.join(folder, name)
        if os.path.isfile(path):
            with open(path, encoding="utf-8") as f:
                content = json.load(f)
            out |= {k: content[k] for k in keys if k in content}
    return out


def respond(root: str, target: str) -> tuple[int, str, str]:
    """``(status, type, body)`` of a request."""
    name = unquote(urlsplit(target).path).lstrip("/")
    path = inside(root, name)
    if path is None:
        return 403, "text/plain", "outside of the folder"
    if name == "":
        found = {os.path.relpath(r, root): {"open": f"/{quote(os.path.relpath(r, root))}"} | summarise(r) for r in runs(root)}
        return 200, "text/html", page("Runs", found or {"no runs": {}})
    if os.path.isdir(path):
        files = {n: f"/{quote(name.rstrip('/'))}/{n}" for n in SHOWN if os.path.isfile(os.path.join(path, n))}
        return 200, "text/html", page(name, {"Summary": summarise(path), "Files": files, "Events": {i: e for i, e in enumerate(EventLog(path).tail(20))}})
    if os.path.basename(path) in SHOWN and os.path.isfile(path):
        with open(path, encoding="utf-8") as f:
            return 200, "text/html" if path.endswith(".html") else "text/plain", f.read()
    return 404, "text/plain", "not found"


def serve(root: str, port: int = 8377) -> ThreadingHTTPServer:
    """A server on this machine only, not started yet; port 0 takes a free one."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            status, kind, body = respond(root, self.path)
            data = body.encode()
            self.send_response(status)
            self.send_header("Content-Type", f"{kind}; charset=utf-8")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer(("127.0.0.1", port), Handler)
