"""Transports for the live sources: a WebSocket client of the standard library (RFC 6455) and paged JSON over HTTP."""

from __future__ import annotations

import base64
import hashlib
import json
import os
import socket
import ssl
import struct
import time
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

_GUID = "258EAFA5-E914-47DA-95CA-C5AB0DC85B11"
TEXT, BINARY, CLOSE, PING, PONG = 1, 2, 8, 9, 10


def accept_key(key: str) -> str:
    return base64.b64encode(hashlib.sha1((key + _GUID).encode()).digest()).decode()


def frame(kind: int, data: bytes, mask: bytes | None = None) -> bytes:
    """One final frame; what a client sends is masked."""
    n, bit = len(data), 0x80 if mask else 0
    head = bytes([0x80 | kind, bit | n]) if n < 126 else bytes([0x80 | kind, bit | 126]) + struct.pack(">H", n) if n < 1 << 16 else bytes([0x80 | kind, bit | 127]) + struct.pack(">Q", n)
    if not mask:
        return head + data
    return head + mask + bytes(b ^ mask[i % 4] for i, b in enumerate(data))


class WebSocket:
    """Messages of a server; pings are answered, a close or a broken line raises OSError."""

    def __init__(self, url: str, timeout: float = 30.0) -> None:
        at = urllib.parse.urlsplit(url)
        line = socket.create_connection((at.hostname, at.port or (443 if at.scheme == "wss" else 80)), timeout)
        self.line = ssl.create_default_context().wrap_socket(line, server_hostname=at.hostname) if at.scheme == "wss" else line
        self.rest = b""
        key = base64.b64encode(os.urandom(16)).decode()
        path = (at.path or "/") + (f"?{at.query}" if at.query else "")
        self.line.sendall(f"GET {path} HTTP/1.1\r\nHost: {at.netloc}\r\nUpgrade: websocket\r\nConnection: Upgrade\r\nSec-WebSocket-Key: {key}\r\nSec-WebSocket-Version: 13\r\n\r\n".encode())
        while b"\r\n\r\n" not in self.rest:
            self._more()
        head, self.rest = self.rest.split(b"\r\n\r\n", 1)
        lines = head.decode("latin-1").split("\r\n")
        said = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if " 101" not in lines[0] or said.get("sec-websocket-accept") != accept_key(key):
            raise ConnectionError(lines[0])

    def _more(self) -> None:
        data = self.line.recv(1 << 16)
        if not data:
            raise ConnectionError("closed")
        self.rest += data

    def _take(self, n: int) -> bytes:
        while len(self.rest) < n:
            self._more()
        out, self.rest = self.rest[:n], self.rest[n:]
        return out

    def messages(self) -> Iterator[bytes]:
        held = b""
        while True:
            first, second = self._take(2)
            n = second & 127
            if n > 125:
                n = struct.unpack(">H" if n == 126 else ">Q", self._take(2 if n == 126 else 8))[0]
            data, kind = self._take(n), first & 15
            if kind == CLOSE:
                raise ConnectionError("closed by the server")
            if kind == PING:
                self.line.sendall(frame(PONG, data, os.urandom(4)))
            elif kind != PONG:
                held += data
                if first & 0x80:
                    yield held
                    held = b""

    def close(self) -> None:
        self.line.close()


def stream_fetch(seconds: float = 10.0, idle: float = 30.0) -> Callable[[str, str, int, int, int], list[dict]]:
    """For live.event_source: events of a collection from an endpoint since a time, until one at `until` or after it, or `most` came, `seconds`
    went by, or the line was silent or broke after events had come; a line that breaks before that is tried again by the reader, at
    the next endpoint."""

    def fetch(endpoint: str, collection: str, since: int, until: int, most: int) -> list[dict]:
        query = urllib.parse.urlencode(([("wantedCollections", collection)] if collection else []) + ([("cursor", since)] if since else []))
        line, out, stop = WebSocket(f"{endpoint}?{query}", idle), [], time.monotonic() + seconds
        try:
            for message in line.messages():
                try:
                    out.append(json.loads(message))
                except ValueError:
                    continue
                if len(out) >= most or time.monotonic() >= stop or (out[-1].get("time_us") or 0) >= until:
                    break
        except OSError:
            if not out:
                raise
        finally:
            line.close()
        return out

    return fetch


def feed_fetch(url: str, items: str = "feed", timeout: float = 30.0, **parameters: str) -> Callable[[str | None, int], tuple[list[dict], str | None]]:
    """For live.feed_source: a page of a JSON feed and the cursor of the next."""

    def fetch(cursor: str | None, page: int) -> tuple[list[dict], str | None]:
        query = urllib.parse.urlencode(parameters | {"limit": page} | ({"cursor": cursor} if cursor else {}))
        with urllib.request.urlopen(f"{url}?{query}", timeout=timeout) as answer:  # noqa: S310  # the address is the caller's
            found = json.load(answer)
        return found.get(items) or [], found.get("cursor")

    return fetch
