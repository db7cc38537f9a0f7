"""Downloads and API responses, on the driver: resumed, retried where that can help, and kept on disk.

The session is passed in (anything with ``get(url, headers) -> (status, headers, chunks)``), so nothing here needs a network to be tested.
"""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable
from pathlib import Path


class Invalid(Exception):
    """What came isn't what was asked for; asking again won't help."""


class Unauthorized(Exception):
    """The server refuses; asking again won't help."""


class Unreachable(Exception):
    """The server couldn't be reached, or failed; asking again may help."""


class HttpSession:
    """The standard library's HTTP client."""

    def get(self, url: str, headers: dict[str, str], data: bytes | None = None) -> tuple[int, dict, Iterable[bytes]]:
        request = urllib.request.Request(url, data=data, headers=headers)
        try:
            answer = urllib.request.urlopen(request, timeout=60)
        except urllib.error.HTTPError as e:
            return e.code, dict(e.headers), [e.read()]
        except OSError as e:
            raise Unreachable(str(e)) from e
        return answer.status, dict(answer.headers), iter(lambda: answer.read(1 << 16), b"")


def checked(status: int) -> int:
    """The status, if it is a success; else the kind of failure it stands for."""
    if status in (401, 403):
        raise Unauthorized(f"HTTP {status}")
    if status == 429 or status >= 500:
        raise Unreachable(f"HTTP {status}")
    if status not in (200, 206):
        raise Invalid(f"HTTP {status}")
    return status


def retried(action: Callable[[], object], tries: int = 4, wait: float = 1.0, sleep: Callable[[float], None] = time.sleep):
    """The action's result; only failures that asking again may cure are repeated, with doubling waits."""
    for k in range(tries):
        try:
            return action()
        except Unreachable:
            if k + 1 == tries:
                raise
            sleep(wait * 2**k)
    return None


def download(url: str, path: str, session, valid: Callable[[str], object] | None = None, force: bool = False, **how) -> str:
    """Fetch a file by way of ``path``.part, from where an earlier try stopped; it is checked before it takes its name."""
    if os.path.exists(path) and not force:
        return path
    part = f"{path}.part"
    Path(path).parent.mkdir(parents=True, exist_ok=True)

    def once() -> str:
        have = os.path.getsize(part) if os.path.exists(part) else 0
        status, _, body = session.get(url, {"Range": f"bytes={have}-"} if have else {})
        mode = "ab" if checked(status) == 206 else "wb"
        with open(part, mode) as f:
            for chunk in body:
                f.write(chunk)
        return part

    retried(once, **how)
    if valid:
        try:
            valid(part)
        except Exception as e:
            os.remove(part)
            raise Invalid(f"{url}: {e}") from e
    os.replace(part, path)
    return path


def cached(query: str, folder: str, ask: Callable[[str], bytes], **how) -> bytes:
    """The raw answer to a query, kept by the query's hash; an answer that isn't JSON is not kept."""
    path = Path(folder) / f"{hashlib.sha256(query.encode()).hexdigest()[:24]}.json"
    if path.exists():
        return path.read_bytes()
    body = retried(lambda: ask(query), **how)
    try:
        json.loads(body)
    except ValueError as e:
        raise Invalid("the answer is not JSON") from e
    path.parent.mkdir(parents=True, exist_ok=True)
    fresh = path.with_suffix(".part")
    fresh.write_bytes(body)
    os.replace(fresh, path)
    return body


def newest_resource(package: dict, kind: str = "ZIP") -> str:
    """The address of a data portal's resource of a kind that was changed last; of equals the one listed first."""
    found = [r for r in package["result"]["resources"] if r.get("format", "").upper() == kind]
    if not found:
        raise Invalid(f"no {kind} resource")
    return max(found, key=lambda r: r.get("last_modified") or r.get("created") or "")["url"]


def parts_manifest(paths: list[str]) -> dict[str, list[int]]:
    """Size and modification time of each input, by name."""
    return {os.path.basename(p): [os.stat(p).st_size, int(os.stat(p).st_mtime)] for p in sorted(paths)}


def rebuilt(inputs: list[str], manifest: str, build: Callable[[], object]) -> bool:
    """Build unless the inputs are those of the last build; the manifest is written after it."""
    now = parts_manifest(inputs)
    if os.path.exists(manifest) and json.loads(Path(manifest).read_text()) == now:
        return False
    build()
    Path(manifest).write_text(json.dumps(now))
    return True
