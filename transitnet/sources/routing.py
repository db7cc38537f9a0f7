"""A client of a road-routing service: its answers become edges. ``post`` is passed in, so that executors and tests can bring their own."""

from __future__ import annotations

import json
import urllib.error
import urllib.request
from collections.abc import Callable
from itertools import pairwise

from transitnet.functions.arrays import decode_polyline

#: Points of a request at most, and metres of it at most; points that two requests share. A stop that comes again within so many metres is a break.
MOST_POINTS, MOST_M, SHARED, AGAIN_M = 2000, 180_000.0, 1, 50.0
M_PER_DEG = 111_320.0


def _metres(a: tuple[float, float], b: tuple[float, float]) -> float:
    import math

    return M_PER_DEG * math.hypot(b[0] - a[0], (b[1] - a[1]) * math.cos(math.radians(a[0])))


def chunked(points: list[tuple[float, float]], most: int = MOST_POINTS, metres: float = MOST_M, shared: int = SHARED) -> list[list[tuple[float, float]]]:
    """Runs of points within both bounds, each beginning with the last points of the one before; a single longer leg is a run."""
    out, run, length = [], points[:1], 0.0
    for a, b in pairwise(points):
        step = _metres(a, b)
        if len(run) > shared and (len(run) >= most or length + step > metres):
            out.append(run)
            run, length = run[-shared:], 0.0
        run = [*run, b]
        length += step
    return [*out, run] if len(run) > 1 or not out else out


def location_types(points: list[tuple[float, float]], near: float = AGAIN_M) -> list[str]:
    """How the router is to pass each stop: ends, and stops that a later or earlier one lies close to, are breaks, where it may turn."""
    last = len(points) - 1
    again = {i for i in range(last + 1) for j in range(last + 1) if abs(i - j) > 1 and _metres(points[i], points[j]) <= near}
    return ["break" if i in (0, last) or i in again else "break_through" for i in range(last + 1)]


def edges_of(answer: dict) -> list[dict]:
    """The edges of a trace: kilometres become metres, shapes are cut from the whole, edges without an id are dropped."""
    shape = decode_polyline(answer["shape"])
    out = []
    for e in answer.get("edges", []):
        if e.get("id") is None:
            continue
        own = shape[e["begin_shape_index"] : e["end_shape_index"] + 1]
        out.append({
            "edge_id": int(e["id"]), "way_id": e.get("way_id"), "road_name": (e.get("names") or [None])[0], "road_class": e.get("road_class"), "length_m": 1000.0 * e["length"],
            "lon_e6": [round(1e6 * lon) for _, lon in own], "lat_e6": [round(1e6 * lat) for lat, _ in own],
        })
    return out


class JsonPost:
    """POST by the standard library; picklable, so that a matcher can be sent to executors."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def __call__(self, path: str, body: dict) -> dict:
        request = urllib.request.Request(f"{self.base}{path}", json.dumps(body).encode(), {"Content-Type": "application/json"})
        try:
            with urllib.request.urlopen(request, timeout=60) as answer:
                return json.load(answer)
        except urllib.error.HTTPError as e:
            if e.code >= 500:
                raise ConnectionError(f"HTTP {e.code}") from e
            return {"error": f"HTTP {e.code}"}
        except OSError as e:
            raise ConnectionError(str(e)) from e


class RoutingMatcher:
    """The matcher of operators.match over such a service."""

    def __init__(self, post: Callable[[str, dict], dict], costing: str = "bus"):
        self.post, self.costing = post, costing

    def graph_id(self) -> str:
        return str(self.post("/status", {}).get("tileset_last_modified", ""))

    def healthy(self) -> bool:
        try:
            return "version" in self.post("/status", {})
        except ConnectionError:
            return False

    def _trace(self, points: list[tuple[float, float]], how: str) -> tuple[list[dict], float | None]:
        edges: list[dict] = []
        confidence = None
        for run in chunked(points):
            answer = self.post("/trace_attributes", {"shape": [{"lat": a, "lon": b} for a, b in run], "costing": self.costing, "shape_match": how})
            if "error" in answer:
                return [], None
            own = edges_of(answer)
            edges += own[1:] if edges and own and own[0]["edge_id"] == edges[-1]["edge_id"] else own
            if (c := answer.get("confidence_score")) is not None:
                confidence = c if confidence is None else min(confidence, c)
        return edges, confidence

    def match_shape(self, points: list[tuple[float, float]]) -> dict:
        edges, confidence = self._trace(points, "map_snap")
        return {"source": "shape", "confidence": confidence, "edges": edges, "error": None}

    def match_stops(self, points: list[tuple[float, float]]) -> dict:
        """A road is routed through the stops first, and then walked exactly."""
        kinds = location_types(points)
        answer = self.post("/route", {"locations": [{"lat": a, "lon": b, "type": t} for (a, b), t in zip(points, kinds, strict=True)], "costing": self.costing})
        if "error" in answer or "trip" not in answer:
            return {"source": "stops", "confidence": None, "edges": [], "error": None}
        road: list[tuple[float, float]] = []
        for leg in answer["trip"]["legs"]:
            own = decode_polyline(leg["shape"])
            road += own[1:] if road else own
        edges, _ = self._trace(road, "edge_walk")
        return {"source": "stops", "confidence": None, "edges": edges, "error": None}
