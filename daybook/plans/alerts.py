"""Alerts: what is wrong with a day's manifest, and where that is said."""

from __future__ import annotations

import json
import logging
import urllib.request
from collections.abc import Callable

from daybook.operators import quality

_log = logging.getLogger("daybook")


def manifest_problems(manifest: dict | None) -> list[str]:
    if manifest is None:
        return [quality.MISSING]
    found = [] if manifest["status"] == "done" else [quality.STATUS + manifest["status"]]
    verify = manifest.get("verify")
    if not verify:
        found.append(quality.UNVERIFIED)
    elif verify.get("error") is not None:
        found.append(quality.FAILED + verify["error"])
    elif verify.get("skipped") is not None:
        found.append(quality.SKIPPED + verify["skipped"])
    return found


def format_alert(dt: str, source: str, problems: list[str]) -> str:
    lines = [f"daybook dt={dt} ({source})", *(f"- {p}" for p in problems), f"check: status {dt} / verify-all"]
    return "\n".join(lines)[:quality.ALERT_LENGTH]


def notify(text: str, webhook: str | None = None, send: Callable[[str, bytes], int] | None = None) -> bool:
    """Log the text, then post it to a webhook if there is one; mentions are never expanded. Never raises."""
    _log.error(text)
    if not webhook:
        return False
    body = json.dumps({"content": text, "allowed_mentions": {"parse": []}}).encode()
    try:
        return 200 <= (send or _post)(webhook, body) < 300
    except Exception:  # whatever it was, an alert must not stop the run
        return False


def _post(url: str, body: bytes) -> int:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=30) as answer:
        return answer.status
