"""Fetching JSON over HTTP, on executors: linear back-off for busy or failing services, nothing else retried."""

from __future__ import annotations

import json
import time
from urllib.error import HTTPError
from urllib.request import Request, urlopen


def fetch_json(url: str, headers: dict[str, str] | None = None, body: bytes | None = None, retries: int = 3, delay: float = 3.0, timeout: float = 60.0) -> dict | list:
    """The answer; {} where there is none (404). Waits delay, 2 * delay, ... before another try after 429 or 5xx."""
    for attempt in range(retries + 1):
        time.sleep(delay * attempt)
        try:
            with urlopen(Request(url, data=body, headers=headers or {}), timeout=timeout) as answer:
                return json.load(answer)
        except HTTPError as e:
            if e.code == 404:
                return {}
            if attempt == retries or not (e.code == 429 or e.code >= 500):
                raise
    raise AssertionError("unreachable")
