"""Fetching archives and vocabulary responses, with the transport passed in."""

from __future__ import annotations

import hashlib
import json
import os
import time
from collections.abc import Callable, Iterable

from .eras import archive_name

THROTTLE = 0.06  # seconds between requests


def download(quarter: str, folder: str, base_url: str, fetch: Callable[[str], Iterable[bytes]]) -> str:
    """The archive of ``quarter`` as ``folder/QUARTER.zip``; an existing one isn't fetched again.

    ``fetch(url)`` yields the body's chunks.  A broken download leaves no archive."""
    place = os.path.join(folder, f"{quarter.upper()}.zip")
    if not os.path.exists(place):
        with open(f"{place}.part", "wb") as out:
            for chunk in fetch(f"{base_url.rstrip('/')}/{archive_name(quarter)}"):
                out.write(chunk)
        os.replace(f"{place}.part", place)
    return place


def fetch_responses(keys: Iterable[str], folder: str, field: str, version: str, ask: Callable[[str], tuple[int, dict]], wait: Callable[[float], None] = time.sleep) -> dict[str, int]:
    """One JSON file a key, named by the key's SHA-1 and written once; the vocabulary's version is pinned in each.

    ``ask(key)`` gives (status, body).  Failures are counted and left for the next run.  A folder that holds
    another version is refused, since its responses wouldn't agree."""
    os.makedirs(folder, exist_ok=True)
    pin = os.path.join(folder, "version.txt")
    if os.path.exists(pin):
        with open(pin) as known:
            if known.read() != version:
                raise ValueError(f"{folder} holds another version")
    else:
        with open(pin, "w") as out:
            out.write(version)
    counts = {"fetched": 0, "failed": 0, "present": 0}
    for key in keys:
        place = os.path.join(folder, hashlib.sha1(key.encode()).hexdigest() + ".json")
        if os.path.exists(place):
            counts["present"] += 1
            continue
        status, body = ask(key)
        if status == 200:
            with open(f"{place}.part", "w") as out:
                json.dump({field: key, "rxnorm_version": version, "response": body}, out)
            os.replace(f"{place}.part", place)
        counts["fetched" if status == 200 else "failed"] += 1
        wait(THROTTLE)
    return counts
