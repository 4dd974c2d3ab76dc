"""Adapters around translators and refiners: readiness, pacing, HTTP. They run inside the partition functions that call them."""

from __future__ import annotations

import json
import socket
import time
import urllib.parse
import urllib.request
from collections.abc import Callable

from quern.operators.translate import Refiner, Translator


def wait_ready(url: str, timeout: float = 10.0, probe: float = 2.0, pause: float = 0.5) -> None:
    """Returns once the URL's host takes connections; raises TimeoutError after timeout seconds."""
    parts = urllib.parse.urlparse(url)
    until = time.monotonic() + timeout
    while True:
        try:
            socket.create_connection((parts.hostname or "127.0.0.1", parts.port or 80), timeout=probe).close()
        except OSError as e:
            if time.monotonic() + pause > until:
                raise TimeoutError(f"not ready within {timeout:.0f}s: {e}") from e
            time.sleep(pause)
        else:
            return


def when_ready(refiner: Refiner, url: str, timeout: float = 10.0) -> Refiner:
    """The refiner, after its server has been waited for once in each worker."""
    ready: list[bool] = []

    def call(batch):
        if not ready:
            wait_ready(url, timeout)
            ready.append(True)
        return refiner(batch)

    return call


def paced(call: Callable, milliseconds: float, streams: int = 1) -> Callable:
    """The call, not oftener than once in so many milliseconds by all tasks together. streams: how many tasks call it at once, see translate_documents();
    each waits so many times as long, from one call's end to the next one's start."""

    def run(*args):
        out = call(*args)
        time.sleep(milliseconds * max(1, streams) / 1000)
        return out

    return run


def posted(url: str, payload: dict, timeout: float) -> dict:
    request = urllib.request.Request(url, json.dumps(payload).encode(), {"Content-Type": "application/json"})
    with urllib.request.urlopen(request, timeout=timeout) as answer:  # noqa: S310  the caller names the service
        return json.loads(answer.read().decode("utf-8", "replace"))


def chat_refiner(base_url: str, model: str, instruction: str, timeout: float = 40.0) -> Refiner:
    """Asks a chat completion service to refine a batch and answer a line for each segment, REFINE::<id>::<text>."""

    def call(batch):
        said = "\n".join(json.dumps({"id": s["id"], "text": s["text"], "translation": s["translation"]}, ensure_ascii=False) for s in batch)
        turns = [{"role": "system", "content": instruction}, {"role": "user", "content": said}]
        answer = posted(base_url.rstrip("/") + "/v1/chat/completions", {"model": model, "temperature": 0.15, "messages": turns}, timeout)
        return answer["choices"][0]["message"]["content"]

    return call


def json_translator(url: str, timeout: float = 30.0) -> Translator:
    """Asks a service that takes {text, source, target} and answers {text}."""
    return lambda text, source, target: posted(url, {"text": text, "source": source, "target": target}, timeout)["text"]
