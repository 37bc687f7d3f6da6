"""Clients of chat models: pools of back ends, single ones, what they used.

Only the transport touches a network, and it is passed in: ``post(url, headers,
body, timeout)`` gives (status, text) and raises for a connection that fails.  A
client is made in the task that calls it, from settings that are plain data.
"""

from __future__ import annotations

import json
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from .enrich import backend as stable_backend

Post = Callable[[str, dict, bytes, float], tuple[int, str]]
Sleep = Callable[[float], None]

PASSING = frozenset({429, 500, 502, 503, 504})
KINDS = ("aoai", "openai")


class CallError(RuntimeError):
    """A call that no attempt has answered."""


class ContentFiltered(CallError):
    """The back end refuses the content: another attempt is of no use."""


def post_by_urllib(url: str, headers: dict, body: bytes, timeout: float) -> tuple[int, str]:
    """The transport by the standard library."""
    try:
        with urllib.request.urlopen(urllib.request.Request(url, body, headers, method="POST"), timeout=timeout) as r:
            return r.status, r.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode("utf-8", "replace")


def error_text(body: str, most: int = 500) -> str:
    """The begin of an error's body."""
    return body.strip()[:most] or "<empty body>"


@dataclass(frozen=True)
class Backend:
    """Where requests go; ``kind`` is the dialect: a deployment in the path and a
    key header, or a model in the body and a bearer token."""

    id: str
    endpoint: str
    deployment: str
    key: str
    version: str = ""
    model: str | None = None
    kind: str = "aoai"

    def request(self, messages: list[dict], temperature: float, max_tokens: int, model: str | None = None, template: dict | None = None) -> tuple[str, dict, dict]:
        """(url, headers, payload); ``model`` takes the place of the back end's own."""
        headers, payload = {"Content-Type": "application/json"}, {"messages": messages, "temperature": temperature, "max_tokens": max_tokens}
        base = self.endpoint.rstrip("/")
        if self.kind == "aoai":
            return f"{base}/openai/deployments/{self.deployment}/chat/completions?api-version={self.version}", headers | {"api-key": self.key}, payload
        payload["model"] = model or self.model or self.deployment
        if template:
            payload["chat_template_kwargs"] = template
        return f"{base}/v1/chat/completions", headers | {"Authorization": f"Bearer {self.key}"}, payload


def content_of(payload: dict) -> str:
    """The text of an answer, which may come in parts."""
    c = payload["choices"][0]["message"]["content"]
    if isinstance(c, list):
        return "".join(str(x.get("text", "")) for x in c if isinstance(x, dict) and x.get("type") == "text")
    return str(c)


def usage_of(payload: dict) -> dict[str, int]:
    """The token counters of an answer; a total that is missing or 0 is the sum."""
    u = payload.get("usage") or {}
    n = lambda x, k: int((x or {}).get(k) or 0)
    prompt, completion = n(u, "prompt_tokens"), n(u, "completion_tokens")
    return {
        "prompt_tokens": prompt, "completion_tokens": completion, "total_tokens": n(u, "total_tokens") or prompt + completion,
        "cached_tokens": n(u.get("prompt_tokens_details"), "cached_tokens"), "reasoning_tokens": n(u.get("completion_tokens_details"), "reasoning_tokens"),
    }


def _call(attempts: int, send: Callable[[int], tuple[int, str]], passing: Callable[[int, str], bool], what: str, sleep: Sleep) -> tuple[str, dict[str, int]]:
    """The answer of the first attempt that has one; between attempts the waiting
    time doubles."""
    last: object = None
    for i in range(attempts):
        try:
            status, text = send(i)
        except Exception as e:  # the connection
            last = e
            sleep(2.0**i)
            continue
        if 200 <= status < 300:
            try:
                payload = json.loads(text)
                return content_of(payload), usage_of(payload)
            except (ValueError, LookupError, TypeError) as e:
                last = e
        elif passing(status, text):
            last = f"HTTP {status}"
        else:
            refused = '"content_filter"' in text
            raise (ContentFiltered if refused else CallError)(f"{what}: HTTP {status}: {error_text(text)}")
        sleep(2.0**i)
    raise CallError(f"{what} failed after {attempts} attempts: {last}")


@dataclass
class Pool:
    """Back ends that share the requests: in turn (``round_robin``), or by a digest
    of the request (``stable``), where each further attempt takes the next one.
    ``step_models`` gives a step a model of its own."""

    backends: list[Backend]
    routing: str = "round_robin"
    step_models: dict[str, str] = field(default_factory=dict)
    template: dict[str, Any] = field(default_factory=dict)
    post: Post = post_by_urllib
    sleep: Sleep = time.sleep

    def __post_init__(self) -> None:
        if not self.backends:
            raise RuntimeError("the pool has no back ends")
        if self.routing not in ("round_robin", "stable"):
            raise ValueError(f"unknown routing {self.routing!r}")
        if wrong := [b.id for b in self.backends if b.kind not in KINDS]:
            raise ValueError(f"unknown kind of back end: {', '.join(wrong)}")
        self._turn, self._lock = 0, threading.Lock()

    @classmethod
    def load(cls, text: str, **settings: Any) -> Pool:
        """From a JSON list of entries with id, endpoint, deployment, apiKey,
        apiVersion and perhaps model and kind."""
        return cls([Backend(e["id"], e["endpoint"], e["deployment"], e["apiKey"], e["apiVersion"], e.get("model"), e.get("kind", "aoai")) for e in json.loads(text)], **settings)

    def next(self) -> Backend:
        with self._lock:
            self._turn += 1
            return self.backends[(self._turn - 1) % len(self.backends)]

    def backend_for(self, messages: list[dict], step: str = "", attempt: int = 0) -> Backend:
        if self.routing == "round_robin":
            return self.next()
        return self.backends[stable_backend(messages, step, len(self.backends), attempt)]

    def chat_with_usage(self, messages: list[dict], temperature: float = 0.0, max_tokens: int = 800, timeout: float = 180, attempts: int = 3, step: str = "") -> tuple[str, dict[str, int]]:
        def send(i: int) -> tuple[int, str]:
            url, headers, payload = self.backend_for(messages, step, i).request(messages, temperature, max_tokens, self.step_models.get(step), self.template)
            return self.post(url, headers, json.dumps(payload).encode(), timeout)

        return _call(attempts, send, lambda status, _: status == 404 or status in PASSING, f"{step or 'call'} to the pool", self.sleep)

    def chat(self, messages: list[dict], **settings: Any) -> str:
        return self.chat_with_usage(messages, **settings)[0]


@dataclass
class Client:
    """One back end with a model and a bearer token."""

    key: str
    model: str
    base_url: str
    extra: dict[str, Any] = field(default_factory=dict)
    post: Post = post_by_urllib
    sleep: Sleep = time.sleep

    def __post_init__(self) -> None:
        if not self.key or not self.model:
            raise ValueError("a client needs a key and a model")
        self.base_url = self.base_url.rstrip("/")

    def chat_with_usage(self, messages: list[dict], temperature: float = 0.0, max_tokens: int = 800, timeout: float = 180, attempts: int = 3, step: str = "") -> tuple[str, dict[str, int]]:
        payload = {"model": self.model, "messages": messages, "temperature": temperature, "max_tokens": max_tokens, **self.extra}
        headers = {"Content-Type": "application/json", "Authorization": f"Bearer {self.key}"}
        passing = lambda status, text: status in PASSING or status == 400 and "Provider returned error" in text
        return _call(attempts, lambda _: self.post(f"{self.base_url}/chat/completions", headers, json.dumps(payload).encode(), timeout), passing, f"{step or 'call'} of {self.model}", self.sleep)

    def chat(self, messages: list[dict], **settings: Any) -> str:
        return self.chat_with_usage(messages, **settings)[0]


class UsageRecorder:
    """The calls of a document, in order."""

    def __init__(self) -> None:
        self.calls: list[dict] = []

    def add(self, stage: str, usage: dict[str, int], latency_ms: float) -> None:
        self.calls.append({"stage": stage, "latency_ms": round(latency_ms, 1), **usage})


CALL = "stage string, latency_ms double, prompt_tokens long, completion_tokens long, total_tokens long, cached_tokens long, reasoning_tokens long"


def recording_chat(client: Pool | Client, recorder: UsageRecorder | None = None, clock: Callable[[], float] = time.monotonic) -> Callable[[str, list[dict], int], str]:
    """The function that an enrichment plan calls, over a client whose usage is
    recorded."""

    def chat(step: str, messages: list[dict], max_tokens: int) -> str:
        began = clock()
        text, usage = client.chat_with_usage(messages, max_tokens=max_tokens, step=step)
        if recorder is not None:
            recorder.add(step, usage, (clock() - began) * 1000)
        return text

    return chat
