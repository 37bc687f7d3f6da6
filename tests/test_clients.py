"""Chat clients over scripted transports: routing, attempts, errors, usage."""

import json

import pytest

from folioforge.plans import clients as K


def ok(text="hi", **usage):
    return 200, json.dumps({"choices": [{"message": {"content": text}}], "usage": usage})


class Script:
    """A transport that gives the listed answers in turn; exceptions are raised."""

    def __init__(self, *answers):
        self.answers, self.seen, self.waits = list(answers), [], []

    def post(self, url, headers, body, timeout):
        self.seen.append((url, headers, json.loads(body)))
        a = self.answers.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    def sleep(self, s):
        self.waits.append(s)


ENTRIES = [{"id": f"b{i}", "endpoint": f"https://h{i}/", "deployment": f"d{i}", "apiKey": f"k{i}", "apiVersion": "v", **({"kind": "openai", "model": "m"} if i == 2 else {})} for i in range(3)]


def pool(s, **settings):
    return K.Pool.load(json.dumps(ENTRIES), post=s.post, sleep=s.sleep, **settings)


def test_both_dialects():
    s = Script(ok(), ok(), ok())
    p = pool(s, step_models={"S": "adapter"}, template={"thinking": False})
    for _ in range(3):
        p.chat([{"role": "user", "content": "x"}], step="S")
    assert [u for u, _, _ in s.seen] == ["https://h0/openai/deployments/d0/chat/completions?api-version=v", "https://h1/openai/deployments/d1/chat/completions?api-version=v", "https://h2/v1/chat/completions"]
    assert s.seen[0][1]["api-key"] == "k0" and "model" not in s.seen[0][2]
    assert s.seen[2][1]["Authorization"] == "Bearer k2" and s.seen[2][2]["model"] == "adapter" and s.seen[2][2]["chat_template_kwargs"] == {"thinking": False}


def test_stable_routing_takes_the_next_back_end_at_each_attempt():
    s = Script((503, ""), (404, ""), ok("done", prompt_tokens=3, completion_tokens=4))
    p = pool(s, routing="stable")
    text, usage = p.chat_with_usage([{"role": "user", "content": "x"}], step="S")
    hosts = [u.split("/")[2] for u, _, _ in s.seen]
    assert text == "done" and usage["total_tokens"] == 7 and s.waits == [1.0, 2.0] and len(set(hosts)) == 3
    first = p.backend_for([{"role": "user", "content": "x"}], "S")
    assert first.endpoint == f"https://{hosts[0]}/" and first == p.backend_for([{"role": "user", "content": "x"}], "S")


def test_errors():
    with pytest.raises(K.ContentFiltered):
        pool(Script((400, '{"error": {"code": "content_filter"}}'))).chat([])
    with pytest.raises(K.CallError, match="HTTP 401: no key"):
        pool(Script((401, " no key "))).chat([])
    s = Script(OSError("down"), OSError("down"), OSError("down"))
    with pytest.raises(K.CallError, match="after 3 attempts: down"):
        pool(s).chat([])
    assert s.waits == [1.0, 2.0, 4.0]
    with pytest.raises(RuntimeError):
        K.Pool([])
    with pytest.raises(ValueError):
        pool(Script(), routing="any")
    with pytest.raises(ValueError):
        K.Pool([K.Backend("a", "e", "d", "k", kind="x")])


def test_a_single_client():
    s = Script((400, "Provider returned error"), ok([{"type": "text", "text": "a"}, {"type": "image"}, {"type": "text", "text": "b"}]))
    c = K.Client("key", "model", "https://x/v1/", {"reasoning": {"enabled": False}}, s.post, s.sleep)
    assert c.chat([{"role": "user", "content": "q"}], max_tokens=5) == "ab"
    assert s.seen[0][0] == "https://x/v1/chat/completions" and s.seen[0][2]["reasoning"] == {"enabled": False} and s.seen[0][2]["max_tokens"] == 5
    with pytest.raises(ValueError):
        K.Client("", "model", "u")
    with pytest.raises(K.CallError):
        K.Client("k", "m", "u", post=Script((404, "gone")).post).chat([])


def test_usage_is_recorded():
    r, ticks = K.UsageRecorder(), iter([1.0, 1.25, 2.0, 2.06789])
    s = Script(ok(prompt_tokens=1, completion_tokens=2, total_tokens=9, prompt_tokens_details={"cached_tokens": 1}), ok())
    chat = K.recording_chat(pool(s), r, lambda: next(ticks))
    assert chat("A", [], 10) == "hi" and chat("B", [], 10) == "hi"
    assert r.calls == [
        {"stage": "A", "latency_ms": 250.0, "prompt_tokens": 1, "completion_tokens": 2, "total_tokens": 9, "cached_tokens": 1, "reasoning_tokens": 0},
        {"stage": "B", "latency_ms": 67.9, "prompt_tokens": 0, "completion_tokens": 0, "total_tokens": 0, "cached_tokens": 0, "reasoning_tokens": 0},
    ]
    assert K.error_text("  ") == "<empty body>" and len(K.error_text("x" * 900)) == 500
