"""Clients of language models: a registry of factories, what a configured model calls, and how many calls may run at once."""

from __future__ import annotations

import hashlib
import importlib
import json
import os
import threading
import urllib.request
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from typing import Protocol

from quillon.plans.config import Model, base_url


class Client(Protocol):
    """A client may also have complete_json, of the same arguments, which asks the model for JSON only; it is tried first where
    JSON is wanted."""

    def complete(self, model_name: str, prompt: str) -> str: ...


class StubClient:
    """Deterministic replies out of a hash of the prompt (and of the settings, if there are any): the tested stand-in for a
    model. One reply in `fails` raises."""

    def __init__(self, fails: int = 0, settings: dict | None = None):
        self.fails, self.settings = fails, settings

    def complete(self, model_name: str, prompt: str) -> str:
        told = [model_name, *([json.dumps(self.settings, sort_keys=True)] if self.settings else []), prompt]
        h = int(hashlib.sha1("\n".join(told).encode()).hexdigest()[:8], 16)
        if self.fails and h % self.fails == 0:
            raise ConnectionError("stub")
        if "JSON" not in prompt:
            return f"- answer {h % 1000} of {model_name}"
        rules = ("REDUNDANT", "THIN_CONTENT", "FACT_LOGIC_ISSUE", "NUM_COMPARE_ERROR")
        checks = [{"rule_id": r, "hit": bool(h >> i & 1 and h >> (i + 4) & 1), "severity": "major", "score": (h >> i) % 6, "reason": "stub", "excerpt": ""} for i, r in enumerate(rules)]
        return "```json\n" + json.dumps({"checks": checks, "confidence": "high"}) + "\n```"


class ChatClient:
    """Chat completions over HTTP. Settings: endpoint, api_key_env (the variable that holds the key), timeout (seconds), and
    whatever else a request's body is to hold, such as temperature."""

    OWN = ("endpoint", "api_key_env", "timeout")

    def __init__(self, settings: dict):
        if not settings.get("endpoint"):
            raise ValueError("a chat client needs an endpoint")
        self.url = base_url(settings["endpoint"]) + "/chat/completions"
        self.headers = {"Content-Type": "application/json"}
        if name := settings.get("api_key_env"):
            if name not in os.environ:
                raise ValueError(f"the environment has no {name}, which is to hold the key")
            self.headers["Authorization"] = f"Bearer {os.environ[name]}"
        self.timeout = float(settings.get("timeout", 120))
        self.body = {k: v for k, v in settings.items() if k not in self.OWN}

    def complete(self, model_name: str, prompt: str, **more) -> str:
        body = {"model": model_name, "messages": [{"role": "user", "content": prompt}]} | self.body | more
        request = urllib.request.Request(self.url, json.dumps(body).encode(), self.headers)
        with urllib.request.urlopen(request, timeout=self.timeout) as reply:
            return json.load(reply)["choices"][0]["message"]["content"]

    def complete_json(self, model_name: str, prompt: str) -> str:
        return self.complete(model_name, prompt, response_format={"type": "json_object"})


#: Factories of clients by name, each taking a model's settings; register your own.
CLIENTS: dict[str, Callable[[dict], Client]] = {"stub": lambda settings: StubClient(settings=settings), "chat": ChatClient}


def client_named(name: str) -> Callable[[dict], Client]:
    """A registered factory, or one given as module:attribute; an unknown name is an error."""
    module, colon, attribute = name.partition(":")
    if not colon:
        if name not in CLIENTS:
            raise ValueError(f"client {name!r} is none of {sorted(CLIENTS)}")
        return CLIENTS[name]
    try:
        return getattr(importlib.import_module(module), attribute)
    except (ImportError, AttributeError) as e:
        raise ValueError(f"client {name!r}: {e}") from None


@dataclass(frozen=True)
class Service:
    """What calls a model: a factory of clients, the settings that it gets, and the endpoint whose load it shares."""

    factory: Callable[[dict], Client]
    settings: dict = field(default_factory=dict)
    endpoint: str = ""
    #: Tasks at a time, and calls at a time in each, for all models of the endpoint together.
    partitions: int = 1
    threads: int = 8


def services(models: Iterable[Model], default: str = "stub") -> dict[str, Service]:
    """The service of each configured model by model_name. Of a model's settings, client names the factory (else default does),
    partitions and threads bound the calls of its endpoint, and all others go to the client."""
    out: dict[str, Service] = {}
    load: dict[str, tuple[int, int]] = {}
    for model in models:
        settings = dict(model.settings)
        name = str(settings.pop("client", default))
        partitions, threads = int(settings.pop("partitions", 1)), int(settings.pop("threads", 8))
        if partitions < 1 or threads < 1:
            raise ValueError(f"{model.name}: partitions and threads must be 1 at least")
        endpoint = str(settings.get("endpoint", name))
        if load.setdefault(endpoint, (partitions, threads)) != (partitions, threads):
            raise ValueError(f"{model.name}: models of the endpoint {endpoint!r} state different partitions or threads")
        service = Service(client_named(name), settings, endpoint, partitions, threads)
        if out.setdefault(model.model_name, service) != service:
            raise ValueError(f"{model.model_name} is configured with two sets of settings")
    return out


class Gate:
    """Bounds the calls in flight: a call that succeeds raises the bound by its share of one, one that fails halves it."""

    def __init__(self, most: int):
        self.most, self.limit, self.running = most, float(most), 0
        self.free = threading.Condition()

    def __call__(self, call: Callable[[], str]) -> str:
        with self.free:
            self.free.wait_for(lambda: self.running < int(self.limit))
            self.running += 1
        good = False
        try:
            out = call()
            good = True
            return out
        finally:
            with self.free:
                self.running -= 1
                self.limit = min(self.most, self.limit + 1 / self.limit) if good else max(1.0, self.limit / 2)
                self.free.notify_all()
