"""Chat clients for use inside tasks: any callable (messages, seed) -> str that can be pickled."""

from __future__ import annotations

import functools
import hashlib
import json
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

Chat = Callable[[list[dict], int | None], str]


class ChatError(RuntimeError):
    """All tries failed."""


@dataclass(frozen=True)
class HttpChat:
    """A chat-completions endpoint, with retries on time-outs, refusals and error codes."""

    url: str
    model: str
    key: str = ""
    temperature: float = 0.8
    max_tokens: int = 800
    timeout: float = 120.0
    tries: int = 3
    thinking: bool = False

    def __call__(self, messages: list[dict], seed: int | None = None) -> str:
        body = {"model": self.model, "messages": messages, "temperature": self.temperature, "max_tokens": self.max_tokens, "chat_template_kwargs": {"enable_thinking": self.thinking}}
        if seed is not None:
            body["seed"] = seed
        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        last: Exception | None = None
        for k in range(self.tries):
            try:
                request = urllib.request.Request(self.url, json.dumps(body).encode(), head)
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                    return json.load(reply)["choices"][0]["message"]["content"] or ""
            except (urllib.error.URLError, TimeoutError, OSError, KeyError, IndexError, ValueError) as error:
                last = error
                if k + 1 < self.tries:
                    time.sleep(2**k)
        raise ChatError(f"no reply after {self.tries} tries: {last}")


@dataclass(frozen=True)
class HttpEmbedder:
    """An embeddings endpoint; vectors come back with unit length. Null for a text if all tries fail, so a run goes on without."""

    url: str
    model: str
    key: str = ""
    timeout: float = 60.0
    tries: int = 3
    batch: int = 64

    def __call__(self, texts: list[str]) -> list[list[float] | None]:
        out: list[list[float] | None] = []
        for i in range(0, len(texts), self.batch):
            part = texts[i : i + self.batch]
            out += self._ask(part) or [None] * len(part)
        return out

    def _ask(self, texts: list[str]) -> list[list[float]] | None:
        head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {self.key}"} if self.key else {})
        for k in range(self.tries):
            try:
                request = urllib.request.Request(self.url, json.dumps({"model": self.model, "input": texts}).encode(), head)
                with urllib.request.urlopen(request, timeout=self.timeout) as reply:
                    rows = sorted(json.load(reply)["data"], key=lambda r: r["index"])
                if len(rows) == len(texts):
                    return [unit(r["embedding"]) for r in rows]
            except (urllib.error.URLError, TimeoutError, OSError, KeyError, ValueError):
                pass
            if k + 1 < self.tries:
                time.sleep(2**k)
        return None


@dataclass(frozen=True)
class LocalEmbedder:
    """A sentence-transformers model, loaded once per worker; null vectors where the package or the model is missing."""

    model: str
    device: str | None = None

    def __call__(self, texts: list[str]) -> list[list[float] | None]:
        encoder = _encoder(self.model, self.device)
        return [None] * len(texts) if encoder is None else [unit(v) for v in encoder.encode(texts)]


@functools.cache
def _encoder(model: str, device: str | None):
    try:
        from sentence_transformers import SentenceTransformer
    except ImportError:
        return None
    for place in dict.fromkeys((device, "cpu")):  # the device asked for (or the best), then the processor
        try:
            return SentenceTransformer(model, device=place)
        except (OSError, RuntimeError, ValueError):
            continue
    return None


def unit(vector) -> list[float]:
    size = sum(float(x) ** 2 for x in vector) ** 0.5 or 1.0
    return [float(x) / size for x in vector]


@dataclass(frozen=True)
class StubChat:
    """Deterministic replies by a hash of the last message and the seed; for tests and dry runs.

    `fail_every` raises for that share of prompts, `good` is the share of drafts in script.
    """

    good: float = 0.7
    passes: float = 0.7
    fail_every: int = 0

    def __call__(self, messages: list[dict], seed: int | None = None) -> str:
        text = messages[-1]["content"]
        h = int(hashlib.md5(f"{seed}|{text}".encode()).hexdigest()[:8], 16)
        if self.fail_every and seed is not None and seed % self.fail_every == 0:
            raise ChatError("stub failure")
        if "axis1" in text:
            ok = (h % 100) < 100 * self.passes
            return json.dumps({"axis1": {"verdict": "PASS" if ok else "FAIL", "reason": "" if ok else "does not fit"}, "axis2": {"verdict": "PASS", "reason": ""}})
        if '"verdict"' in text:
            ok = (h % 100) < 100 * self.passes
            return json.dumps({"verdict": "PASS" if ok else "FAIL", "is_bengali": True, "reasons": [] if ok else ["too stiff"]})
        body = f"আমার কাজ {h % 97} কিভাবে করব" if (h % 1000) < 1000 * self.good else f"amar kaj {h % 97}"
        return f"<think>…</think><draft_questions>{body}</draft_questions>"


def hash_embedder(dim: int = 384) -> Callable[[list[str]], list[list[float]]]:
    """A stand-in for a sentence model: unit vectors from hashed tokens."""

    def embed(texts: list[str]) -> list[list[float]]:
        out = []
        for t in texts:
            v = [0.0] * dim
            for w in t.split():
                h = int(hashlib.md5(w.encode()).hexdigest()[:8], 16)
                v[h % dim] += 1.0 if h & 1024 else -1.0
            n = sum(x * x for x in v) ** 0.5 or 1.0
            out.append([x / n for x in v])
        return out

    return embed
