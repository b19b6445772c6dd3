"""Services that embed texts and name sections, behind two small interfaces."""

from __future__ import annotations

import hashlib
import json
import os
import time
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol, TypeVar

# Fixed values.
ATTEMPTS = 3
FIRST_WAIT, LONGEST_WAIT = 2.0, 10.0
EMBED_CALL_SIZE = 8
VECTOR_DIMENSION = 1536
TIMEOUT_SECONDS = 60.0

R = TypeVar("R")


class ProviderError(RuntimeError):
    """A service call failed for good; `done` has what earlier calls for the same texts brought."""

    def __init__(self, message: str, done: list[list[float]] | None = None):
        super().__init__(message)
        self.done = done or []

    def __reduce__(self) -> tuple:
        return type(self), (str(self), self.done)


class EmbeddingProvider(Protocol):
    def embed(self, texts: list[str]) -> list[list[float]]: ...


class TitleProvider(Protocol):
    def title(self, text: str) -> str: ...


def with_retries(call: Callable[[], R], sleep: Callable[[float], None] = time.sleep) -> R:
    """Up to three attempts with exponential waits of two to ten seconds."""
    for attempt in range(ATTEMPTS):
        try:
            return call()
        except Exception as exc:
            if attempt == ATTEMPTS - 1:
                raise ProviderError(f"call failed after {ATTEMPTS} attempts: {exc}") from exc
            sleep(min(LONGEST_WAIT, max(FIRST_WAIT, 2.0**attempt)))
    raise AssertionError


def _post(url: str, key_variable: str, timeout: float, payload: dict) -> dict:
    request = urllib.request.Request(
        url,
        data=json.dumps(payload).encode(),
        headers={
            "Authorization": f"Bearer {os.environ.get(key_variable, '')}",
            "Content-Type": "application/json",
        },
    )
    with urllib.request.urlopen(request, timeout=timeout) as answer:
        return json.load(answer)


@dataclass
class HttpEmbedder:
    """An HTTP endpoint with the usual `{model, input}` → `{data: [{embedding}]}` contract.

    The key stays in an environment variable of the executors and never enters the plan.
    """

    url: str
    model: str
    key_variable: str = "EMBEDDING_API_KEY"
    dimension: int = VECTOR_DIMENSION
    call_size: int = EMBED_CALL_SIZE
    timeout: float = TIMEOUT_SECONDS
    post: Callable[[str, str, float, dict], dict] = _post
    sleep: Callable[[float], None] = time.sleep

    def __post_init__(self) -> None:
        if self.call_size <= 0:
            raise ValueError("call_size must be positive")

    def _call(self, texts: list[str]) -> list[list[float]]:
        payload = {
            "model": self.model,
            "input": texts,
            "encoding_format": "float",
            "dimensions": self.dimension,
        }
        data = self.post(self.url, self.key_variable, self.timeout, payload).get("data", [])
        vectors = [[float(v) for v in item["embedding"]] for item in data]
        if len(vectors) != len(texts):
            raise ProviderError(f"expected {len(texts)} embeddings, got {len(vectors)}")
        return vectors

    def embed(self, texts: list[str]) -> list[list[float]]:
        vectors: list[list[float]] = []
        for at in range(0, len(texts), self.call_size):
            part = texts[at : at + self.call_size]
            try:
                vectors += with_retries(lambda part=part: self._call(part), self.sleep)
            except ProviderError as exc:
                exc.done = vectors
                raise
        return vectors


@dataclass
class HttpTitles:
    """A chat endpoint that names a chunk in a few words.

    parameters: further fields of the request, such as temperature or a token limit.
    """

    url: str
    model: str
    prompt: str = "Name the topic of the following text in at most ten characters. Answer with the name only.\n"
    key_variable: str = "EMBEDDING_API_KEY"
    timeout: float = TIMEOUT_SECONDS
    parameters: dict = field(default_factory=dict)
    post: Callable[[str, str, float, dict], dict] = _post
    sleep: Callable[[float], None] = time.sleep

    def title(self, text: str) -> str:
        payload = {
            "model": self.model,
            "messages": [{"role": "user", "content": self.prompt + text}],
            "stream": False,
            **self.parameters,
        }

        def call() -> str:
            answer = self.post(self.url, self.key_variable, self.timeout, payload)
            return (answer["choices"][0]["message"].get("content") or "").strip()

        return with_retries(call, self.sleep)


@dataclass
class DigestEmbedder:
    """Offline stand-in: component `i` is read off the MD5 digest of `"{i}:{text}"`.

    The first 24 bits give a value in [-1, 1) that a float holds exactly. Texts
    that contain `fails_on` make their call of `call_size` texts fail.
    """

    dimension: int = 8
    fails_on: str | None = None
    call_size: int = EMBED_CALL_SIZE

    def embed(self, texts: list[str]) -> list[list[float]]:
        vectors: list[list[float]] = []
        for at in range(0, len(texts), self.call_size):
            part = texts[at : at + self.call_size]
            if self.fails_on is not None and any(self.fails_on in text for text in part):
                raise ProviderError(f"refused text with {self.fails_on!r}", vectors)
            vectors += [self._vector(text) for text in part]
        return vectors

    def _vector(self, text: str) -> list[float]:
        digests = (hashlib.md5(f"{i}:{text}".encode()).hexdigest() for i in range(self.dimension))
        return [int(d[:6], 16) / 2**23 - 1 for d in digests]


@dataclass
class DigestTitles:
    """Offline stand-in: names a text by its digest, and fails where that starts with `fails_on`."""

    fails_on: str = "0"

    def title(self, text: str) -> str:
        digest = hashlib.md5(text.encode()).hexdigest()
        if digest.startswith(self.fails_on):
            raise ProviderError("no title")
        return digest[:8]
