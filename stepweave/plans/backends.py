"""Model backends behind one interface, with retry, rate limit and registries."""

from __future__ import annotations

import base64
import hashlib
import json
import os
import random
import time
from abc import ABC, abstractmethod
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column
from pyspark.sql import types as T

from stepweave.functions.images import image_type


@dataclass
class Request:
    text: str
    images: list[bytes] = field(default_factory=list)
    system_prompt: str | None = None
    metadata: dict[str, Any] = field(default_factory=dict)

    def is_multimodal(self) -> bool:
        return bool(self.images)


@dataclass
class Result:
    text: str
    model: str
    finish_reason: str = "stop"
    prompt_tokens: int = 0
    completion_tokens: int = 0
    metadata: dict[str, Any] = field(default_factory=dict)

    def is_complete(self) -> bool:
        return self.finish_reason == "stop"

    def usage(self) -> tuple[int, int, int]:
        return self.prompt_tokens, self.completion_tokens, self.prompt_tokens + self.completion_tokens


class RateLimiter:
    """Even spacing of requests. ``clock`` and ``sleep`` can be replaced in tests."""

    def __init__(self, requests_per_minute: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        if requests_per_minute <= 0:
            raise ValueError("requests_per_minute must be positive")
        self.interval, self._clock, self._sleep, self._next = 60.0 / requests_per_minute, clock, sleep, float("-inf")

    def acquire(self) -> None:
        now = self._clock()
        if now < self._next:
            self._sleep(self._next - now)
            now = self._next
        self._next = now + self.interval

    @staticmethod
    def share(requests_per_minute: float, partitions: int) -> float:
        """What one of several tasks may use."""
        return requests_per_minute / max(1, partitions)


def retried(call: Callable[[], Any], retries: int = 5, base: float = 1.0, most: float = 60.0, errors: tuple = (Exception,), sleep: Callable[[float], None] = time.sleep) -> Any:
    """``call()`` again after an error, with doubling delays and a little jitter; the last error is raised.

    It belongs inside the task: a retry of the whole task would pay for its finished requests again.
    """
    for attempt in range(retries + 1):
        try:
            return call()
        except errors:
            if attempt == retries:
                raise
            sleep(min(most, base * 2**attempt) * (1 + 0.1 * random.random()))


class Backend(ABC):
    """A provider of replies. Instances travel to executors; clients are made there, at first use."""

    provider = "abstract"

    def __init__(self, model_name: str, **options: Any) -> None:
        self.model_name, self.options, self._client = model_name, options, None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_client": None}

    @property
    def supports_multimodal(self) -> bool:
        return True

    @abstractmethod
    def generate(self, request: Request) -> Result: ...

    def generate_each(self, requests: Sequence[Request | Exception]) -> list[Result | Exception]:
        """The result of each request, or the error that it ended with after its retries; one that could not be made keeps its own."""
        rpm = self.options.get("requests_per_minute")
        limiter = RateLimiter(rpm) if rpm else None
        out: list[Result | Exception] = []
        for r in requests:
            if isinstance(r, Exception):
                out.append(r)
                continue
            if limiter:
                limiter.acquire()
            try:
                out.append(retried(lambda r=r: self.generate(r), self.options.get("max_retries", 5), self.options.get("retry_base_delay", 1.0), self.options.get("retry_max_delay", 60.0)))
            except Exception as e:
                out.append(e)
        return out

    def generate_batch(self, requests: Sequence[Request]) -> list[Result]:
        """All results; an error is raised when the others have been asked."""
        out = self.generate_each(requests)
        for r in out:
            if isinstance(r, Exception):
                raise r
        return out

    def health_check(self) -> bool:
        try:
            return bool(self.generate(Request("Reply with OK.")).text)
        except Exception:
            return False


class MockBackend(Backend):
    """Deterministic replies made from the request, for tests and dry runs."""

    provider = "mock"

    def generate(self, request: Request) -> Result:
        frames = request.metadata.get("frames", [])
        seed = hashlib.sha256(request.text.encode()).hexdigest()[:8]
        items = [{"frame_index": f, "task_reasoning": f"task {seed}", "subtask_reasoning": f"part {f}", "move_reasoning": f"move {f}"} for f in frames]
        text = json.dumps(items)
        return Result(text, self.model_name, "stop", len(request.text.split()), len(text.split()), dict(request.metadata))


class _Remote(Backend):
    """Shared by network providers; their packages are imported on the executors only."""

    package = ""

    def client(self) -> Any:
        if self._client is None:
            key = os.environ.get(self.options.get("api_key_env_var", ""), "")
            if not key:
                raise RuntimeError(f"environment variable {self.options.get('api_key_env_var')!r} is not set")
            self._client = self.connect(key)
        return self._client

    def connect(self, key: str) -> Any:
        raise NotImplementedError

    def limits(self) -> dict[str, Any]:
        return {"max_tokens": self.options.get("max_tokens", 1024), "temperature": self.options.get("temperature", 0.0), "top_p": self.options.get("top_p", 1.0)}


def chat_messages(request: Request, detail: str = "auto") -> list[dict]:
    """A request as messages of the widespread chat format, images as data URLs before the text."""
    content: list[dict] = [{"type": "image_url", "image_url": {"url": f"data:{image_type(i) or 'image/jpeg'};base64," + base64.b64encode(i).decode(), "detail": detail}} for i in request.images]
    content.append({"type": "text", "text": request.text})
    system = [{"role": "system", "content": request.system_prompt}] if request.system_prompt else []
    return [*system, {"role": "user", "content": content}]


class OpenAIBackend(_Remote):
    provider = "openai"

    @property
    def supports_multimodal(self) -> bool:
        return self.model_name.startswith(("gpt-4o", "gpt-4-turbo", "gpt-4-vision", "gpt-5", "o1", "o3", "o4"))

    def connect(self, key: str) -> Any:
        import openai

        return openai.OpenAI(api_key=key, base_url=self.options.get("base_url"), timeout=self.options.get("timeout", 120.0))

    def generate(self, request: Request) -> Result:
        got = self.client().chat.completions.create(model=self.model_name, messages=chat_messages(request, self.options.get("detail", "auto")), **self.limits())
        use = got.usage
        return Result(got.choices[0].message.content or "", self.model_name, got.choices[0].finish_reason or "stop", use.prompt_tokens if use else 0, use.completion_tokens if use else 0, dict(request.metadata))


class GeminiBackend(_Remote):
    provider = "gemini"

    def connect(self, key: str) -> Any:
        import google.generativeai as genai

        genai.configure(api_key=key)
        return genai

    def generate(self, request: Request) -> Result:
        genai = self.client()
        model = genai.GenerativeModel(self.model_name, system_instruction=request.system_prompt)
        limits = self.limits()
        parts = [*({"mime_type": image_type(i) or "image/jpeg", "data": i} for i in request.images), request.text]
        got = model.generate_content(parts, generation_config={"max_output_tokens": limits.pop("max_tokens"), **limits}, safety_settings=self.options.get("safety_settings") or None)
        if not got.candidates:  # held back by the provider
            return Result("[BLOCKED]", self.model_name, "safety", metadata=dict(request.metadata))
        use = got.usage_metadata
        return Result(got.text, self.model_name, "stop", use.prompt_token_count, use.candidates_token_count, dict(request.metadata))


class QwenBackend(OpenAIBackend):
    """The provider's endpoint speaks the same chat format."""

    provider = "qwen"

    @property
    def supports_multimodal(self) -> bool:
        return "vl" in self.model_name

    def connect(self, key: str) -> Any:
        import openai

        return openai.OpenAI(api_key=key, base_url=self.options.get("base_url") or "https://dashscope.aliyuncs.com/compatible-mode/v1", timeout=self.options.get("timeout", 120.0))


_BACKENDS: dict[str, type[Backend]] = {b.provider: b for b in (MockBackend, OpenAIBackend, GeminiBackend, QwenBackend)}


def register_backend(name: str, kind: type[Backend]) -> None:
    _BACKENDS[name] = kind


def backend_names() -> list[str]:
    return sorted(_BACKENDS)


def create_backend(config: Any) -> Backend:
    """The backend of a :class:`stepweave.config.BackendConfig` or of a mapping with provider and model_name."""
    options = dict(config) if isinstance(config, dict) else vars(config).copy()
    provider = options.pop("provider")
    if provider not in _BACKENDS:
        raise ValueError(f"backend {provider!r}; one of {', '.join(backend_names())}")
    return _BACKENDS[provider](options.pop("model_name"), **options)


@dataclass(frozen=True)
class Modality:
    """A per-frame extra: its schema and, if there is one, a function from an image column to a column of it."""

    name: str
    schema: T.DataType
    extract: Callable[[Column], Column] | None = None
    description: str = ""


class Modalities:
    """The registry of modalities; ``extract`` functions are pandas UDFs over image columns."""

    def __init__(self) -> None:
        self._known: dict[str, Modality] = {}

    def register(self, name: str, schema: T.DataType, extract: Callable[[Column], Column] | None = None, description: str = "") -> None:
        self._known[name] = Modality(name, schema, extract, description)

    def has(self, name: str) -> bool:
        return name in self._known

    def get(self, name: str) -> Modality:
        if name not in self._known:
            raise KeyError(f"modality {name!r} is not registered; there are {', '.join(sorted(self._known)) or 'none'}")
        return self._known[name]

    def all(self) -> dict[str, Modality]:
        return dict(self._known)


def builtin_modalities() -> Modalities:
    from stepweave.schemas import DEPTH_MAP, SCENE_GRAPH

    out = Modalities()
    out.register("depth_map", DEPTH_MAP, description="distance per pixel")
    out.register("scene_graph", SCENE_GRAPH, description="objects and their relations")
    return out
