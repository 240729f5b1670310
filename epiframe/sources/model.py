"""A bounded client of a vision model: a call budget, back-off, strict answers, one repair that may not change values; and an HTTP sender."""

from __future__ import annotations

import base64
import json
import math
import time
import urllib.error
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass, field

from ..functions.jsontext import StrictJSONError, canonical, equal, only_object, stable_hash, strict_loads
from ..functions.text import OOM_MARKS

CALLS, TIMEOUT_S, WAITS = 4, 120.0, (1.0, 2.0, 4.0)


class ModelCallError(RuntimeError):
    """A call that failed for good."""


class ModelOutOfMemory(ModelCallError):
    """The server has no memory for the request; such a request is never sent again."""


class InvalidModelResponse(ModelCallError):
    """An answer that is not of the asked form, repair included."""


class Transient(Exception):
    """What a sender raises for timeouts, broken connections, 429 and 5xx."""


class Malformed(Exception):
    """What a sender raises for an answer without a text in its envelope."""


def retry_waits(value) -> tuple[float, ...]:
    """Waiting times before repeated calls, from a number or several; finite and not negative."""
    given = [value] if isinstance(value, (int, float)) else list(value) if isinstance(value, (list, tuple)) else []
    if not given or any(isinstance(v, bool) or not isinstance(v, (int, float)) for v in given):
        raise ValueError("a number or several are needed")
    try:
        out = tuple(map(float, given))
    except OverflowError as e:
        raise ValueError("too large") from e
    if any(not math.isfinite(v) or v < 0 for v in out):
        raise ValueError("waiting times are finite and not negative")
    return out


def transient_status(status: int | None) -> bool:
    return status is not None and (status == 429 or 500 <= status <= 599)


def envelope_text(raw: bytes) -> str:
    """choices[0].message.content of a chat completion."""
    try:
        content = json.loads(raw)["choices"][0]["message"]["content"]
    except (ValueError, LookupError, TypeError) as e:
        raise Malformed(type(e).__name__) from None
    if not isinstance(content, str):
        raise Malformed("the content is no text")
    return content


def chat_request(model: str, prompt: str, frames: list, schema: dict | None = None) -> dict:
    """A chat completion's body: the prompt, then each frame with its camera, number and time."""
    parts: list[dict] = [{"type": "text", "text": prompt}]
    for f in frames:
        parts.append({"type": "text", "text": f"{f.camera_key} frame {f.frame_index} ({f.timestamp_seconds:.3f} s)"})
        parts.append({"type": "image_url", "image_url": {"url": "data:image/jpeg;base64," + base64.b64encode(f.jpeg).decode()}})
    body: dict = {"model": model, "temperature": 0, "messages": [{"role": "user", "content": parts}]}
    if schema is not None:
        body["response_format"] = {"type": "json_schema", "json_schema": {"name": "answer", "schema": schema, "strict": True}}
    return body


@dataclass(frozen=True)
class HttpSender:
    """A sender to an endpoint of chat completions, without proxies of the environment. Its failures say no more than their kind."""

    endpoint: str
    model: str
    api_key: str = "local"
    schema: dict | None = None
    open: Callable | None = None

    def __call__(self, prompt: str, frames: list, timeout: float) -> str:
        body = json.dumps(chat_request(self.model, prompt, frames, self.schema)).encode()
        request = urllib.request.Request(f"{self.endpoint}/chat/completions", body, {"Content-Type": "application/json", "Authorization": f"Bearer {self.api_key}"})
        opener = self.open or urllib.request.build_opener(urllib.request.ProxyHandler({})).open
        try:
            with opener(request, timeout=timeout) as r:
                raw = r.read()
        except urllib.error.HTTPError as e:
            told = e.read(1 << 16).decode(errors="replace")
            if out_of_memory(told):
                raise Transient("out of memory") from None
            if transient_status(e.code):
                raise Transient(f"status {e.code}") from None
            raise ModelCallError(f"status {e.code}") from None
        except (TimeoutError, ConnectionError, urllib.error.URLError) as e:
            raise Transient(type(e).__name__) from None
        return envelope_text(raw)


@dataclass
class Client:
    """send takes (prompt, frames, timeout) and returns the answer's text; check raises ValueError for a wrong value."""

    send: Callable[[str, list, float], str]
    sleep: Callable[[float], None] = time.sleep
    calls: int = CALLS
    waits: float | tuple = WAITS
    answers: dict = field(default_factory=dict)

    def complete(self, prompt: str, frames: list, check: Callable[[dict], None]) -> dict:
        """The answer's object. Equal requests are answered from what is at hand, so a repeated task asks nothing anew."""
        key = stable_hash([prompt, [[f.camera_key, f.frame_index] for f in frames]])
        if key not in self.answers:
            self.answers[key] = self._ask(prompt, frames, check)
        return self.answers[key]

    def _ask(self, prompt: str, frames: list, check: Callable[[dict], None]) -> dict:
        left, repairing, base, wait, waits = self.calls, False, None, 0, retry_waits(self.waits)
        while left:
            left -= 1
            try:
                text = self.send(prompt, [] if repairing else frames, TIMEOUT_S)
            except Transient as e:
                if out_of_memory(str(e)):
                    raise ModelOutOfMemory(str(e)) from e
                if not left:
                    raise ModelCallError("the calls are used up") from e
                self.sleep(waits[min(wait, len(waits) - 1)])
                wait += 1
                continue
            except Malformed as e:
                raise InvalidModelResponse("the answer's envelope is malformed") from e
            try:
                value = strict_loads(text)
                if repairing and base is not None and not equal(value, base):
                    raise StrictJSONError("the repair changed values")
                check(value)
                return value
            except ValueError as e:
                if repairing or not left:
                    raise InvalidModelResponse(str(e)) from e
                repairing, base = True, only_object(text)
                prompt = repair_prompt(text, str(e))
        raise ModelCallError("the calls are used up")


def repair_prompt(text: str, error: str) -> str:
    return f"Give the following answer again as one JSON object and nothing else. Keep all its values. It was refused for: {error}\n{canonical({'answer': text})}"


def out_of_memory(text: str) -> bool:
    low = text.lower()
    return any(m in low for m in OOM_MARKS[:-1]) or " oom" in f" {low}"
