"""A chat-completion service as a policy for `operators.expand.roll_with`."""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

Post = Callable[[str, bytes, float], bytes]


def _post(url: str, body: bytes, timeout: float) -> bytes:
    request = urllib.request.Request(url, body, {"Content-Type": "application/json"}, method="POST")
    with urllib.request.urlopen(request, timeout=timeout) as answer:  # noqa: S310
        return answer.read()


@dataclass(frozen=True)
class ChatPolicy:
    """Asks `{base_url}/chat/completions` for the next assistant turn; errors fail the task.

    Picklable, so it can be sent to executors; `post` can be replaced in tests.  Spark
    repeats a failed task, so a call may be made more than once.
    """

    base_url: str
    model: str
    temperature: float = 1.0
    max_tokens: int = 1024
    timeout: float = 120
    post: Post = _post

    def __call__(self, messages: list[dict[str, str]], step: int) -> str:
        body = {
            "model": self.model,
            "messages": messages,
            "temperature": self.temperature,
            "max_tokens": self.max_tokens,
        }
        url = self.base_url.rstrip("/") + "/chat/completions"
        answer = json.loads(self.post(url, json.dumps(body).encode(), self.timeout))
        return str(answer["choices"][0]["message"]["content"] or "")
