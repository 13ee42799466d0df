"""The one exception of the engine; `code` is stable, the message is for people."""

from __future__ import annotations


class EngineError(Exception):
    def __init__(self, code: str, message: str) -> None:
        super().__init__(f"{code}: {message}")
        self.code, self.message = code, message
