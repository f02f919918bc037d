"""One JSON line per record, sorted keys, text as it is; errors go to stderr."""

from __future__ import annotations

import json
import sys
import traceback
from collections.abc import Mapping
from typing import Any

from pydantic import BaseModel


def plain(value: Any) -> Any:
    """The value as JSON can say it; what JSON doesn't know becomes its string."""
    match value:
        case BaseModel():
            return value.model_dump(mode="json")
        case Mapping():
            return {str(k): plain(v) for k, v in value.items()}
        case list() | tuple() | set() | frozenset():
            return [plain(v) for v in value]
        case None | bool() | int() | float() | str():
            return value
    return str(value)


class JsonLog:
    def __init__(self, component: str) -> None:
        self.component = component

    def _say(self, severity: str, message: str, fields: dict[str, Any]) -> None:
        record = {"severity": severity, "message": message, "component": self.component} | {k: plain(v) for k, v in fields.items()}
        print(json.dumps(record, ensure_ascii=False, sort_keys=True), file=sys.stderr if severity == "ERROR" else sys.stdout, flush=True)

    def info(self, message: str, **fields: Any) -> None:
        self._say("INFO", message, fields)

    def warning(self, message: str, **fields: Any) -> None:
        self._say("WARNING", message, fields)

    def error(self, message: str, **fields: Any) -> None:
        self._say("ERROR", message, fields)

    def exception(self, message: str, *, error: BaseException, **fields: Any) -> None:
        told = {"type": type(error).__name__, "message": str(error), "stacktrace": "".join(traceback.format_exception(error)).strip()}
        self._say("ERROR", message, {"error": told} | fields)
