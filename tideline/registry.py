"""Schema registries: in memory, in a file, or over HTTP. One id per (subject, schema text)."""

from __future__ import annotations

import json
import os
import tempfile
import urllib.error
import urllib.request
from abc import ABC, abstractmethod

from .functions.naming import subject_name


class RegistryError(RuntimeError):
    pass


class Registry(ABC):
    @abstractmethod
    def register(self, subject: str, schema: str) -> int:
        """Id of ``schema`` under ``subject``; the same text keeps its id."""

    def register_table(self, topic: str, key_schema: str | None, row_schema: str) -> tuple[int | None, int]:
        """Key schema first, then the row's."""
        key_id = None if key_schema is None else self.register(subject_name(topic, "key"), key_schema)
        return key_id, self.register(subject_name(topic, "value"), row_schema)


class MemoryRegistry(Registry):
    def __init__(self) -> None:
        self.ids: dict[str, int] = {}
        self.subjects: dict[str, list[int]] = {}

    def register(self, subject: str, schema: str) -> int:
        number = self.ids.setdefault(schema, len(self.ids) + 1)
        versions = self.subjects.setdefault(subject, [])
        if number not in versions:
            versions.append(number)
        return number


class FileRegistry(MemoryRegistry):
    """Kept as one JSON file, replaced atomically after every new registration."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self.path = path
        if os.path.exists(path):
            with open(path, encoding="utf-8") as f:
                saved = json.load(f)
            self.ids, self.subjects = saved["ids"], saved["subjects"]

    def register(self, subject: str, schema: str) -> int:
        before = json.dumps([self.ids, self.subjects])
        number = super().register(subject, schema)
        if json.dumps([self.ids, self.subjects]) != before:
            folder = os.path.dirname(os.path.abspath(self.path))
            os.makedirs(folder, exist_ok=True)
            with tempfile.NamedTemporaryFile("w", dir=folder, delete=False, encoding="utf-8") as f:
                json.dump({"ids": self.ids, "subjects": self.subjects}, f)
            os.replace(f.name, self.path)
        return number


class HttpRegistry(Registry):
    CONTENT = "application/vnd.schemaregistry.v1+json"

    def __init__(self, url: str = "http://localhost:8081", timeout: float = 10.0) -> None:
        self.url = url.rstrip("/")
        self.timeout = timeout

    def register(self, subject: str, schema: str) -> int:
        request = urllib.request.Request(
            f"{self.url}/subjects/{subject}/versions",
            data=json.dumps({"schema": schema}).encode(),
            headers={"Content-Type": self.CONTENT, "Accept": self.CONTENT},
            method="POST",
        )
        try:
            with urllib.request.urlopen(request, timeout=self.timeout) as answer:
                body = json.loads(answer.read())
        except (urllib.error.URLError, ValueError, OSError) as e:
            raise RegistryError(f"registering {subject} failed: {e}") from e
        if not isinstance(body, dict) or not isinstance(body.get("id"), int):
            raise RegistryError(f"registering {subject}: no id in {body!r}")
        return body["id"]
