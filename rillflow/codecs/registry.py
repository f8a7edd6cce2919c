"""Schema registries: one in memory, one in a folder, and one over HTTP with the usual REST paths."""

from __future__ import annotations

import base64
import json
import urllib.parse
import urllib.request
from dataclasses import dataclass
from pathlib import Path


class RegistryError(LookupError):
    pass


@dataclass(frozen=True)
class Registered:
    id: int
    subject: str
    version: int
    schema: str


class Registry:
    """In memory. A schema has one id wherever it is registered; a subject's versions count from 1."""

    def __init__(self) -> None:
        self._ids: dict[str, int] = {}
        self._subjects: dict[str, list[int]] = {}

    def register(self, subject: str, schema: str) -> int:
        number = self._ids.setdefault(schema, len(self._ids) + 1)
        versions = self._subjects.setdefault(subject, [])
        if number not in versions:
            versions.append(number)
        return number

    def schema(self, number: int) -> str:
        for text, i in self._ids.items():
            if i == number:
                return text
        raise RegistryError(f"no schema {number}")

    def subjects(self) -> list[str]:
        return sorted(self._subjects)

    def latest(self, subject: str) -> Registered:
        if subject not in self._subjects:
            raise RegistryError(f"no subject {subject!r}")
        versions = self._subjects[subject]
        return Registered(versions[-1], subject, len(versions), self.schema(versions[-1]))


class FolderRegistry(Registry):
    """Kept in a file of a folder; for one writer at a time."""

    def __init__(self, folder: str | Path):
        super().__init__()
        self._file = Path(folder) / "registry.json"
        if self._file.exists():
            raw = json.loads(self._file.read_text(encoding="utf-8"))
            self._ids, self._subjects = raw["ids"], raw["subjects"]

    def register(self, subject: str, schema: str) -> int:
        number = super().register(subject, schema)
        self._file.parent.mkdir(parents=True, exist_ok=True)
        part = self._file.with_suffix(".part")
        part.write_text(json.dumps({"ids": self._ids, "subjects": self._subjects}), encoding="utf-8")
        part.replace(self._file)
        return number


class HttpRegistry(Registry):
    """Not tried against a server here: there is no network."""

    def __init__(self, url: str, user: str = "", password: str = ""):
        super().__init__()
        self._url, self._auth = url.rstrip("/"), base64.b64encode(f"{user}:{password}".encode()).decode() if user else ""

    def _call(self, path: str, body: dict | None = None) -> dict | list:
        request = urllib.request.Request(self._url + path, json.dumps(body).encode() if body else None, {"Content-Type": "application/vnd.schemaregistry.v1+json"} | ({"Authorization": f"Basic {self._auth}"} if self._auth else {}))
        try:
            with urllib.request.urlopen(request, timeout=30) as answer:
                return json.load(answer)
        except OSError as e:
            raise RegistryError(f"{path}: {e}") from e

    def register(self, subject: str, schema: str) -> int:
        if schema not in self._ids:
            self._ids[schema] = int(self._call(f"/subjects/{urllib.parse.quote(subject, safe='')}/versions", {"schema": schema, "schemaType": "AVRO"})["id"])
        return self._ids[schema]

    def schema(self, number: int) -> str:
        try:
            return super().schema(number)
        except RegistryError:
            text = self._call(f"/schemas/ids/{number}")["schema"]
            self._ids[text] = number
            return text

    def subjects(self) -> list[str]:
        return sorted(self._call("/subjects"))

    def latest(self, subject: str) -> Registered:
        raw = self._call(f"/subjects/{urllib.parse.quote(subject, safe='')}/versions/latest")
        return Registered(raw["id"], subject, raw["version"], raw["schema"])
