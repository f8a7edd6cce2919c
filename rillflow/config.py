"""Transform files: which topics lie in which pools, and the rules from inputs to outputs."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

import yaml


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Route:
    topic: str
    pool: str


@dataclass(frozen=True)
class Rule:
    """``select`` maps output paths (``key``, ``value.ID``) to SQL expressions over ``left`` and ``right``, or ``in``; or it is a
    function from a frame with those columns to one with key and value."""

    type: str
    out: str
    select: dict[str, str] | Callable[[Any], Any]
    where: str = ""
    in_: str = ""
    left: str = ""
    right: str = ""
    join_on: str = ""

    @property
    def topics(self) -> list[str]:
        return [self.left, self.right] if self.type == "denorm" else [self.in_]

    def sides(self) -> tuple[str, str]:
        """Both sides of join-on."""
        two = [x.strip() for x in re.sub(r"==", "=", self.join_on).split("=")]
        if not self.join_on or len(two) != 2 or not all(two):
            raise ConfigError(f"join-on needs the form 'left.x = right.y', not {self.join_on!r}")
        return two[0], two[1]


@dataclass(frozen=True)
class Transform:
    inputs: list[Route]
    outputs: list[Route]
    rules: list[Rule]


@dataclass
class Routes:
    """pool of each topic; outputs of each input and inputs of each output, in the order of the rules."""

    pools: dict[str, str]
    outputs_of: dict[str, list[str]] = field(default_factory=dict)
    inputs_of: dict[str, list[str]] = field(default_factory=dict)

    def enter(self, source: str, out: str) -> None:
        for topic in (source, out):
            if topic not in self.pools:
                raise ConfigError(f"topic {topic!r} has no pool")
        others = self.outputs_of.setdefault(source, [])
        if any(self.pools[o] != self.pools[out] for o in others):
            raise ConfigError(f"input topic {source!r} is routed to several pools: {self.pools[others[0]]!r} and {self.pools[out]!r}")
        for some, one in ((others, out), (self.inputs_of.setdefault(out, []), source)):
            if one not in some:
                some.append(one)


def routes(transform: Transform) -> Routes:
    """Checks a transform."""
    pools: dict[str, str] = {}
    for r in [*transform.inputs, *transform.outputs]:
        if not r.topic or not r.pool:
            raise ConfigError("a route needs both a topic and a pool")
        if r.topic in pools:
            raise ConfigError(f"topic {r.topic!r} is routed twice")
        pools[r.topic] = r.pool
    out = Routes(pools)
    for rule in transform.rules:
        if rule.type == "denorm":
            if not rule.left or not rule.right:
                raise ConfigError("a denorm rule needs both 'left' and 'right'")
            if rule.in_:
                raise ConfigError("a denorm rule has no 'in'")
            rule.sides()
        elif rule.type == "stateless":
            if not rule.in_:
                raise ConfigError("a stateless rule needs 'in'")
            if rule.left or rule.right:
                raise ConfigError("a stateless rule has no 'left' or 'right'")
        else:
            raise ConfigError(f"unknown rule type {rule.type!r}")
        if not rule.select:
            raise ConfigError("a rule needs 'select'")
        for topic in rule.topics:
            out.enter(topic, rule.out)
    return out


def parse(text: str) -> Transform:
    raw = yaml.safe_load(text) or {}
    if not isinstance(raw, dict):
        raise ConfigError("a transform is a mapping")
    unknown = set(raw) - {"inputs", "output", "transforms"}
    if unknown:
        raise ConfigError(f"unknown settings: {sorted(unknown)}")
    route = lambda x: Route(str(x.get("topic") or ""), str(x.get("pool") or ""))
    output = raw.get("output") or []
    output = output if isinstance(output, list) else [output]
    rules = []
    for x in raw.get("transforms") or []:
        if odd := set(x) - {"type", "in", "left", "right", "join-on", "out", "where", "select"}:
            raise ConfigError(f"unknown settings of a rule: {sorted(map(str, odd))}")
        text_of = lambda k, x=x: str(x.get(k) or "")
        rules.append(Rule(text_of("type"), text_of("out"), {str(k): str(v) for k, v in (x.get("select") or {}).items()}, text_of("where"), text_of("in"), text_of("left"), text_of("right"), text_of("join-on")))
    made = Transform([route(x) for x in raw.get("inputs") or []], [route(x) for x in output], rules)
    routes(made)
    return made


def load(path: str | Path) -> Transform:
    return parse(Path(path).read_text(encoding="utf-8"))


def load_script(path: str | Path | None) -> str:
    """An optional script's text; no path, no text."""
    return Path(path).read_text(encoding="utf-8") if path else ""


_UNITS = {"ns": 1e-9, "us": 1e-6, "µs": 1e-6, "ms": 1e-3, "s": 1.0, "m": 60.0, "h": 3600.0}


def seconds(text: str) -> float:
    """A duration like ``5s`` or ``1m30s``."""
    parts = re.findall(r"(\d+(?:\.\d+)?)(ns|us|µs|ms|s|m|h)", text)
    if not parts or "".join(a + b for a, b in parts) != text:
        raise ConfigError(f"not a duration: {text!r}")
    return sum(float(n) * _UNITS[u] for n, u in parts)


def plural(n: int, what: str) -> str:
    return f"{n} {what}" if n == 1 else f"{n} {what}s"
