"""Check specifications.

A check is declared by four keys — ``check_name``, ``check_type``, optional
``sub_type`` and ``params`` — so a suite can live in YAML, JSON or plain
Python dicts.  Specs are validated when the suite is built: a missing name or
type, or a repeated name, raises immediately instead of being skipped or
silently overwriting an earlier result.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any


class SpecError(ValueError):
    """A check specification is malformed."""


@dataclass(frozen=True)
class CheckSpec:
    name: str
    check_type: str
    sub_type: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)

    @property
    def threshold(self) -> float:
        """The tolerance; 0.0 where ``threshold_error`` finds it unusable (such a check is an ERROR row)."""
        return 0.0 if self.threshold_error() else float(self.params.get("threshold", 0.0))

    def threshold_error(self) -> str | None:
        value = self.params.get("threshold", 0.0)
        try:
            usable = math.isfinite(float(value))
        except (TypeError, ValueError):
            usable = False
        return None if usable else f"parameter 'threshold' is not a finite number: {value!r}"

    @property
    def kind(self) -> str:
        return self.check_type if not self.sub_type else f"{self.check_type}/{self.sub_type}"

    def param(self, key: str, default: Any = None) -> Any:
        return self.params.get(key, default)

    def parameters_json(self) -> str:
        """Parameters as a JSON string; DataFrames and other objects by name."""

        def fallback(obj: Any) -> str:
            return f"<{type(obj).__name__}>"

        def finite(obj: Any) -> Any:
            """JSON has no NaN or infinity: such numbers are given by name."""
            if isinstance(obj, float) and not math.isfinite(obj):
                return str(obj)
            if isinstance(obj, Mapping):
                return {k: finite(v) for k, v in obj.items()}
            return [finite(v) for v in obj] if isinstance(obj, (list, tuple)) else obj

        return json.dumps(finite(dict(self.params)), default=fallback, allow_nan=False)

    @classmethod
    def from_dict(cls, entry: Mapping[str, Any], position: int | None = None) -> "CheckSpec":
        where = f"check #{position}" if position is not None else "check"
        if not isinstance(entry, Mapping):
            raise SpecError(f"{where}: expected a mapping, got {type(entry).__name__}")
        name = entry.get("check_name") or entry.get("name")
        check_type = entry.get("check_type") or entry.get("type")
        if not name:
            raise SpecError(f"{where}: missing 'check_name' in {dict(entry)!r}")
        if not check_type:
            raise SpecError(f"{where} '{name}': missing 'check_type'")
        params = entry.get("params") or {}
        if not isinstance(params, Mapping):
            raise SpecError(f"{where} '{name}': 'params' must be a mapping")
        return cls(str(name), str(check_type), entry.get("sub_type"), dict(params))


def build_specs(entries: Iterable[CheckSpec | Mapping[str, Any]]) -> list[CheckSpec]:
    """Normalise dicts / specs into a list, rejecting repeated names."""
    specs: list[CheckSpec] = []
    seen: set[str] = set()
    for i, entry in enumerate(entries):
        spec = entry if isinstance(entry, CheckSpec) else CheckSpec.from_dict(entry, i)
        if spec.name in seen:
            raise SpecError(f"duplicate check name '{spec.name}' (check #{i})")
        seen.add(spec.name)
        specs.append(spec)
    return specs


def check(name: str, check_type: str, sub_type: str | None = None, **params: Any) -> CheckSpec:
    """Shorthand: ``check("price_not_null", "completeness", column="price", threshold=0.06)``."""
    return CheckSpec(name, check_type, sub_type, params)
