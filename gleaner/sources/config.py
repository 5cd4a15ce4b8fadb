"""Settings of a harvest. Keys of services come from the environment and are never written."""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, fields


@dataclass(frozen=True)
class Config:
    """Fixed values of the rules that a user may change."""

    ocr_least_text: int = 100
    ocr_dpi: int = 200
    ocr_language: str = "eng"
    form_score: int = 8
    page_size: int = 250
    delay: float = 1.0
    fast: bool = True

    @staticmethod
    def key(name: str = "API_KEY") -> str | None:
        return os.environ.get(name)

    def listing_options(self) -> dict[str, str]:
        """Options of the ``listing`` data source."""
        return {"pageSize": str(self.page_size), "delay": str(self.delay)}

    def save(self, path: str) -> None:
        with open(path, "w", encoding="utf-8") as f:
            json.dump(asdict(self), f, indent=2)

    @classmethod
    def load(cls, path: str) -> Config:
        """The settings of a JSON (or, where PyYAML is installed, YAML) file; defaults for those that are missing, or without a file."""
        try:
            with open(path, encoding="utf-8") as f:
                text = f.read()
        except FileNotFoundError:
            return cls()
        if path.endswith((".yaml", ".yml")):
            import yaml

            given = yaml.safe_load(text) or {}
        else:
            given = json.loads(text)
        return cls(**{k: v for k, v in given.items() if k in {f.name for f in fields(cls)}})
