"""Settings of a build: folders of each level, with ${VAR} in values taken from the environment."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

STEPS = ("pdf_to_md", "segmentation", "build_graph", "afterclass_exercises", "check_graph")
LEVELS = ("chapter_kg", "book_kg", "subject_stage_kg", "subject_kg", "global_kg", "afterclass_exercises")


def expanded(value):
    """A value with ${VAR} replaced in all its texts; an unset variable is empty."""
    if isinstance(value, str):
        return re.sub(r"\$\{(\w+)\}", lambda m: os.environ.get(m[1], ""), value)
    if isinstance(value, dict):
        return {k: expanded(v) for k, v in value.items()}
    return [expanded(v) for v in value] if isinstance(value, list) else value


def load_env(text: str) -> dict[str, str]:
    """KEY=value lines put into the environment where it lacks them; returns what was set."""
    done = {}
    for line in text.splitlines():
        key, mark, value = line.partition("=")
        key = key.strip().removeprefix("export ").strip()
        if mark and key and not key.startswith("#") and key not in os.environ:
            os.environ[key] = done[key] = value.strip().strip("\"'")
    return done


def read_yaml(path: str) -> dict:
    """A YAML file of settings, with ${VAR} replaced; needs PyYAML."""
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("YAML settings need PyYAML; give a dict to Settings.of instead") from e
    with open(path, encoding="utf-8") as f:
        raw = yaml.safe_load(f) or {}
    if not isinstance(raw, dict):
        raise ValueError(f"{path} holds no mapping")
    return expanded(raw)


@dataclass(frozen=True)
class Settings:
    """Root folder of a build, its work folder and registry's folder, and paths below them."""

    root: str
    work: str = "workspace"
    books_at: str = "."
    books: list[dict] = field(default_factory=list)
    model: dict = field(default_factory=dict)
    seed: int = 20260412

    @classmethod
    def of(cls, raw: dict) -> Settings:
        return cls(**expanded(raw))

    def level(self, name: str) -> str:
        if name not in LEVELS:
            raise ValueError(f"unknown level {name}; there are {', '.join(LEVELS)}")
        return f"{self.root.rstrip('/')}/{name}"

    def book(self, name: str, prefix: str) -> str:
        return f"{self.level(name)}/book_prefix={prefix}"

    def step(self, name: str, prefix: str = "") -> str:
        """Work folder of a step, or of one book in it."""
        if name not in STEPS:
            raise ValueError(f"unknown step {name}; there are {', '.join(STEPS)}")
        return "/".join(x for x in (self.work.rstrip("/"), name, prefix) if x)

    def sections(self, prefix: str) -> tuple[str, str]:
        """Folder of a book's section texts, and its section index."""
        at = self.step("segmentation", prefix)
        return f"{at}/sections", f"{at}/sections_index.json"

    def made_markdown(self, prefix: str) -> tuple[str, str]:
        """Markdown made from a book's PDF, and its manifest."""
        at = self.step("pdf_to_md", prefix)
        return f"{at}/book.md", f"{at}/manifest.json"

    def source(self, book: dict, *keys: str) -> str | None:
        """A book's file: the first of the keys (source_pdf, source_md by default) that is not blank, relative ones under the registry's folder."""
        for key in keys or ("source_pdf", "source_md"):
            if value := str(book.get(key) or "").strip():
                return value if value.startswith("/") or "://" in value else f"{self.books_at.rstrip('/')}/{value}"
        return None

    def selected(self, prefixes: list[str] | None = None, limit: int | None = None) -> list[dict]:
        rows = [b for b in self.books if not prefixes or b["book_prefix"] in prefixes]
        return rows if limit is None else rows[:limit]
