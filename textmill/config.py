"""Settings of a build. Unknown keys are refused; defaults are those of the dataflow."""

from __future__ import annotations

from dataclasses import dataclass, field, fields
from typing import Any


@dataclass(frozen=True)
class Cleaning:
    fix_mojibake: bool = True
    remove_control_characters: bool = True
    normalize_unicode: bool = True
    unicode_form: str = "NFC"
    clean_html: bool = True
    unescape_html_entities: bool = True
    clean_markdown_wrapping: bool = False
    normalize_whitespace: bool = True


@dataclass(frozen=True)
class Filtering:
    min_character_length: int = 50
    max_character_length: int = 500_000
    chunk_long_documents: bool = True
    chunk_max_characters: int = 4000


@dataclass(frozen=True)
class Quality:
    auto_reject_below: float = 40
    review_below: float = 60
    max_repeated_char_count: int = 8
    max_punctuation_ratio: float = 0.35
    max_digit_ratio: float = 0.40
    max_url_ratio: float = 0.20


@dataclass(frozen=True)
class Deduplication:
    enable_exact_dedup: bool = True
    enable_near_dedup: bool = True
    num_perm: int = 128
    bands: int = 32


@dataclass(frozen=True)
class Dataset:
    seed: int = 42
    train_ratio: float = 0.98
    validation_ratio: float = 0.01
    shard_max_documents: int = 100_000
    shard_max_bytes: int = 104_857_600


@dataclass(frozen=True)
class Config:
    cleaning: Cleaning = field(default_factory=Cleaning)
    filtering: Filtering = field(default_factory=Filtering)
    quality: Quality = field(default_factory=Quality)
    deduplication: Deduplication = field(default_factory=Deduplication)
    dataset: Dataset = field(default_factory=Dataset)

    @classmethod
    def of(cls, values: dict[str, Any] | None) -> Config:
        """From nested dicts, such as a parsed YAML file; None or {} gives the defaults."""
        parts = {}
        for f in fields(cls):
            kind = type(getattr(cls(), f.name))
            parts[f.name] = kind(**(values or {}).get(f.name, {}))
        if extra := set(values or {}) - set(parts):
            raise ValueError(f"unknown sections: {sorted(extra)}")
        return cls(**parts)


def load(path: str) -> Config:
    """A YAML file; a missing or empty one gives the defaults."""
    import os

    if not os.path.exists(path):
        return Config()
    try:
        import yaml
    except ImportError as e:
        raise RuntimeError("reading a YAML configuration needs PyYAML") from e
    with open(path, encoding="utf-8") as f:
        return Config.of(yaml.safe_load(f))
