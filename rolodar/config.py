"""Configuration: frozen dataclasses, filled from YAML and overridden by explicit options."""

from __future__ import annotations

import logging
import os
from dataclasses import dataclass, field, fields, replace
from typing import Any

from rolodar.functions import fixed


@dataclass(frozen=True)
class Normalization:
    default_phone_country: str = "US"
    keep_generational_suffixes: tuple[str, ...] = tuple(fixed.GENERATIONAL)
    professional_suffixes: tuple[str, ...] = tuple(fixed.PROFESSIONAL)
    name_prefixes: tuple[str, ...] = tuple(fixed.PREFIXES)
    drop_invalid_emails: bool = False
    drop_invalid_phones: bool = False
    keep_local_case: bool = True
    email_dns_mx_check: bool = False


@dataclass(frozen=True)
class Dedupe:
    enable_nickname_equivalence: bool = True
    first_name_similarity_threshold: float = 0.88
    merge_score_threshold: float = 1.2
    relaxed_merge_threshold: float = 0.6
    require_corroborator: bool = False


@dataclass(frozen=True)
class Quality:
    email_full: int = 40
    email_partial: int = 20
    phone_full: int = 30
    phone_partial: int = 15
    address_any: int = 30


@dataclass(frozen=True)
class Tagging:
    prior_companies: tuple[str, ...] = ()
    prior_domains: tuple[str, ...] = ()
    local_cities: tuple[str, ...] = tuple(fixed.LOCAL_CITIES)
    confidence_weight: float = 0.6
    tag_weights: tuple[tuple[str, int], ...] = (
        ("work_colleague", 30), ("local_south_shore", 25), ("martial_arts", 20), ("nutcracker_performance", 10),
    )


@dataclass(frozen=True)
class Inputs:
    linkedin_csv: str = ""
    gmail_csv: str = ""
    mac_vcf: str = ""
    deliverability_csv: str = ""


@dataclass(frozen=True)
class Config:
    inputs: Inputs = field(default_factory=Inputs)
    output_dir: str = "."
    normalization: Normalization = field(default_factory=Normalization)
    dedupe: Dedupe = field(default_factory=Dedupe)
    quality: Quality = field(default_factory=Quality)
    tagging: Tagging = field(default_factory=Tagging)
    log_level: str = "WARNING"
    single_files: bool = False


def _filled(default: Any, given: dict[str, Any] | None) -> Any:
    """The dataclass with the known, non-empty options that are given; unknown ones are ignored."""
    values = {}
    for f in fields(default):
        v = (given or {}).get(f.name)
        if v is None or v == "" or v == []:
            continue
        old = getattr(default, f.name)
        if isinstance(old, tuple):
            v = tuple(str(x).strip().lower() for x in v)
        values[f.name] = v
    return replace(default, **values)


def load(path: str | None = None, **overrides: Any) -> Config:
    """Config of a YAML file; overrides (section__key=value) win if they are not None - also when they are 0."""
    data: dict[str, Any] = {}
    if path:
        import yaml

        with open(path, encoding="utf-8") as f:
            data = yaml.safe_load(f) or {}
    for name, value in overrides.items():
        if value is not None:
            section, _, key = name.partition("__")
            data.setdefault(section, {})[key] = value
    base = Config()
    return Config(
        _filled(base.inputs, data.get("inputs")),
        (data.get("outputs") or {}).get("dir") or base.output_dir,
        _filled(base.normalization, data.get("normalization")),
        _filled(base.dedupe, data.get("dedupe")),
        _filled(base.quality, data.get("quality")),
        _filled(base.tagging, data.get("tagging")),
        str((data.get("logging") or {}).get("level") or base.log_level),
        bool((data.get("outputs") or {}).get("single_files")),
    )


def configure_logging(config: Config, level: str | None = None, env: str = "LOG_LEVEL") -> int:
    """Environment before option before file; an unknown name means INFO."""
    name = os.environ.get(env) or level or config.log_level
    number = int(name) if str(name).isdigit() else getattr(logging, str(name).upper(), logging.INFO)
    logging.basicConfig(level=number)
    return number
