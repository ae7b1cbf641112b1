"""Settings of redaction and export."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RedactorConfig:
    user_name: str | None = None
    home_dir: str | None = None
    allow_public_urls: bool = False
    allowed_domains: tuple[str, ...] = ()
    private_terms: tuple[str, ...] = ()
    private_domains: tuple[str, ...] = ()
    privacy_filter: bool = False
    privacy_filter_device: str = "auto"
    privacy_filter_batch_size: int = 64
    gitleaks: bool = False
    gitleaks_fix: bool = False
    llm_residue_url: str | None = None


@dataclass(frozen=True)
class ExportConfig:
    variant: str = "both"
    min_turns: int | None = None
    max_turns: int | None = None
    min_assistant_chars: int | None = None
    include_sources: tuple[str, ...] = ()
    drop_sources: tuple[str, ...] = ()
    projects: tuple[str, ...] = ()
    models: tuple[str, ...] = ()
    statuses: tuple[str, ...] = ()
    since: str | None = None
    until: str | None = None
    require_tools: bool = False
    require_diffs: bool = False
    dedup: bool = False
    metadata_key: str | None = None
