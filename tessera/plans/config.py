"""Settings of discovery, fetching and enrichment, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass
from urllib.parse import urlparse


@dataclass(frozen=True)
class Config:
    """Numbers are seconds, words or counts; see `__post_init__` for what they may be."""

    # Fixed values.  The defaults that users of the guides rely on.
    output_dir: str = "output"
    enriched_dir: str = "enriched"
    first_delay: float = 1.0
    second_delay: float = 3.0
    max_retries: int = 3
    backoff_factor: float = 2.0
    timeout: int = 30
    min_chunk_words: int = 50
    max_chunk_words: int = 2000
    enrich_min_words: int = 30
    enrich_max_words: int = 800
    max_workers: int = 1
    first_workers: int = 8
    second_workers: int = 1
    quality_min_words: int = 50
    breaker_threshold: int = 5
    breaker_cooldown: float = 60.0
    adaptive_delay: bool = True
    max_delay: float = 30.0
    max_sections: int | None = None
    manifest_save_interval: int = 25
    model_prompt_version: str = "1.0"
    model_max_chunks: int | None = None
    first_base_url: str = "https://selling-guide.fanniemae.com"
    first_sitemap_url: str = "https://selling-guide.fanniemae.com/sitemap.xml"
    second_base_url: str = "https://guide.freddiemac.com"
    second_sitemap_url: str = "https://guide.freddiemac.com/euf/assets/fm/sitemap.xml"

    def __post_init__(self) -> None:
        limits = {
            "first_delay": (0, None),
            "second_delay": (0, None),
            "max_retries": (0, 10),
            "backoff_factor": (1.0, None),
            "timeout": (1, None),
            "breaker_threshold": (1, None),
            "breaker_cooldown": (0, None),
            "max_delay": (0.1, None),
            "max_workers": (1, None),
            "quality_min_words": (0, None),
            "manifest_save_interval": (1, None),
        }
        for name, (low, high) in limits.items():
            value = getattr(self, name)
            if value < low or high is not None and value > high:
                raise ValueError(f"{name} must be {'at least ' + str(low) if high is None else f'between {low} and {high}'}")
        for name in ("first_base_url", "first_sitemap_url", "second_base_url", "second_sitemap_url"):
            if urlparse(getattr(self, name)).scheme != "https":
                raise ValueError(f"{name} must use HTTPS: {getattr(self, name)}")
