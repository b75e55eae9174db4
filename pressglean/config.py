"""Settings of a run, as one immutable value; nothing is read from or written back to files by the operators."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields, replace

# Hosts that count as social media together with their subdomains.
SOCIAL_DOMAINS = ("facebook.com", "twitter.com", "x.com", "instagram.com", "linkedin.com", "youtube.com", "youtu.be", "pinterest.com", "tiktok.com", "whatsapp.com", "t.me", "reddit.com")
# What makes a URL an image.
IMAGE_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif", ".bmp", ".webp", ".svg", ".tiff", ".ico")
IMAGE_PATHS = ("/uploads/", "/images/", "/img/", "/static/images/", "/media/")
# Section headers of a digest, in the order in which they are tried.
SECTION_HEADERS = ("NORMAS LEGALES", "NOTICIAS – SUNASS", "NOTICIAS - SUNASS", "ALERTAS", "SECTOR", "MEDIOAMBIENTE", "MEDIO AMBIENTE", "POLÍTICA / ECONOMÍA", "POLÍTICA/ECONOMÍA", "POLITICA / ECONOMIA")
FIRST_SECTION = "CONTENIDO_INICIAL"
# Keywords and their weights.
KEYWORDS = (("agua", 0.2), ("alcantarillado", 0.2), ("saneamiento", 0.2), ("SUNASS", 0.5), ("sedapal", 0.2), ("regulación", 0.2), ("servicios públicos", 0.2))
# Terms of an error that won't go away.
PERMANENT_ERRORS = ("timeout", "too large", "too big", "size limit", "demasiado grande", "demasiado pesada", "limits exceeded", "memory", "memoria", "out of", "unable to process", "quota", "rate limit", "rate-limit")
DAY, HOUR, TEN_YEARS = 86_400, 3_600, 315_360_000


@dataclass(frozen=True)
class Settings:
    """Parameters with the defaults of the pipeline. `merged` replaces fields one level deep."""

    keywords: tuple[tuple[str, float], ...] = KEYWORDS
    social_domains: tuple[str, ...] = SOCIAL_DOMAINS
    image_extensions: tuple[str, ...] = IMAGE_EXTENSIONS
    image_paths: tuple[str, ...] = IMAGE_PATHS
    section_headers: tuple[str, ...] = SECTION_HEADERS
    relevant_from: float = 0.3
    cache_expiry: int = DAY
    small_image_mb: float = 1.5
    small_batch: int = 3
    large_batch: int = 2
    max_image_area: int = 25_000_000
    prompt_key: str = "detallado"
    api: dict = field(default_factory=dict)

    def merged(self, given: dict) -> Settings:
        """A copy with `given` laid over it; nested dicts are merged, unknown names rejected."""
        known = {f.name for f in fields(self)}
        if unknown := set(given) - known:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return replace(self, **{k: {**getattr(self, k), **v} if isinstance(v, dict) else tuple(v) if isinstance(v, list) else v for k, v in given.items()})


def read_settings(path: str | None = None, environ: dict | None = None) -> Settings:
    """Settings from a YAML file, if there is one; an API key in the environment wins over the file."""
    given: dict = {}
    if path and os.path.exists(path):
        import yaml

        with open(path, encoding="utf-8") as f:
            given = yaml.safe_load(f) or {}
    known = {f.name for f in fields(Settings)}
    settings = Settings().merged({k: v for k, v in given.items() if k in known})
    key = (os.environ if environ is None else environ).get("OCR_API_KEY")
    return settings.merged({"api": {"key": key}}) if key else settings


def paths_for(base: str, date: str) -> dict[str, str]:
    """Where the inputs and outputs of a day (ddMMyyyy) lie under `base`."""
    return {
        "links": f"{base}/In/links_extracted_{date}.csv",
        "pages": f"{base}/Out/scraped_texts_{date}.json",
        "image_links": f"{base}/Images/image_links_{date}.json",
        "image_files": f"{base}/Images/downloads/{date}",
        "image_texts": f"{base}/Images/downloads/{date}/image_texts.json",
        "social_links": f"{base}/Social/social_links_{date}.json",
        "stats": f"{base}/Stats/stats_{date}.json",
        "consolidated": f"{base}/output/consolidated_{date}.json",
    }
