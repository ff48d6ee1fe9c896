"""Per-wiki settings: titles of reference sections and names of citation templates."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache


@dataclass(frozen=True)
class WikiConfig:
    sections: frozenset[str]
    prefixes: tuple[str, ...]
    exact: frozenset[str]


DEFAULT = "en.wikipedia.org"

#: The settings by wiki.
CONFIGS: dict[str, dict] = {
    "en.wikipedia.org": {
        "reference_sections": [
            "articles", "audiobooks", "bibliography", "books", "external links", "further reading", "references",
            "sources", "works cited", "discography", "see also",
        ],
        "citation_templates": {"prefixes": ["cite"], "exact": ["citation"]},
    },
    "it.wikipedia.org": {
        "reference_sections": [
            "note", "bibliografia", "fonti", "collegamenti esterni", "opere", "discografia", "pagine correlate",
            "voci correlate",
        ],
        "citation_templates": {"prefixes": ["cita", "cite"], "exact": ["citazione"]},
    },
    "af.wikipedia.org": {
        "reference_sections": [
            "verwysing", "verwysings", "bibliografie", "eksterne skakel", "eksterne skakels", "bronne", "bron", "notas",
            "notas en verwysings",
        ],
        "citation_templates": {"prefixes": ["cite"], "exact": ["verwysing"]},
    },
}


def read_configs(path: str) -> dict[str, dict]:
    """Settings from a YAML file of the same shape."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


def parse_config(settings: dict) -> WikiConfig:
    """A flat list of templates counts as prefixes."""
    templates = settings.get("citation_templates") or {}
    flat = isinstance(templates, list)
    prefixes, exact = (templates, []) if flat else (templates.get("prefixes") or [], templates.get("exact") or [])
    return WikiConfig(
        frozenset(s.lower() for s in settings.get("reference_sections") or []),
        tuple(p.lower() for p in prefixes),
        frozenset(e.lower() for e in exact),
    )


@lru_cache(maxsize=256)
def wiki_config(domain: str | None) -> WikiConfig:
    """Settings of a domain; of the default wiki where the domain is unknown."""
    return parse_config(CONFIGS.get(domain or DEFAULT, CONFIGS[DEFAULT]))
