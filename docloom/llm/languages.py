"""Names of languages in labels."""

from __future__ import annotations

#: Two-letter codes with the three-letter codes and English names that labels may use instead.
LANGUAGES = {
    "en": ("eng", "english"),
    "de": ("deu", "ger", "german"),
    "fr": ("fra", "fre", "french"),
    "es": ("spa", "spanish"),
    "it": ("ita", "italian"),
    "pt": ("por", "portuguese"),
    "nl": ("nld", "dut", "dutch"),
    "pl": ("pol", "polish"),
    "ru": ("rus", "russian"),
    "el": ("ell", "gre", "greek"),
    "zh": ("zho", "chi", "chinese"),
}
_CODES = {name: code for code, names in LANGUAGES.items() for name in (code, *names)}


def code(label: str | None) -> str | None:
    """The two-letter code that a label means, whatever its case, region or form; None if it names no known language."""
    return _CODES.get((label or "").strip().lower().replace("_", "-").split("-")[0])
