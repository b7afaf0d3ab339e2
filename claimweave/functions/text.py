"""Words of a text without what storage and transport did to it (plain Python, for Arrow batches)."""

from __future__ import annotations

import html
import re
import unicodedata

_BROKEN = re.compile("[Â-ô][\u0080-¿Œ-™]{1,3}")
_TAG = re.compile(r"</?[A-Za-z!][^<>]*>")
_WORD = re.compile(r"[^\W_]+")


def _mend(match: re.Match) -> str:
    for encoding in ("latin-1", "cp1252"):
        try:
            return match.group(0).encode(encoding).decode("utf-8")
        except UnicodeError:
            continue
    return match.group(0)


def mend_encoding(text: str) -> str:
    """UTF-8 that was once read as Latin-1 or Windows-1252, read as UTF-8 again."""
    return text if text.isascii() else _BROKEN.sub(_mend, text)


def strip_markup(text: str) -> str:
    """Tags as blanks, character entities as their characters."""
    if "<" in text:
        text = _TAG.sub(" ", text)
    return html.unescape(text) if "&" in text else text


def fold(text: str) -> str:
    """Without accents; case is kept."""
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def spoken(text: str) -> str:
    """Mended, without markup and accents, case kept."""
    return fold(strip_markup(mend_encoding(text)))


class _Folded(dict):
    """Words without accents, each folded once; emptied when it grows large."""

    def __missing__(self, word: str) -> str:
        if len(self) > 500_000:
            self.clear()
        folded = self[word] = fold(word)
        return folded


_FOLDED = _Folded()


def text_words(text: str | None) -> list[str]:
    """Lower-case words, free of accents, punctuation, markup and line breaks."""
    if not text:
        return []
    plain = strip_markup(mend_encoding(text))
    if plain.isascii():
        return _WORD.findall(plain.lower())
    # composed first, so that an accent of its own does not part a word
    return [w if w.isascii() else _FOLDED[w] for w in _WORD.findall(unicodedata.normalize("NFKC", plain).lower())]
