"""Phone counts of English text. The fallback is a rule of thumb; supply n_phonemes or a function of your own for more."""

from __future__ import annotations

import re
from collections.abc import Callable

#: Letter groups that stand for one phone, longest first.
GROUPS = re.compile(r"tch|sch|eau|igh|[aeiou]{2}|[cst]h|ph|wh|ck|ng|qu|([bcdfglmnprstz])\1|[a-z]")
UNCOUNTED = re.compile("[぀-ヿ㐀-䶿一-鿿가-힯]")


def letters_to_phones(text: str) -> list[str]:
    """A token for each phone that a simple reading of the letters gives; a final silent e is none."""
    out: list[str] = []
    for word in re.findall(r"[a-z']+", text.lower()):
        word = re.sub(r"(?<=[a-z]{2}[^aeiou])e$", "", word.replace("'", ""))
        out += [m.group().upper()[:3] for m in GROUPS.finditer(word)]
    return out


def count_phones(text: str | None, to_phones: Callable[[str], list[str]] = letters_to_phones) -> int | None:
    """Number of phone tokens; None for blank text, for kana, CJK and Hangul, and for 0."""
    if not text or not text.strip() or UNCOUNTED.search(text):
        return None
    return sum(bool(re.match(r"^[A-Z]{1,3}[0-2]?$", p)) for p in to_phones(text)) or None
