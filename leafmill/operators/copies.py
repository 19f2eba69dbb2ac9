"""Which elements of a page are copies of earlier ones."""

from __future__ import annotations

from collections import Counter
from collections.abc import Hashable, Sequence

#: So many equal texts under one label are a loop, wherever they stand on the page.
OFTEN = 5


def homes(names: Sequence[tuple[Hashable | None, Hashable | None]], often: int = OFTEN) -> list[int]:
    """For each element's (box, text), either of which may be None: the place of the element
    that it copies, or its own. The box decides before the text, and a copy's names lead nowhere."""
    looping = {text for text, n in Counter(t for _, t in names).items() if n >= often}
    first: dict[Hashable, int] = {}
    out = []
    for i, (box, text) in enumerate(names):
        known = [first[k] for k in (box, text if text in looping else None) if k is not None and k in first]
        out.append(known[0] if known else i)
        if not known:
            first.setdefault(box, i)
            first.setdefault(text, i)
    return out
