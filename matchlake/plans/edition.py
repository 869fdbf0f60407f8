"""The two editions of the pipeline.

* ``compact`` -- eight conformed tables, empty string counts as a NULL
  sentinel, club facts from conformed (de-duplicated) club games.
* ``full`` -- six conformed tables, strict sentinels (empty text is kept),
  player age and load stamps, club facts straight from the raw table.

``as_of`` pins the clock-dependent columns (age, load stamp) so results are
repeatable; ``None`` means "now".
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from ..operators.clean import NULL_TOKENS, NULL_TOKENS_STRICT


@dataclass(frozen=True)
class Edition:
    name: str
    null_tokens: tuple[str, ...]
    stamps: bool
    as_of: dt.datetime | None = None

    @property
    def today(self) -> dt.date | None:
        return self.as_of.date() if self.as_of is not None else None


# Fixed value used by registered queries and tests so that age and stamps repeat.
AS_OF = dt.datetime(2024, 6, 30, 12, 0, 0)


def compact(as_of: dt.datetime | None = AS_OF) -> Edition:
    return Edition("compact", tuple(NULL_TOKENS), stamps=False, as_of=as_of)


def full(as_of: dt.datetime | None = AS_OF) -> Edition:
    return Edition("full", tuple(NULL_TOKENS_STRICT), stamps=True, as_of=as_of)


def by_name(name: str, as_of: dt.datetime | None = AS_OF) -> Edition:
    return {"compact": compact, "full": full}[name](as_of)
