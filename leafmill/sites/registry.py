"""Site packs by name."""

from __future__ import annotations

from leafmill.sites import auctions, books, quotes
from leafmill.sites.base import SitePack

_packs: dict[str, SitePack] = {}


def register_site(name: str, pack: SitePack) -> None:
    if pack.name != name:
        raise ValueError(f"site {name!r} holds a pack named {pack.name!r}; the names must match")
    _packs[name] = pack


def list_sites() -> list[str]:
    return sorted(_packs)


def get_site(name: str) -> SitePack:
    try:
        return _packs[name]
    except KeyError:
        raise KeyError(f"unknown site {name!r}; known: {', '.join(list_sites()) or '(none)'}") from None


for _pack in (auctions.PACK, books.PACK, quotes.PACK):
    register_site(_pack.name, _pack)
