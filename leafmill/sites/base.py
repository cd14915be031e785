"""What the engine needs to know about a site, held as data."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column

from leafmill.functions.markup import Mark


@dataclass(frozen=True)
class LinkRules:
    """Regexes a link must (allow) or must not (deny) contain, and the page regions searched for links.

    A region is a `(tag, class)` pair; an empty class stands for any.
    """

    allow: tuple[str, ...] = ()
    deny: tuple[str, ...] = ()
    regions: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class EntityUrls:
    """How a site's URLs name a group page, its numbered entries and its paging."""

    home: str
    group_id: str  # regex with one group: the group id anywhere in a URL
    group_and_entry: str  # regex with two groups: group id, optional entry id
    entry_page: str  # regex: the URL is an entry page
    group_page: str  # regex: the URL is a group page
    entry_exact: str  # anchored regex with one group: any entry URL of the site, whatever the group id
    any_entry: str  # anchored regex: an entry URL whose group id has the usual form
    scoped_link: str  # regex with one group: links followed when a crawl is limited to some groups
    seed: str  # format string: group id to seed URL
    marker: str  # text every usable entry page carries
    entries_per_page: int


@dataclass(frozen=True)
class SitePack:
    name: str
    domains: tuple[str, ...]
    start_urls: tuple[str, ...]
    rules: LinkRules = field(default_factory=LinkRules)
    retry_times: int = 3
    urls: EntityUrls | None = None
    # (nodes, url) -> array of record structs, null when the page yields nothing
    extract: Callable[[Column, Column], Column] | None = None
    # attributes `extract` reads; others never leave the Python worker
    attributes: tuple[str, ...] = ()
    # elements `extract` looks for; with them its nodes have bits in place of tags and classes
    marks: tuple[Mark, ...] = ()
