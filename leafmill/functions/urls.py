"""URL expressions: host, domain test, canonical form, ids and page type."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions.text import blank_to_null
from leafmill.sites.base import EntityUrls

_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
_HEAD = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"

# Extensions of files that are not followed as pages.
FILE_EXTENSIONS = (
    # archives
    "7z 7zip bz2 rar tar tar.gz xz zip "
    # images
    "mng pct bmp gif jpg jpeg png pst psp tif tiff ai drw dxf eps ps svg cdr ico webp "
    # audio
    "mp3 wma ogg wav ra aac mid au aiff "
    # video
    "3gp asf asx avi mov mp4 mpg qt rm swf wmv m4a m4v flv webm "
    # office
    "xls xlsm xlsx xltm xltx potm potx ppt pptm pptx pps doc docb docm docx dotm dotx odt ods odg odp "
    # other
    "css pdf exe bin rss dmg iso apk jar sh rb js hta bat cpl msi msp py"
).split()
_FILE = r"(?i)^[a-z][a-z0-9+.-]*://[^/?#]*/[^?#]*\.(?:%s)(?:[?#]|$)" % "|".join(
    e.replace(".", r"\.") for e in FILE_EXTENSIONS
)


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, _HOST, 1))


def in_domains(url: Column, domains: Sequence[str]) -> Column:
    """The URL's host is one of the domains or below one of them."""
    name = host(url)
    hit = F.lit(False)
    for domain in domains:
        hit = hit | (name == domain) | name.endswith(f".{domain}")
    return hit


def is_file(url: Column) -> Column:
    return url.rlike(_FILE)


def any_match(url: Column, patterns: Sequence[str]) -> Column:
    return url.rlike("|".join(f"(?:{p})" for p in patterns))


def _requote(text: Column) -> Column:
    """Percent-encoding of a query part in one spelling; malformed escapes are left as they are."""
    once = F.url_encode(F.try_url_decode(text))
    return F.coalesce(F.replace(F.replace(once, F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A")), text)


def canonical_url(url: Column) -> Column:
    """One spelling per page: host in lower case, path not empty, query sorted, fragment dropped."""
    bare = F.substring_index(url, "#", 1)
    before = F.substring_index(bare, "?", 1)
    head = F.regexp_extract(before, _HEAD, 1)
    path = F.substr(before, F.length(head) + 1)
    pairs = F.filter(F.split(F.substr(bare, F.length(before) + 2), "&"), lambda p: p != "")
    fields = F.transform(
        pairs,
        lambda p: F.struct(
            _requote(F.substring_index(p, "=", 1)).alias("k"),
            _requote(F.when(p.contains("="), F.substr(p, F.locate("=", p) + 1)).otherwise(F.lit(""))).alias("v"),
        ),
    )
    query = F.array_join(F.transform(F.array_sort(fields), lambda f: F.concat(f["k"], F.lit("="), f["v"])), "&")
    return F.concat(
        F.lower(head),
        F.when(path == "", F.lit("/")).otherwise(path),
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)),
    )


def group_id(url: Column, urls: EntityUrls) -> Column:
    """The group id named anywhere in the URL, '' when there is none."""
    return F.regexp_extract(url, urls.group_id, 1)


def url_ids(url: Column, urls: EntityUrls) -> tuple[Column, Column]:
    """(group id, entry id) of a URL, null where it names none."""
    return tuple(blank_to_null(F.regexp_extract(url, urls.group_and_entry, i)) for i in (1, 2))


def page_type(url: Column, urls: EntityUrls) -> Column:
    """`lot`, `catalog` or `other`; a URL matching both is a lot."""
    return (
        F.when(url.rlike(urls.entry_page), F.lit("lot"))
        .when(url.rlike(urls.group_page), F.lit("catalog"))
        .otherwise(F.lit("other"))
    )


def entry_group(url: Column, urls: EntityUrls) -> Column:
    """The group id of an entry page's full URL, null for any other URL."""
    return blank_to_null(F.regexp_extract(url, urls.entry_exact, 1))


def distinct_ids(html: Column, urls: EntityUrls) -> Column:
    """Group ids linked in a page, each once, in order of first appearance."""
    return F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(urls.group_id), F.lit(1)))


def file_name(text: Column, length: int) -> Column:
    """Text made safe for a file name."""
    return F.substr(F.trim(F.regexp_replace(text, "[^A-Za-z0-9]+", "_"), F.lit("_")), F.lit(1), F.lit(length))
