"""Auction house: catalogue pages give one auction and its lot cards, lot pages one lot."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leafmill.functions import markup as m
from leafmill.functions.text import blank_to_null, clean_text, ru_date_iso
from leafmill.sites.base import EntityUrls, LinkRules, SitePack

# Site addresses, URL patterns, page labels, page size.
_ID = r"[0-9]+(?:[.s][0-9]+)?"
_SITE = r"^https?://(?:www\.)?litfund\.ru"
MICRODATA = "data-lf-microdata"
COMPLETED_LABEL = "Аукцион завершён"
START_LABEL, LEADING_LABEL, FINAL_LABEL = "Стартовая", "Лидирующая", "Финальная"
URLS = EntityUrls(
    home="https://www.litfund.ru",
    group_id=rf"/auction/({_ID})/",
    group_and_entry=rf"/auction/({_ID})/(?:([0-9]+[a-z]?)/)?",
    entry_page=rf"/auction/{_ID}/[0-9]+[a-z]?/",
    group_page=rf"/auction/{_ID}/([?]|$)",
    entry_exact=rf"{_SITE}/auction/([^/]+)/[0-9]+[a-z]?/$",
    any_entry=rf"{_SITE}/auction/{_ID}/[0-9]+[a-z]?/$",
    scoped_link=r"/auction/([^/]+)/(?:$|[0-9]+[a-z]?/$|[?]page=[0-9]+)",
    seed="https://www.litfund.ru/auction/%s/",
    marker=MICRODATA,
    entries_per_page=36,
)

_RECORD = (
    "type:string,auction_id:string,lot_number:string,lot_index:string,number:string,date:string,date_iso:string,"
    "status:string,title:string,description:string,start_price:string,leading_bid:string,final_price:string,"
    "reserve_not_met:boolean,views:string,images:array<string>,source_url:string"
)


# The elements that the fields come from.
_META = {name: m.Mark("meta", attr="property", value=name) for name in ("og:url", "og:title", "og:description", "og:image")}
_VIEWS = {"views": m.Mark(attr="data-type", value="lot-views-cnt")}
_LOT = {name: m.Mark(attr=MICRODATA, value=name) for name in ("lot-index", "lot-name", "lot-desc", "lot-start-price")} | {
    "lot-image": m.Mark("a", attr=MICRODATA, value="lot-image"),
    "sold": m.Mark(classes=("tm-product-price-final",)),
}
_PAGE = {
    "head": m.Mark("div", ("uk-display-inline-block",)),
    "countdown": m.Mark(attr="data-online"),
    "section": m.Mark("section"),
    "card": m.Mark("article", ("tm-product-card",)),
}
_CARD = {
    "media": m.Mark("a", ("tm-media-box",)),
    "title": m.Mark("h3", ("tm-product-card-title",)),
    "index": m.Mark(classes=("uk-text-meta", "uk-margin-xsmall-bottom")),
    "picture": m.Mark("figure", ("tm-media-box-wrap",)),
    "prices": m.Mark(classes=("tm-product-card-prices",)),
}
_INNER = {tag: m.Mark(tag) for tag in ("small", "h4", "a", "img", "div")} | {
    "label": m.Mark(classes=("uk-text-meta",)), "badge": m.Mark(classes=("tm-product-card-ndr",))
}
MARKS = _META | _VIEWS | _LOT | _PAGE | _CARD | _INNER
_BITS = {name: 1 << place for place, name in enumerate(MARKS)}


def _is(*names: str):
    """Predicate on a node: one of the named marks."""
    return m.marked(sum(_BITS[name] for name in names))


def _record(**values: Column) -> Column:
    """One shape for both record types; what a type lacks is null and left out of its JSON."""
    fields = (f.split(":") for f in _RECORD.split(","))
    return F.struct(*(values.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in fields))


def _meta(nodes: Column, name: str) -> Column:
    return m.attr_values(F.filter(nodes, _is(name)), "content")


def _or(text: Column, fallback: Column) -> Column:
    """`text` unless it is blank."""
    return m.let(text, lambda t: F.when(t != "", t).otherwise(fallback))


def _url_ids(url: Column) -> Column:
    found = F.struct(*(F.regexp_extract(url, URLS.group_and_entry, i).alias(n) for i, n in ((1, "auction"), (2, "lot"))))
    return m.let(found, lambda ids: F.struct(*(blank_to_null(ids[n]).alias(n) for n in ("auction", "lot"))))


def _page_ids(nodes: Column, url: Column) -> Column:
    """Ids named by the page itself where it names an auction, else those of its URL."""
    named = m.let(m.first(_meta(nodes, "og:url")), lambda told: F.coalesce(blank_to_null(told), url))
    return m.let(
        m.let(named, _url_ids), lambda ids: F.when(ids["auction"].isNotNull(), ids).otherwise(_url_ids(url))
    )


def _lot_page(nodes: Column, ids: Column, url: Column) -> Column:
    def build(telling: Column) -> Column:
        def own(name: str) -> Column:
            return clean_text(m.first(m.own_texts(nodes, F.filter(telling, _is(name)))))

        def og(name: str) -> Column:
            return clean_text(m.first(_meta(telling, name)))

        pictures = m.attr_values(F.filter(telling, _is("lot-image")), "href")
        lot = _record(
            type=F.lit("item"),
            auction_id=ids["auction"],
            lot_number=ids["lot"],
            lot_index=own("lot-index"),
            title=_or(own("lot-name"), og("og:title")),
            description=_or(
                clean_text(m.joined(m.deep_texts(nodes, F.filter(telling, _is("lot-desc"))))), og("og:description")
            ),
            start_price=own("lot-start-price"),
            final_price=blank_to_null(clean_text(m.joined(m.own_texts(nodes, F.filter(telling, _is("sold")))))),
            views=own("views"),
            images=m.let(pictures, lambda p: F.when(F.size(p) > 0, p).otherwise(_meta(telling, "og:image"))),
            source_url=url,
        )
        # Blocked and not-found pages carry none of these and yield nothing.
        shown = F.exists(telling, _is("lot-name", "lot-start-price", "lot-index"))
        return F.when(shown, F.array(lot))

    # The few nodes that fields come from are picked out of the page in one pass.
    return m.let(F.filter(nodes, _is(*_META, *_VIEWS, *_LOT)), build)


def _auction(nodes: Column, telling: Column, ids: Column, url: Column) -> Column:
    heads = m.pick(nodes, _is("head"), _is("small"), among=telling)
    labels = F.transform(heads, lambda h: clean_text(m.joined(m.texts(m.subtree(nodes, h)))))
    own_label = F.concat(F.lit("lf-"), ids["auction"], F.lit("-t-to-start"))
    labelled = F.filter(telling, lambda n: _is("countdown")(n) & (n["attrs"]["data-online"] == own_label))
    countdown = clean_text(m.first(m.own_texts(nodes, labelled)))
    status = F.when(m.joined(m.texts(nodes)).contains(COMPLETED_LABEL), F.lit("completed")).otherwise(
        _or(countdown, F.lit("unknown"))
    )
    heading = clean_text(m.first(m.own_texts(nodes, m.pick(nodes, _is("section"), _is("h4"), among=telling))))

    def build(label: Column) -> Column:
        number = F.regexp_extract(F.get(label, F.lit(0)), r"(?U)№[\s\x1c-\x1f]*([\d.]+)", 1)
        date = F.coalesce(F.get(label, F.lit(1)), F.lit(""))
        return _record(
            type=F.lit("auction"),
            auction_id=ids["auction"],
            number=F.coalesce(F.rtrim(number, F.lit(".")), F.lit("")),
            date=date,
            date_iso=F.coalesce(ru_date_iso(date), F.lit("")),
            status=status,
            title=_or(heading, clean_text(m.first(_meta(telling, "og:title")))),
            description=clean_text(m.first(_meta(telling, "og:description"))),
            source_url=url,
        )

    return m.let(labels, build)


def _card_prices(card: Column, telling: Column) -> Column:
    """Label and value rows of a card, folded in order: a label row takes the row after it as its value."""
    divs = m.let(
        F.filter(telling, _is("prices"))["idx"],
        lambda blocks: F.filter(card, lambda n: _is("div")(n) & F.array_contains(blocks, n["parent"])),
    )
    rows = F.transform(
        divs,
        lambda d: F.struct(
            _is("label")(d).alias("is_label"),
            clean_text(m.joined(m.texts(m.subtree(card, d)))).alias("text"),
            F.exists(m.subtree(card, d), _is("badge")).alias("badge"),
        ),
    )
    none = F.lit(None).cast("string")
    start = F.struct(
        none.alias("label"), F.lit(False).alias("badge"), none.alias("start"), none.alias("leading"),
        none.alias("final"), F.lit(None).cast("boolean").alias("reserve"),
    )

    def store(state: Column, value: Column) -> Column:
        def named(prefix: str) -> Column:
            return F.coalesce(state["label"].startswith(prefix), F.lit(False))

        return F.struct(
            none.alias("label"),
            F.lit(False).alias("badge"),
            F.when(named(START_LABEL), value).otherwise(state["start"]).alias("start"),
            F.when(named(LEADING_LABEL), value).otherwise(state["leading"]).alias("leading"),
            F.when(named(FINAL_LABEL), value).otherwise(state["final"]).alias("final"),
            F.when(named(FINAL_LABEL), state["badge"]).otherwise(state["reserve"]).alias("reserve"),
        )

    def step(state: Column, row: Column) -> Column:
        opened = F.struct(
            row["text"].alias("label"), row["badge"].alias("badge"), state["start"].alias("start"),
            state["leading"].alias("leading"), state["final"].alias("final"), state["reserve"].alias("reserve"),
        )
        return F.when(state["label"].isNotNull(), store(state, row["text"])).when(row["is_label"], opened).otherwise(
            state
        )

    # A label in last place has no value row and stands for a blank value.
    return F.aggregate(rows, start, step, lambda end: store(end, F.lit("")))


def _card(card: Column, auction_id: Column, url: Column) -> Column:
    def read(telling: Column) -> Column:
        heading = m.pick(card, _is("title"), _is("a"), among=telling)
        pictures = m.pick(card, _is("picture"), _is("img"), among=telling)

        def build(found: Column) -> Column:
            prices = found["prices"]
            return _record(
                type=F.lit("item"),
                auction_id=auction_id,
                lot_number=_url_ids(found["link"])["lot"],
                lot_index=clean_text(m.first(m.own_texts(card, F.filter(telling, _is("index"))))),
                title=found["title"],
                start_price=F.coalesce(prices["start"], F.lit("")),
                leading_bid=prices["leading"],
                final_price=prices["final"],
                reserve_not_met=prices["reserve"],
                views=clean_text(m.first(m.own_texts(card, F.filter(telling, _is("views"))))),
                images=m.attr_values(pictures, "src"),
                source_url=F.coalesce(found["link"], url),
            )

        media_link = m.first(m.attr_values(F.filter(telling, _is("media")), "href"))
        named = m.let(
            F.struct(media_link.alias("media"), heading.alias("heading")),
            lambda n: F.struct(
                F.coalesce(blank_to_null(n["media"]), blank_to_null(m.first(m.attr_values(n["heading"], "href")))).alias("link"),
                clean_text(m.first(m.own_texts(card, n["heading"]))).alias("title"),
                _card_prices(card, telling).alias("prices"),
            ),
        )
        return m.let(named, build)

    return m.let(F.filter(card, _is(*_CARD, *_VIEWS)), read)


def _catalogue_page(nodes: Column, ids: Column, url: Column) -> Column:
    def read(telling: Column) -> Column:
        items = F.transform(
            F.filter(telling, _is("card")), lambda c: m.let(m.subtree(nodes, c), lambda card: _card(card, ids["auction"], url))
        )
        return F.struct(_auction(nodes, telling, ids, url).alias("auction"), items.alias("items"))

    def build(page: Column) -> Column:
        auction = page["auction"]
        # A blocked page has no number, no date, no status and no cards.
        real = (
            (auction["number"] != "")
            | (auction["date"] != "")
            | (auction["status"] != "unknown")
            | (F.size(page["items"]) > 0)
        )
        return F.when(real, F.concat(F.array(auction), page["items"]))

    return m.let(m.let(F.filter(nodes, _is(*_META, *_PAGE)), read), build)


def extract(nodes: Column, url: Column) -> Column:
    return m.let(
        _page_ids(nodes, url),
        lambda ids: F.when(
            ids["auction"].isNotNull(),
            F.when(ids["lot"].isNotNull(), _lot_page(nodes, ids, url)).otherwise(_catalogue_page(nodes, ids, url)),
        ),
    )


# Domains, entry page, link patterns, retry budget.
PACK = SitePack(
    name="litfund",
    domains=("litfund.ru", "www.litfund.ru"),
    start_urls=("https://www.litfund.ru/auction/757/",),
    rules=LinkRules(
        allow=(
            rf"/auction/{_ID}/$",
            rf"/auction/{_ID}/[0-9]+/$",
            rf"/auction/{_ID}/\?page=[0-9]+",
        ),
    ),
    retry_times=5,
    urls=URLS,
    extract=extract,
    attributes=("content", "data-online", "href", "src"),
    marks=tuple(MARKS.values()),
)
