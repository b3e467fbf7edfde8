"""One parse of each page in an Arrow UDF, giving every DOM feature as one wide row."""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import parse_qs, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from riskloom.operators.main_text import Segments, is_outside

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
COUNTED = ["div", "a", "img", "span", "li", "script", "link", "meta", "p"]
#: Tokens of advertising, commerce and affiliate markup.
AD_WORDS = re.compile(r"\bad\b|\bads\b|advert|sponsor|dfp|gpt|adslot|ad-unit|outstream|preroll|banner|sticky-ad|interstitial|pub|anuncio|publicidad|annonce|werbung")
NOT_AD = re.compile(r"\b(address|adapter|addthis|additional|pub(?:lish|lic|lication))\b", re.I)
AD_SOURCES = ["doubleclick", "googlesyndication", "adnxs", "adservice", "adsystem", "criteo", "taboola", "outbrain"]
GPT = re.compile(r"googletag|gpt\.js|doubleclick|securepubads", re.I)
HEADER_BIDDING = re.compile(r"prebid|amazon-adsystem|criteo|rubicon|openx|indexexchange|pubmatic|sovrn|adnxs", re.I)
ARBITRAGE = re.compile(r"taboola|outbrain|revcontent|mgid|zergnet", re.I)
RECOMMENDED = re.compile(r"recommended|from around the web|you may like|sponsored stories|around the web", re.I)
PAGE_ANCHOR = re.compile(r"\b(next|siguiente|slide|gallery|page[\s-]?\d+)\b", re.I)
PAGE_URL = re.compile(r"/page/\d+|[?&]page=|/amp/", re.I)
CLICKBAIT = re.compile(r"(you won.t believe|shocking|no vas a creer|te sorprender|lo que pasó|\d+\s+(things|cosas|razones)|top\s+\d+|number\s+\d+|before.*after|antes.*después|mira esto)", re.I)
OVERLAY = re.compile(r"\b(modal|overlay|interstitial|lightbox|popup)\b", re.I)
STICKY = re.compile(r"position\s*:\s*(fixed|sticky)|\b(sticky|anchor|bottom)[\s-]?(ad|banner|bar)\b")
PRODUCT = re.compile(r'"@type"\s*:\s*"(Product|Offer|AggregateOffer)"', re.I)
AD_SLOT = re.compile(r"\b(ad-slot|ad-unit|ad-container|advertisement|advert)\b", re.I)
#: Hosts of advertising scripts.
AD_DOMAINS = [
    "doubleclick.net", "googleadservices.com", "googlesyndication.com", "pagead2.googlesyndication.com", "adservice.google.com", "googletagservices.com",
    "ads.pubmatic.com", "pubmatic.com", "openx.net", "adnxs.com", "ads.adnxs.com", "ads.yahoo.com", "adroll.com", "adsrvr.org", "rubiconproject.com",
    "outbrain.com", "taboola.com", "spotxchange.com", "criteo.com", "chitika.com", "media.net", "sharethrough.com", "teads.tv", "revcontent.com", "gumgum.com",
    "contextweb.com", "districtm.io", "flashtalking.com", "fyber.com", "mopub.com", "pubnative.net", "smartadserver.com", "serving-sys.com", "yieldmo.com",
    "adsafeprotected.com", "adform.net", "appnexus.com", "exponential.com", "adkernel.com", "adsterra.com", "trafficjunky.com", "advertising.com", "teads.com",
    "tradedoubler.com", "inner-active.mobi", "yieldlab.net", "ematic.io", "ebi-interactive.com",
]
#: Schema.org types by category, and the properties that a complete entry of it has (80 % of them at least).
SCHEMA = {
    "movie": ({"Movie"}, {"@type", "name", "description", "image", "datePublished", "director", "actor", "genre", "contentRating", "provider"}),
    "sports": ({"SportsEvent", "SportsOrganization"}, {"@type", "name", "startDate", "location", "competitor", "audience", "duration"}),
    "ecommerce": ({"Product", "Offer", "AggregateOffer"}, {"@type", "name", "description", "image", "sku", "offers", "brand", "aggregateRating"}),
    "anime": ({"AnimeSeries"}, {"@type", "name", "description", "image", "episodeCount", "genre", "productionCompany"}),
    "manga": ({"MangaSeries"}, {"@type", "name", "description", "image", "chapterCount", "genre", "author"}),
    "books": ({"Book"}, {"@type", "name", "author", "datePublished", "isbn", "publisher", "description"}),
    "games": ({"VideoGame"}, {"@type", "name", "description", "image", "gamePlatform", "datePublished", "publisher"}),
    "adults": ({"AdultEntertainment"}, {"@type", "name", "description", "provider", "contentRating"}),
    "music": ({"MusicAlbum", "MusicRecording", "MusicGroup", "MusicVideoObject"}, {"@type", "name", "artist", "datePublished", "genre", "duration", "inAlbum"}),
    "contenthost": ({"VideoObject", "AudioObject"}, {"@type", "name", "description", "contentUrl", "uploadDate", "provider"}),
}
AFFILIATE_HOSTS = ["amazon.", "amzn.to", "clickbank.", "shareasale.", "cj.com", "awin1.", "impact.com", "partnerize.", "rakuten.", "linksynergy.", "ebay.", "glnk.io", "go2cloud.", "rstyle.me", "go.redirectingat.com"]
AFFILIATE_KEYS = {"affid", "affiliate", "aff", "ref", "refid", "subid", "tag", "utm_medium", "utm_campaign"}
SHOP_ASSETS = re.compile(r"cdn\.shopify\.com|wp-content/plugins/woocommerce|checkout\.shopify\.com|cart\.js|mage/.*\.js|opencart|bigcommerce|squarespace-commerce|paypal\.com/sdk|stripe\.com", re.I)
SHOP_FORMS = re.compile(r"cart|checkout|order|payment|wp-cart", re.I)
SHOP_CLASSES = re.compile(r"add[-_]to[-_]cart|cart-btn|btn-buy|product-price", re.I)

SLOTS = ["adsense_ins", "amazon_assoc", "taboola", "revcontent", "outbrain", "generic_div_class", "generic_div_id"]
INTS = ["max_depth", "node_count", "inline_scripts", "inline_bytes", "text_length", "ad_slots", "ad_like", "iframes", "ins", "amp_ads", "rec_widgets", "pagination_hits", "rel_next", "shop_signals", "ad_scripts", "schema_blocks", "schema_types", "words", "long_paragraphs", *(f"slot_{k}" for k in SLOTS), "total_ad_slots", *(f"n_{t}" for t in COUNTED), *(f"schema_{k}" for k in SCHEMA)]
FLAGS = ["gpt", "header_bidding", "arbitrage", "autoplay", "sticky", "overlay", "clickbait", "affiliate", "has_schema", "schema_movie_only", *(f"complete_{k}" for k in SCHEMA)]
REALS = ["avg_depth", "repetition", "text_to_html", "ad_to_text", "iframes_per_1k"]
TEXTS = ["main_text", "visible_text", "relevant_text"]
LISTS = ["vendors", "ad_snippets"]
DDL = ", ".join([*(f"{c} long" for c in INTS), *(f"{c} boolean" for c in FLAGS), *(f"{c} double" for c in REALS), *(f"{c} string" for c in TEXTS), *(f"{c} array<string>" for c in LISTS)])
HIDDEN = frozenset(["script", "style", "noscript", "iframe", "svg"])
UNSEEN = frozenset(["script", "style", "meta", "link", "noscript"])


class Element:
    """An open element: its own strings, and all strings inside where they are asked for."""

    __slots__ = ("tag", "attrs", "own", "inner", "outside")

    def __init__(self, tag: str, attrs: dict[str, str], inner: list[str] | None, outside: bool = False):
        self.tag, self.attrs, self.own, self.inner, self.outside = tag, attrs, [], inner, outside


class Page(HTMLParser):
    """Streams a page's tags once and keeps counts; malformed nesting closes to the nearest open tag."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[Element] = []
        self.depths: list[int] = [0]
        self.f: Counter = Counter()
        self.flags: set[str] = set()
        self.text: list[str] = []
        self.main: list[str] = []
        self.segments = Segments()
        self.visible: list[str] = []
        self.scripts: list[str] = []
        self.sources: list[str] = []
        self.json_ld: list[str] = []
        self.snippets: list[str] = []
        self.title: list[str] | None = None
        self.h1: list[str] | None = None
        self.meta: dict[str, str] = {}

    @staticmethod
    def looks_like_ad(a: dict[str, str]) -> bool:
        flat = " ".join([a.get("id", ""), " ".join(a.get("class", "").split()), a.get("name", ""), a.get("src", ""), *(v for k, v in a.items() if k.startswith("data-"))]).lower()
        if AD_WORDS.search(flat):
            return not NOT_AD.search(flat)
        return any(p in a.get("src", "").lower() for p in AD_SOURCES)

    def count_slots(self, tag: str, a: dict[str, str], classes: list[str]) -> None:
        """Containers by provider; one element may count for several."""
        found, ident = [], a.get("id", "")
        if tag == "ins" and "adsbygoogle" in classes:
            found.append("adsense_ins")
        if tag == "div":
            found += [kind for kind, start in (("amazon_assoc", "amzn_assoc"), ("taboola", "taboola-"), ("revcontent", "revcontent-")) if ident.lower().startswith(start)]
            if a.get("data-widget-id", "").lower().startswith("ob"):
                found.append("outbrain")
            if any(map(AD_SLOT.search, [*classes, " ".join(classes)])):
                found.append("generic_div_class")
            if AD_SLOT.search(ident):
                found.append("generic_div_id")
        self.f.update(f"slot_{k}" for k in found)
        self.f["total_ad_slots"] += len(found)

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        f, src, classes = self.f, a.get("src", ""), a.get("class", "").split()
        flat = " ".join(classes).lower()
        self.depths.append(len(self.open) + 1)
        if tag in COUNTED:
            f[f"n_{tag}"] += 1
        if tag in ("iframe", "div", "section", "ins", "script") and self.looks_like_ad(a):
            f["ad_like"] += 1
            f["ad_slots"] += tag != "script"
            name = f"{a.get('id', '')} {' '.join(classes)}".strip()
            if name and len(self.snippets) < 20:
                self.snippets.append(name[:80])
        self.count_slots(tag, a, classes)
        f["iframes"] += tag == "iframe"
        f["ins"] += tag == "ins"
        f["amp_ads"] += tag == "amp-ad"
        if "src" in a:
            self.sources.append(src)
            f["shop_signals"] += bool(SHOP_ASSETS.search(src))
            f["ad_scripts"] += tag == "script" and any(d in src for d in AD_DOMAINS)
        if tag == "form" and SHOP_FORMS.search(a.get("action", "")):
            self.flags.add("shop_form")
        if SHOP_CLASSES.search(flat):
            self.flags.add("shop_class")
        if tag == "video" and "autoplay" in a and "muted" in a:
            self.flags.add("autoplay")
        if "style" in a and STICKY.search(f"{a['style'].lower()} {flat}"):
            self.flags.add("sticky")
        if OVERLAY.search(flat):
            self.flags.add("overlay")
        f["rec_widgets"] += bool(ARBITRAGE.search(flat))
        if tag == "a" and "href" in a and self.is_affiliate(a["href"]):
            self.flags.add("affiliate")
        if tag == "link" and "next" in a.get("rel", "").split():
            f["rel_next"] += 1
        if tag == "meta":
            for key in ("name", "property"):
                if a.get(key) in ("description", "og:description"):
                    self.meta.setdefault(f"{key}:{a[key]}", a.get("content", "").strip())
        if tag == "script" and "src" not in a:
            f["inline_scripts"] += 1
        if tag == "script" and a.get("type") == "application/ld+json":
            f["schema_blocks"] += 1
        inner = None
        if tag == "a" or (tag == "title" and self.title is None) or (tag == "h1" and self.h1 is None):
            inner = []
            if tag != "a":
                setattr(self, tag, inner)
        if tag in VOID:
            self.segments.opened(tag, False)
        else:
            outside = is_outside(tag, a)
            self.segments.opened(tag, outside)
            self.open.append(Element(tag, a, inner, outside))

    @staticmethod
    def is_affiliate(href: str) -> bool:
        try:
            u = urlsplit(href)
            return any(h in u.netloc.lower() for h in AFFILIATE_HOSTS) or any(k.lower() in AFFILIATE_KEYS for k in parse_qs(u.query))
        except ValueError:
            return False

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if any(e.tag == tag for e in self.open):
            while True:
                e = self.open.pop()
                self.leave(e)
                if e.tag == tag:
                    return

    def leave(self, e: Element) -> None:
        """What an element tells once all inside is known."""
        self.segments.closed(e.tag, e.outside)
        if e.tag == "script":
            code = "".join(e.own)
            self.scripts.append(code)
            if e.attrs.get("type") == "application/ld+json":
                self.json_ld.append(code)
            if "src" not in e.attrs:
                self.f["inline_bytes"] += len(code.encode("utf-8", "replace"))
        elif e.tag == "a" and "href" in e.attrs:
            self.f["pagination_hits"] += bool(PAGE_ANCHOR.search(" ".join(e.inner)) or PAGE_URL.search(e.attrs["href"]))
        elif e.tag in ("div", "section", "aside", "p"):
            self.f["rec_widgets"] += bool(RECOMMENDED.search(" ".join(e.own).strip()))

    def handle_data(self, data):
        self.text.append(data)
        tags = {e.tag for e in self.open}
        if self.open:
            self.open[-1].own.append(data)
        if data.strip():
            for e in self.open:
                if e.inner is not None:
                    e.inner.append(data.strip())
        self.segments.data(data)
        if not tags & HIDDEN:
            self.main.append(data)
        if not tags & UNSEEN:
            self.visible.append(data)

    def handle_comment(self, data):
        if self.open:
            self.open[-1].own.append(data)

    def finish(self) -> None:
        self.close()
        while self.open:
            self.leave(self.open.pop())

    def schema_types(self) -> set[str]:
        """Types of all JSON-LD entries; counts them by category and marks complete ones. Invalid blocks are skipped."""
        out: set[str] = set()
        for block in self.json_ld:
            try:
                data = json.loads(block)
            except ValueError:
                continue
            for item in data if isinstance(data, list) else [data]:
                kinds = item.get("@type") if isinstance(item, dict) else None
                if not kinds:
                    continue
                for kind in map(str, kinds if isinstance(kinds, list) else [kinds]):
                    out.add(kind)
                    for category, (members, wanted) in SCHEMA.items():
                        if kind in members:
                            self.f[f"schema_{category}"] += 1
                            if 10 * len(wanted & item.keys()) >= 8 * len(wanted):
                                self.flags.add(f"complete_{category}")
                                if kinds == "Movie":
                                    self.flags.add("schema_movie_only")
        return out


def repetition(paragraphs: list[str]) -> float:
    """Share of pairs among the first 80 paragraphs whose 5-word shingles overlap by over 0.85."""
    sets = []
    for p in paragraphs[:80]:
        w = p.lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)))
    pairs = [(a, b) for i, a in enumerate(sets) for b in sets[i + 1 :] if a and b]
    return sum(len(a & b) / len(a | b) > 0.85 for a, b in pairs) / len(pairs) if pairs else 0.0


def visible_text(parts: list[str]) -> str:
    """Stripped pieces of lines, which two blanks part, in one line, without what still looks like a tag and without code points beyond the BMP."""
    pieces = (piece.strip() for line in "".join(parts).splitlines() for piece in line.strip().split("  "))
    return re.sub("[\U00010000-\U0010ffff]", "", re.sub(r"<.*?>", "", " ".join(filter(None, pieces))))


def page_features(html: str | None) -> dict:
    """All features of one page; a null page has zeros."""
    html = html or ""
    p = Page()
    p.feed(html)
    p.finish()
    types = p.schema_types()
    scripts = " ".join([*filter(None, p.scripts), *p.sources])
    text = p.segments.text() or " ".join(" ".join(p.main).split())  # without main text, all that isn't hidden
    paragraphs = [x for x in text.split("\n") if len(x.split()) >= 10]
    vendors = {name: bool(pattern.search(scripts)) for name, pattern in (("gpt", GPT), ("header_bidding", HEADER_BIDDING), ("arbitrage", ARBITRAGE))}
    heads = " ".join([" ".join(p.title or []), " ".join(p.h1 or [])])
    product = any(map(PRODUCT.search, p.json_ld))
    flags = p.flags | {n for n, hit in vendors.items() if hit} | {n for n, hit in (("clickbait", CLICKBAIT.search(heads)), ("has_schema", types)) if hit}
    words = len(text.split())
    description = p.meta.get("name:description") if "name:description" in p.meta else p.meta.get("property:og:description", "")
    names = {"gpt": "googletag/DFP", "header_bidding": "header-bidding", "arbitrage": "arbitrage-widgets"}
    out = {c: int(p.f[c]) for c in INTS} | {c: c in flags for c in FLAGS}
    return out | {
        "max_depth": max(p.depths), "node_count": len(p.depths), "avg_depth": sum(p.depths) / len(p.depths),
        "text_length": len("".join(p.text)), "words": words, "long_paragraphs": len(paragraphs), "repetition": repetition(paragraphs),
        "shop_signals": int(p.f["shop_signals"] + product + ("shop_form" in flags) + ("shop_class" in flags)), "schema_types": len(types),
        "text_to_html": len(text) / max(len(html), 1), "ad_to_text": p.f["ad_like"] / max(words, 1), "iframes_per_1k": p.f["iframes"] / max(words / 1000, 0.1),
        "main_text": text, "visible_text": visible_text(p.visible), "relevant_text": "\n\n".join(filter(None, (" ".join(p.title or []), description, text))),
        "vendors": [names[k] for k, hit in vendors.items() if hit], "ad_snippets": p.snippets,
    }


def parse_pages(df: DataFrame, key: str, html: str, parts: int | None = None) -> DataFrame:
    """(key, features…) of each row; pages are parsed batch by batch and never gathered.

    Parsing costs far more than moving a page, so pages are dealt to parts tasks first: by default to all cores, if they come from fewer files than there
    are cores, and as they are read, if from more.
    """
    names = [*INTS, *FLAGS, *REALS, *TEXTS, *LISTS]
    kinds = [*[pa.int64()] * len(INTS), *[pa.bool_()] * len(FLAGS), *[pa.float64()] * len(REALS), *[pa.string()] * len(TEXTS), *[pa.list_(pa.string())] * len(LISTS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                b = batch.slice(at, 128)
                rows = [page_features(x) for x in b.column(1).to_pylist()]
                yield pa.record_batch([b.column(0), *(pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds))], names=[key, *names])

    pages = df.select(key, html)
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = parts or (cores if len(pages.inputFiles()) < cores else None)
    if parts:
        pages = pages.repartition(parts)
    return pages.mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, {DDL}")


def mfa_score(c=F.col) -> Column:
    """0 to 100 from parsed features; 65 and more is taken for a page made for advertising."""
    first = lambda *pairs: F.coalesce(*[F.when(cond, n) for cond, n in pairs], F.lit(0))
    pagination = F.least(F.lit(1.0), (c("pagination_hits") + 2 * c("rel_next")) / 10)
    total = (
        first((c("ad_like") > 25, 15), (c("ad_like") > 12, 7))
        + first((c("iframes") > 12, 10), (c("iframes") > 6, 5))
        + first((c("gpt") | c("header_bidding"), 10))
        + first((c("sticky") | c("autoplay") | c("overlay"), 10))
        + first((c("rec_widgets") > 3, 25), (c("rec_widgets") > 0, 20))
        + first(((c("words") < 400) & (c("ad_like") > 8), 15), ((c("words") < 250) & (c("ad_like") > 0), 8))
        + first((pagination > 0.5, 10), (pagination > 0.2, 4))
        + first((c("repetition") > 0.3, 5))
    )
    return F.least(F.lit(100), total)
