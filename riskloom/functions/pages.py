"""Features of HTML that regular expressions express, as native columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from riskloom.functions.text import collapse, word_count

#: Patterns of parked and blocked pages.
PARKED = ["sedo\\s+domain\\s+parking", "sedoparking\\.com", "this\\s+domain\\s+has\\s+recently\\s+been\\s+registered", "domain\\s+parking", "buy\\s+this\\s+domain", "domain\\s+is\\s+for\\s+sale", "for\\s+sale\\s+domain", "parkingcrew", "bodis", "dan\\.com", "afternic"]
BLOCKED = ["captcha", "verify\\s+you\\s+are\\s+human", "attention\\s+required", "cloudflare", "ddos\\s+protection", "access\\s+denied", "forbidden", "error\\s*403", "temporarily\\s+unavailable", "unusual\\s+traffic"]
BLOCKED_FLAG = ["captcha", "verify\\s+you\\s+are\\s+human", "attention\\s+required", "checking\\s+your\\s+browser", "cloudflare", "cf-challenge", "ddos\\s+protection", "access\\s+denied", "forbidden", "error\\s*403", "temporarily\\s+unavailable", "unusual\\s+traffic", "ray\\s+id"]
#: Signals of parked pages in markup, in text, and weighted ones.
PARKED_RAW = ["quickresultseeker.com", "cdn-fileserver.com/bping", "l2type=dmola", "vgd_l2type=dmola", "sedoparking.com", "sedo.com/search", "parkingcrew.net", "bodis.com", "above.com", "undeveloped.com", "sav.com", "domainsponsor.com", "oversee.net", "fabulous.com", "domainactive.com", "parklogic.com", "godaddy.com/parking", "parked.godaddy.com"]
PARKED_TEXT = ["this domain is for sale", "buy this domain", "domain for sale", "make an offer on this domain", "this domain is available for purchase", "this domain is parked", "domain parking", "parked by", "this web page is parked free", "parked free, courtesy of godaddy", "this domain has been registered", "this domain has recently been registered", "this domain may be for sale", "godaddy.com parking", "sedo.com", "hugedomains.com", "dan.com", "afternic.com", "this account has been suspended", "website has been suspended", "account suspended", "this site has been disabled", "domain seized", "no longer available due to copyright", "future home of something quite cool", "proudly hosted by litespeed", "do not sell or share my personal information"]
PARKED_SOFT = {"namecheap": 2, "bluehost": 2, "hostgator": 2, "network solutions": 2, "register.com": 2, "godaddy": 2, "hostinger": 2, "ionos": 2, "this domain": 1, "domain name": 1, "register your domain": 1, "domain registration": 1, "renew your domain": 1, "web hosting": 1, "coming soon": 1, "under construction": 1, "site coming soon": 1, "launching soon": 1, "find your next": 1, "expired domain": 1, "pending delete": 1, "buy now": 1}

TITLE = "(?i)<title[^>]*>([^<]+)</title>"
HEADING = "(?i)<h[1-3][^>]*>([^<]+)</h[1-3]>"
DATA_URI = "data:[^\\s\"']{1,200};base64,[A-Za-z0-9+/=\\s]{256,}"


def title(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, TITLE, 1))


def meta(html: Column, name: str) -> Column:
    """The content of a meta tag; for the description, in either order of attributes."""
    a = F.regexp_extract(html, f"(?i)<meta[^>]*name=[\"']{name}[\"'][^>]*content=[\"']([^\"'>]+)[\"']", 1)
    if name != "description":
        return F.trim(a)
    b = F.regexp_extract(html, f"(?i)<meta[^>]*content=[\"']([^\"'>]+)[\"'][^>]*name=[\"']{name}[\"']", 1)
    return F.trim(F.when(a != "", a).otherwise(b))


def headings(html: Column, most: int = 10) -> Column:
    return F.slice(F.transform(F.regexp_extract_all(html, F.lit(HEADING), F.lit(1)), lambda h: F.trim(h)), 1, most)


def body_text(html: Column) -> Column:
    x = F.regexp_replace(html, "(?is)<script[^>]*>.*?</script>", " ")
    x = F.regexp_replace(x, "(?is)<style[^>]*>.*?</style>", " ")
    return collapse(F.regexp_replace(x, "<[^>]+>", " "))


def prepared_text(html: Column, most: int = 80_000) -> Column:
    """Labelled title, description, keywords and headings, a blank line, and the body; null if all is blank."""
    label = lambda name, c: F.when(c != "", F.concat(F.lit(f"{name}: "), c))
    head = F.concat_ws("\n", label("TITLE", title(html)), label("DESC", meta(html, "description")), label("KEYWORDS", meta(html, "keywords")), label("HEADINGS", F.array_join(headings(html), " | ")))
    body = body_text(html)
    x = F.concat_ws("\n\n", F.when(head != "", head), F.when(body != "", F.concat(F.lit("CONTENT: "), body)))
    return F.when(F.trim(x) == "", F.lit(None)).when(F.length(x) > most, F.concat(F.left(x, F.lit(most)), F.lit("... [TRUNCATED]"))).otherwise(x)


def scrub_data_uris(html: Column) -> Column:
    return F.regexp_replace(html, DATA_URI, "data:[base64]")


def too_short(text: Column) -> Column:
    return text.isNull() | (word_count(text) < 4)


def matches_any(patterns: list[str], text: Column, raw: Column) -> Column:
    one = "|".join(patterns)
    one = f"(?U){one}"
    return F.coalesce(F.lower(text).rlike(one), F.lit(False)) | F.coalesce(F.lower(F.left(raw, F.lit(200_000))).rlike(one), F.lit(False))


def parked(visible: Column, raw: Column) -> Column:
    """Three tiers: markup signals, plain phrases, and a weighted score of 3 or more."""
    text, low = F.lower(F.coalesce(visible, F.lit(""))), F.lower(F.coalesce(raw, F.lit("")))
    real = F.size(F.filter(F.split(text, "(?U)\\s+"), lambda w: (w != "") & ~w.rlike("[{};:/=\\\\]")))
    score = sum((F.when(F.contains(text, F.lit(s)), w).otherwise(0) for s, w in PARKED_SOFT.items()), F.lit(0))
    score = score + F.when(real < 50, 2).when(real < 120, 1).otherwise(0) + F.when(low.rlike("height: ?100vh"), 2).otherwise(0)
    any_of = lambda c, signals: F.exists(F.array(*map(F.lit, signals)), lambda s: F.contains(c, s))
    return any_of(low, PARKED_RAW) | any_of(text, PARKED_TEXT) | (score >= 3)


def mhtml_part(snapshot: Column) -> Column:
    """The HTML part of an MHTML snapshot; anything without its header stays as it is."""
    at = F.instr(snapshot, "Content-Type: text/html")
    part = F.substr(snapshot, at)
    doctype, html = F.instr(F.lower(part), "<!doctype"), F.instr(F.lower(part), "<html")
    part = F.substr(part, F.when(doctype > 0, doctype).when(html > 0, html).otherwise(1))
    cut = F.regexp_extract(part, "(?s)^(.*?)(?:\\r?\\n------MultipartBoundary|\\r?\\n--[-=_A-Za-z0-9]{10,}|\\r?\\nContent-Type: (?!text/html))", 1)
    return F.when(at == 0, snapshot).otherwise(F.when(cut != "", cut).otherwise(part))


def policy_flags(html: Column) -> dict[str, Column]:
    """Words of the raw markup, wherever they stand."""
    low = F.lower(F.coalesce(html, F.lit("")))
    return {"terms": low.rlike("terms|tos"), "dmca": low.rlike("disclaimer|dmca"), "privacy": low.rlike("privacy|policy")}


#: Texts of captures that show no site.
INVALID_CAPTURE = [
    "Click Allow if you are not a robot",
    "The page will automatically redirect",
    "Index of / Index of / NameLast ModifiedSize Proudly Served by LiteSpeed Web Server at cinehdencasa.com Port 443",
    "Comprobando si la conexión del sitio es segura",
    "Checking if the site connection is secure",
    "Error code 520",
    "No webpage was found for the web address: ",
    "Domain Currently Under Maintenance",
    "This Account has been suspended",
    "Attention Attention Please install the Adblock Pro - Browser Extension to continue watching in safe mode",
    "This website has been reported for potential phishing",
    "Access to the requested content/website has been disabled",
    "Pulsa en Permitir ¡Haz clic en \"Permitir\" para confirmar que no eres un robot!",
    "The server is temporarily unavailable",
    "DDoS-GuardChecking your browser",
    "The domain has expired",
    "The page will automatically redirect to",
    "SHP Redirector",
    "Click \"Allow\" to confirm that you are not a robot",
    "This is the default index.html, this page is automatically generated by the system",
    "We would like to inform you that we have decided to shut down our site",
    "Web server is down",
    "This domain has recently been registered with Namecheap",
    "Adblocker is the ultimate ad blocker and the most advanced video ad blocker",
    "ERR_TUNNEL_CONNECTION_FAILED",
    "Domain Seized",
    "Pulsa en Permitir ¡Haz clic en \"Permitir\" para confirmar que no eres un robot!",
    "Reqzone.com - Movies, TV and Celebrities",
    "Erro 404\"Home Page\"",
    "Back to Cart",
    "Nigeria's Citadel Of Entertainment",
    "Not found",
    "Access Denied.",
    "DNS points to prohibited IP",
    "404 Not Found",
    "Your file is ready for download!",
    "No se pudo establecer tu preferencia",
    "Verifying that you are not a robot...",
    "Sorry, the page you were looking for does not exist or is not available",
    "can't reach this page",
    "Website is no Longer Available",
    "500 Internal Server",
    "502: Bad gateway",
    "oldal új címe",
    "You have consumed 100% of your monthly basic quota",
    "Blocked Page",
    "Cloudflare Please enable cookies",
    "Ads Blocker Detected!!! ",
    "Welcome to nginx!",
    "I'm not a robot",
    "The new site has been successfully created",
    "Domain Name Check & Register",
    "Este domínio será desativado em breve",
    "Connection timed out",
    "Free Safari Ad Blocker",
]


def valid_capture(text: Column) -> Column:
    """Whether a captured text has four tokens between blanks and none of the texts that show no site; a null text is not valid."""
    rejected = F.exists(F.array(*map(F.lit, INVALID_CAPTURE)), lambda x: F.contains(text, x))
    return F.coalesce((F.size(F.split(text, " ")) >= 4) & ~rejected, F.lit(False))
